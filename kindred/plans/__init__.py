"""End-to-end plans: the migration and the registered queries."""

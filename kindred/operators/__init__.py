"""Dataset jobs: stage, catalog, child tables, integrity checks, access paths."""

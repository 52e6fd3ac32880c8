"""kindred: a schemaless key-value document collection -> typed, checked tables, on Spark.

Typical use::

    from kindred.plans.migrate import migrate
    result = migrate(spark, "/data/export/*.jsonl", "/data/typed")

or job by job::

    from kindred.operators import stage, catalog, tables, integrity, access
    st = stage.stage(spark, read_documents(spark, path))
    objects = catalog.legacy_object(st)
    zset = tables.legacy_zset(st)
"""

__all__ = ["model", "session"]

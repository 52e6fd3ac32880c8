"""Document collections derived from the TPC-H-like test tables.

Each family turns one table into JSON documents of one object kind; the
collection is their UNION ALL.  Every family is written twice, once for Spark
and once for DuckDB, so the DuckDB oracle can rebuild exactly the same
documents (see FIXTURES.md).  The Spark side is a plain projection (or a
group-by for the set/list families) over the parquet tables, so it grows with
the tables and runs fully distributed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# family -> (table, Spark expression producing `data`, optional filter, optional group key)
# Timestamps without time zone are turned into epoch millis as a difference
# from the epoch, so the documents do not depend on the session time zone.
SPARK_FAMILIES: dict[str, tuple[str, str, str | None, str | None]] = {
    "zset": ("orders",
             "to_json(named_struct('_key', concat('customer:', o_custkey, ':orders'),"
             " 'value', string(o_orderkey), 'score', timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)))",
             None, None),
    "zset_expiry": ("events",
                    "to_json(named_struct('_key', concat('user:', user_id, ':', event_type),"
                    " 'value', string(event_id), 'score', value,"
                    " 'expireAt', timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) + 86400000))",
                    "event_type in ('signup', 'purchase')", None),
    "hash": ("customer",
             "to_json(named_struct('_key', concat('customer:', c_custkey), 'name', c_name,"
             " 'nation', c_nationkey, 'segment', c_mktsegment))",
             None, None),
    "set": ("nation",
            "to_json(named_struct('_key', concat('region:', n_regionkey, ':nations'),"
            " 'members', transform(array_sort(collect_list(struct(n_nationkey, n_name))), x -> x.n_name)))",
            None, "n_regionkey"),
    # one list per nation and block of 100 supplier keys: a list never holds
    # more than 100 items however large the table grows
    "list": ("supplier",
             "to_json(named_struct('_key', concat('nation:', s_nationkey, ':suppliers:', s_suppkey div 100),"
             " 'array', transform(array_sort(collect_list(struct(s_suppkey, s_name))), x -> x.s_name)))",
             None, "s_nationkey, s_suppkey div 100"),
    "string_value": ("region",
                     "to_json(named_struct('_key', concat('region:', r_regionkey, ':name'), 'value', r_name))",
                     None, None),
    "string_data": ("nation",
                    "to_json(named_struct('_key', concat('nation:', n_nationkey, ':label'), 'data', n_name,"
                    " 'expireAt', 1700000000000 + n_nationkey * 3600000))",
                    None, None),
    "imported_user": ("supplier",
                      "to_json(named_struct('_key', concat('_imported_user:', s_suppkey), 'name', s_name,"
                      " 'expireAt', 1700000000000 + s_suppkey))",
                      None, None),
    "imported_topic": ("part",
                       "to_json(named_struct('_key', concat('_imported_topic:', p_partkey), 'title', p_name,"
                       " 'size', p_size))",
                       None, None),
}

# Dirty families: documents that exercise every reject reason and integrity
# report, each derived from a natural property of a table (a text column
# where a number belongs, an event type whose rows repeat per user, ...).
# Spark's to_json drops null fields unless told otherwise; DuckDB keeps them.
_KEEP_NULLS = ", map('ignoreNullFields', 'false')"
DIRTY_SPARK_FAMILIES: dict[str, tuple[str, str, str | None, str | None]] = {
    "zset_bad_score": ("events",
                       "to_json(named_struct('_key', concat('user:', user_id, ':errors'),"
                       " 'value', string(event_id), 'score', props))",
                       "event_type = 'error'", None),
    "zset_null_value": ("events",
                        "to_json(named_struct('_key', concat('user:', user_id, ':views'),"
                        " 'value', cast(null as string), 'score', value)" + _KEEP_NULLS + ")",
                        "event_type = 'view'", None),
    "zset_null_score": ("part",
                        "to_json(named_struct('_key', concat('part:', p_partkey, ':rating'),"
                        " 'value', p_name, 'score', cast(null as double))" + _KEEP_NULLS + ")",
                        None, None),
    "zset_repeated_value": ("events",
                            "to_json(named_struct('_key', concat('user:', user_id, ':types'),"
                            " 'value', event_type, 'score', value))",
                            None, None),
    "zset_mixed_kind": ("orders",
                        "to_json(named_struct('_key', concat('customer:', o_custkey),"
                        " 'value', string(o_orderkey), 'score', floor(o_totalprice * 100)))",
                        "o_orderpriority = '1-URGENT'", None),
    "string_repeated_key": ("events",
                            "to_json(named_struct('_key', concat('user:', user_id, ':last_click'),"
                            " 'value', string(event_id)))",
                            "event_type = 'click'", None),
    "string_null_payload": ("region",
                            "to_json(named_struct('_key', concat('region:', r_regionkey, ':motto'),"
                            " 'value', cast(null as string))" + _KEEP_NULLS + ")",
                            None, None),
    "string_bad_expire": ("part",
                          "to_json(named_struct('_key', concat('part:', p_partkey, ':promo'),"
                          " 'value', p_brand, 'expireAt', p_type))",
                          None, None),
    "set_not_array": ("nation",
                      "to_json(named_struct('_key', concat('nation:', n_nationkey, ':members'),"
                      " 'members', n_name))",
                      None, None),
    "set_null_member": ("region",
                        "to_json(named_struct('_key', concat('region:', r_regionkey, ':codes'),"
                        " 'members', array(r_name, cast(null as string))))",
                        None, None),
    "list_not_array": ("supplier",
                       "to_json(named_struct('_key', concat('supplier:', s_suppkey, ':tags'),"
                       " 'array', s_nationkey))",
                       None, None),
    "imported_bad_type": ("part",
                          "to_json(named_struct('_key', concat('_imported_', lower(p_brand), ':', p_partkey),"
                          " 'title', p_name))",
                          None, None),
    "imported_bad_id": ("customer",
                        "to_json(named_struct('_key', concat('_imported_post:', c_name), 'segment', c_mktsegment))",
                        None, None),
    "imported_bad_key": ("supplier",
                         "to_json(named_struct('_key', concat('_imported_user:', s_suppkey, ':', s_nationkey),"
                         " 'name', s_name))",
                         None, None),
    "zset_far_expiry": ("region",
                        "to_json(named_struct('_key', concat('region:', r_regionkey, ':far'), 'value', r_name,"
                        " 'score', r_regionkey, 'expireAt', 8640000000000000 - r_regionkey * 1000))",
                        None, None),
    "zset_fine_score": ("nation",
                        "to_json(named_struct('_key', concat('region:', n_regionkey, ':fine'), 'value', n_name,"
                        " 'score', concat('0.1234567890123456', n_nationkey)))",
                        None, None),
    "zset_inexact_score": ("nation",
                           "to_json(named_struct('_key', concat('region:', n_regionkey, ':inexact'), 'value', n_name,"
                           " 'score', concat('0.12345678901234567', n_nationkey, '9')))",
                           None, None),
    "zset_huge_score": ("region",
                        "to_json(named_struct('_key', concat('region:', r_regionkey, ':huge'), 'value', r_name,"
                        " 'score', concat(r_regionkey + 1, 'e30')))",
                        None, None),
    "zset_wide_text": ("customer",
                       "to_json(named_struct('_key', concat('nation:', c_nationkey, ':wide'), 'value', c_name, 'score',"
                       " concat(case when c_acctbal < 0 then '-' else '' end, c_custkey,"
                       " '9876543210987654321098765432109876543.', c_custkey, '0')))",
                       None, None),
    # Written as a number, with more digits than any fixed type has.
    "zset_wide_number": ("supplier",
                         "concat('{\"_key\":\"nation:', s_nationkey, ':wide\",\"value\":\"', s_name, '\",\"score\":',"
                         " s_suppkey + 1, '9876543210987654321098765432109876543210}')",
                         None, None),
    "doc_trailing_text": ("region", "concat(to_json(named_struct('_key', concat('region:', r_regionkey, ':twice'),"
                          " 'value', r_name)), ' ', to_json(named_struct('_key', r_name)))", None, None),
    "doc_missing_key": ("region", "to_json(named_struct('name', r_name))", None, None),
    "doc_null_key": ("region",
                     "to_json(named_struct('_key', cast(null as string), 'value', r_name)" + _KEEP_NULLS + ")",
                     None, None),
    "doc_not_object": ("region", "to_json(array(r_name))", None, None),
}

DIRTY_DUCKDB_FAMILIES: dict[str, str] = {
    "zset_bad_score": "select json_object('_key', 'user:' || user_id || ':errors', 'value', event_id::varchar,"
                      " 'score', props) as data from events where event_type = 'error'",
    "zset_null_value": "select json_object('_key', 'user:' || user_id || ':views', 'value', null,"
                       " 'score', value) as data from events where event_type = 'view'",
    "zset_null_score": "select json_object('_key', 'part:' || p_partkey || ':rating', 'value', p_name,"
                       " 'score', null) as data from part",
    "zset_repeated_value": "select json_object('_key', 'user:' || user_id || ':types', 'value', event_type,"
                           " 'score', value) as data from events",
    "zset_mixed_kind": "select json_object('_key', 'customer:' || o_custkey, 'value', o_orderkey::varchar,"
                       " 'score', floor(o_totalprice * 100)::bigint) as data from orders"
                       " where o_orderpriority = '1-URGENT'",
    "string_repeated_key": "select json_object('_key', 'user:' || user_id || ':last_click',"
                           " 'value', event_id::varchar) as data from events where event_type = 'click'",
    "string_null_payload": "select json_object('_key', 'region:' || r_regionkey || ':motto', 'value', null)"
                           " as data from region",
    "string_bad_expire": "select json_object('_key', 'part:' || p_partkey || ':promo', 'value', p_brand,"
                         " 'expireAt', p_type) as data from part",
    "set_not_array": "select json_object('_key', 'nation:' || n_nationkey || ':members', 'members', n_name)"
                     " as data from nation",
    "set_null_member": "select json_object('_key', 'region:' || r_regionkey || ':codes',"
                       " 'members', [r_name, null]) as data from region",
    "list_not_array": "select json_object('_key', 'supplier:' || s_suppkey || ':tags', 'array', s_nationkey)"
                      " as data from supplier",
    "imported_bad_type": "select json_object('_key', '_imported_' || lower(p_brand) || ':' || p_partkey,"
                         " 'title', p_name) as data from part",
    "imported_bad_id": "select json_object('_key', '_imported_post:' || c_name, 'segment', c_mktsegment)"
                       " as data from customer",
    "imported_bad_key": "select json_object('_key', '_imported_user:' || s_suppkey || ':' || s_nationkey,"
                        " 'name', s_name) as data from supplier",
    "zset_far_expiry": "select json_object('_key', 'region:' || r_regionkey || ':far', 'value', r_name,"
                       " 'score', r_regionkey, 'expireAt', 8640000000000000 - r_regionkey * 1000) as data from region",
    "zset_fine_score": "select json_object('_key', 'region:' || n_regionkey || ':fine', 'value', n_name,"
                       " 'score', '0.1234567890123456' || n_nationkey) as data from nation",
    "zset_inexact_score": "select json_object('_key', 'region:' || n_regionkey || ':inexact', 'value', n_name,"
                          " 'score', '0.12345678901234567' || n_nationkey || '9') as data from nation",
    "zset_huge_score": "select json_object('_key', 'region:' || r_regionkey || ':huge', 'value', r_name,"
                       " 'score', (r_regionkey + 1) || 'e30') as data from region",
    "zset_wide_text": "select json_object('_key', 'nation:' || c_nationkey || ':wide', 'value', c_name, 'score',"
                      " case when c_acctbal < 0 then '-' else '' end || c_custkey || '9876543210987654321098765432109876543.'"
                      " || c_custkey || '0') as data from customer",
    "zset_wide_number": "select ('{\"_key\":\"nation:' || s_nationkey || ':wide\",\"value\":\"' || s_name || '\",\"score\":'"
                        " || (s_suppkey + 1) || '9876543210987654321098765432109876543210}')::json as data from supplier",
    # Not one JSON value: stated as the array that any such text is rejected like.
    "doc_trailing_text": "select to_json([r_name, r_name]) as data from region",
    "doc_missing_key": "select json_object('name', r_name) as data from region",
    "doc_null_key": "select json_object('_key', null, 'value', r_name) as data from region",
    "doc_not_object": "select to_json([r_name]) as data from region",
}

ALL_SPARK_FAMILIES = {**SPARK_FAMILIES, **DIRTY_SPARK_FAMILIES}

DUCKDB_FAMILIES: dict[str, str] = {
    "zset": "select json_object('_key', 'customer:' || o_custkey || ':orders', 'value', o_orderkey::varchar,"
            " 'score', epoch_ms(o_orderdate)) as data from orders",
    "zset_expiry": "select json_object('_key', 'user:' || user_id || ':' || event_type, 'value', event_id::varchar,"
                   " 'score', value, 'expireAt', epoch_us(ts) // 1000 + 86400000) as data from events"
                   " where event_type in ('signup', 'purchase')",
    "hash": "select json_object('_key', 'customer:' || c_custkey, 'name', c_name, 'nation', c_nationkey,"
            " 'segment', c_mktsegment) as data from customer",
    "set": "select json_object('_key', 'region:' || n_regionkey || ':nations', 'members',"
           " list(n_name order by n_nationkey)) as data from nation group by n_regionkey",
    "list": "select json_object('_key', 'nation:' || s_nationkey || ':suppliers:' || (s_suppkey // 100),"
            " 'array', list(s_name order by s_suppkey)) as data from supplier"
            " group by s_nationkey, s_suppkey // 100",
    "string_value": "select json_object('_key', 'region:' || r_regionkey || ':name', 'value', r_name) as data"
                    " from region",
    "string_data": "select json_object('_key', 'nation:' || n_nationkey || ':label', 'data', n_name,"
                   " 'expireAt', 1700000000000 + n_nationkey * 3600000) as data from nation",
    "imported_user": "select json_object('_key', '_imported_user:' || s_suppkey, 'name', s_name,"
                     " 'expireAt', 1700000000000 + s_suppkey) as data from supplier",
    "imported_topic": "select json_object('_key', '_imported_topic:' || p_partkey, 'title', p_name,"
                      " 'size', p_size) as data from part",
}

ALL_DUCKDB_FAMILIES = {**DUCKDB_FAMILIES, **DIRTY_DUCKDB_FAMILIES}


def _family(df: DataFrame, expr: str, where: str | None, group: str | None) -> DataFrame:
    if where:
        df = df.where(where)
    if group:
        keys = [F.expr(g) for g in group.split(", ")]
        return df.groupBy(*keys).agg(F.expr(expr).alias("data")).select("data")
    return df.select(F.expr(expr).alias("data"))


def fixture_documents(spark: SparkSession, sf_dir: str,
                      families: dict[str, tuple[str, str, str | None, str | None]] | None = None
                      ) -> DataFrame:
    """The document collection (one JSON text per row, column ``data``):
    by default the clean families and the dirty ones.

    Each table is read once: its projection families become one
    ``explode(array_compact(array(CASE WHEN filter THEN doc END, ...)))``
    over one scan, group-by families stay separate.  One-row-group test
    tables are spread over the cluster first (large tables have enough
    splits and are left alone)."""
    from kindred.operators.stage import spread
    fams = families if families is not None else ALL_SPARK_FAMILIES
    tables: dict[str, DataFrame] = {}
    plain: dict[str, list[F.Column]] = {}
    parts = []
    for table, expr, where, group in fams.values():
        if table not in tables:
            tables[table] = spread(spark, spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))
        if group:
            parts.append(_family(tables[table], expr, where, group))
        else:
            doc = F.expr(expr)
            plain.setdefault(table, []).append(F.when(F.expr(where), doc) if where else doc)
    for table, docs in plain.items():
        parts.append(tables[table].select(F.explode(F.array_compact(F.array(*docs))).alias("data")))
    return reduce(DataFrame.unionAll, parts)


def export_fixture(spark: SparkSession, sf_dir: str, path: str, fmt: str = "parquet",
                   families: dict[str, tuple[str, str, str | None, str | None]] | None = None) -> str:
    """Write the collection to an interchange file, as the source's export
    step does; loading it back gives one scan for the stage to run over."""
    from kindred.sources.documents import write_documents
    write_documents(fixture_documents(spark, sf_dir, families), path, fmt, mode="overwrite")
    return path


def duckdb_objects_sql(families: dict[str, str] | None = None) -> str:
    """DuckDB twin of :func:`fixture_documents` (a UNION ALL query)."""
    fams = families if families is not None else ALL_DUCKDB_FAMILIES
    return "\nunion all\n".join(fams.values())

"""Data model: output schemas, value domains and table keys.

The output tables are fixed; nothing is inferred from the documents.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the source system's, in their declared order:
# the object kinds and the record types of imported documents.
OBJECT_TYPES = ("hash", "zset", "set", "list", "string")
IMPORTED_TYPES = ("bookmark", "category", "favourite", "group", "message",
                  "post", "room", "topic", "user", "vote")

# Fixed field names read from each document.
KEY = "_key"
SCORE = "score"
VALUE = "value"
DATA = "data"
ARRAY = "array"
LIST = "list"
MEMBERS = "members"
EXPIRE = "expireAt"
STORE_ID = "_id"

# Pattern that routes a document to the imported table (LIKE semantics: "_" is
# a single-character wildcard, "%" any run).
IMPORTED_LIKE = "_imported_%:%"

# Unbounded NUMERIC is held as text with a key that sorts as the numbers do; beside
# them stands a DECIMAL(38,18) for arithmetic, null where it would have to round.
SCORE_SCALE = 18
SCORE_TYPE = T.DecimalType(38, SCORE_SCALE)

# Raw document input: one JSON object per row.
DOCUMENTS = T.StructType([T.StructField("data", T.StringType(), False)])

LEGACY_OBJECT = T.StructType([
    T.StructField("_key", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("expireAt", T.TimestampType(), True),
])
LEGACY_HASH = T.StructType([
    T.StructField("_key", T.StringType(), False),
    T.StructField("data", T.VariantType(), False),
    T.StructField("type", T.StringType(), False),
])
LEGACY_ZSET = T.StructType([
    T.StructField("_key", T.StringType(), False),
    T.StructField("value", T.StringType(), False),
    T.StructField("score", SCORE_TYPE, True),
    T.StructField("score_text", T.StringType(), False),
    T.StructField("score_key", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
])
LEGACY_SET = T.StructType([
    T.StructField("_key", T.StringType(), False),
    T.StructField("member", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
])
LEGACY_LIST = T.StructType([
    T.StructField("_key", T.StringType(), False),
    T.StructField("array", T.ArrayType(T.StringType(), True), False),
    T.StructField("type", T.StringType(), False),
])
LEGACY_STRING = T.StructType([
    T.StructField("_key", T.StringType(), False),
    T.StructField("data", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
])
LEGACY_IMPORTED = T.StructType([
    T.StructField("type", T.StringType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("data", T.VariantType(), False),
])
SESSION = T.StructType([
    T.StructField("sid", T.StringType(), False),
    T.StructField("sess", T.StringType(), False),
    T.StructField("expire", T.TimestampNTZType(), False),
])
REJECTS = T.StructType([
    T.StructField("_key", T.StringType(), True),
    T.StructField("reason", T.StringType(), False),
    T.StructField("data", T.StringType(), True),
])

SCHEMAS = {
    "legacy_object": LEGACY_OBJECT,
    "legacy_hash": LEGACY_HASH,
    "legacy_zset": LEGACY_ZSET,
    "legacy_set": LEGACY_SET,
    "legacy_list": LEGACY_LIST,
    "legacy_string": LEGACY_STRING,
    "legacy_imported": LEGACY_IMPORTED,
    "session": SESSION,
}

# Primary keys (I4) and the catalog's second unique key.
PRIMARY_KEYS = {
    "legacy_object": ("_key",),
    "legacy_hash": ("_key",),
    "legacy_zset": ("_key", "value"),
    "legacy_set": ("_key", "member"),
    "legacy_list": ("_key",),
    "legacy_string": ("_key",),
    "legacy_imported": ("type", "id"),
    "session": ("sid",),
}
CATALOG_UNIQUE = ("_key", "type")

# Child tables and the kind each one holds; every child references the
# catalog on (_key, type) with cascading delete and rename.
CHILD_KIND = {
    "legacy_hash": "hash",
    "legacy_zset": "zset",
    "legacy_set": "set",
    "legacy_list": "list",
    "legacy_string": "string",
}

# Enum-typed columns per table.
DOMAINS = {
    "legacy_object": {"type": OBJECT_TYPES},
    "legacy_imported": {"type": IMPORTED_TYPES},
    **{t: {"type": (k,)} for t, k in CHILD_KIND.items()},
}

# Reject reasons, by level (see README):
#   document     - in no output at all
#   catalog      - not in the catalog nor a child; the imported route still runs
#   child        - catalog row kept, child row missing
#   imported     - not in legacy_imported
DOCUMENT_REASONS = ("not_an_object", "missing_key", "null_key")
CATALOG_REASONS = ("null_score", "null_value", "bad_expire")
CHILD_REASONS = ("bad_score", "null_payload", "members_not_array",
                 "null_member", "array_not_array")
IMPORTED_REASONS = ("bad_imported_key", "bad_imported_type", "bad_imported_id")

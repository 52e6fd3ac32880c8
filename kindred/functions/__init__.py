"""Column expressions (JSON document access, casts, key patterns)."""

from kindred.functions.jsondoc import (  # noqa: F401
    DOC_TYPE, dedupe, elements_text, epoch_millis_to_timestamp, expire_timestamp, field, get,
    has, has_null, imported_id_text, imported_like, imported_type, keys, n_keys,
    object_without, parse, text, to_object, unique_keys, without,
)

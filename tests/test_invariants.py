"""Randomised documents against a plain-Python statement of the routing rules
(a brute-force oracle on small inputs), plus exact-join = join-free on clean keys."""

import datetime as dt
import decimal
import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kindred import model
from kindred.operators import catalog as C
from kindred.operators import stage as S
from kindred.operators import tables as TB

KEYS = ["a", "b", "c:1", "_imported_user:1", "_imported_user:x", "_imported_zzz:2",
        "_imported_post:1:2", "ximportedy1:2"]
SCALARS = st.one_of(st.none(), st.integers(-5, 5), st.sampled_from(["x", "y", "12.5", "abc", ""]))
ARRAYS = st.lists(st.one_of(st.none(), st.sampled_from(["p", "q"]), st.integers(0, 3)), max_size=3)
VALUES = st.one_of(SCALARS, ARRAYS)
EXPIRES = st.one_of(st.none(), st.sampled_from([1700000000000, 1704200000000, "soon", "1700000000000"]))

DOC = st.fixed_dictionaries(
    {},
    optional={
        "_key": st.one_of(st.none(), st.sampled_from(KEYS)),
        "score": SCALARS,
        "value": SCALARS,
        "data": SCALARS,
        "array": VALUES,
        "members": VALUES,
        "expireAt": EXPIRES,
        "name": SCALARS,
    })


def text(v):
    """``->>``: JSON null -> None, strings as is, everything else compact JSON."""
    if v is None or isinstance(v, str):
        return v
    return json.dumps(v, separators=(",", ":"), sort_keys=True)


def numeric(t):
    try:
        d = decimal.Decimal(t.strip())
    except (decimal.InvalidOperation, AttributeError):
        return None
    return d if d.is_finite() and abs(d) < decimal.Decimal(10) ** 26 else None


def expire(t):
    n = numeric(t) if t is not None else None
    if n is not None:
        return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=int(n))
    return None


def elements(v):
    if not isinstance(v, list):
        return None
    return [None if x is None else text(x) for x in v]


def route(doc):
    """-> catalog (key, type, expire) or None, child rows, reasons, imported (type, id) or None."""
    out = {"catalog": None, "child": None, "reasons": [], "imported": None}
    if "_key" not in doc:
        out["reasons"].append("missing_key")
        return out
    key = doc["_key"]
    if key is None:
        out["reasons"].append("null_key")
        return out
    imported = re.fullmatch(r"(?s).imported..*:.*", key) is not None
    has_score = "score" in doc
    v, s = text(doc.get("value")), text(doc.get("score"))
    zset_ok = has_score and v is not None and s is not None
    candidate = zset_ok or (not has_score and not imported)
    et = text(doc.get("expireAt"))
    bad_exp = et is not None and expire(et) is None
    if has_score and not imported and s is None:
        out["reasons"].append("null_score")
    elif has_score and not imported and v is None:
        out["reasons"].append("null_value")
    elif candidate and bad_exp:
        out["reasons"].append("bad_expire")
    elif candidate:
        n = len([k for k in doc if k != "expireAt"])
        if zset_ok:
            kind = "zset"
        elif n != 2:
            kind = "hash"
        elif "value" in doc or "data" in doc:
            kind = "string"
        elif "array" in doc:
            kind = "list"
        elif "members" in doc:
            kind = "set"
        else:
            kind = "hash"
        out["catalog"] = (key, kind, expire(et))
        if kind == "zset":
            sc = numeric(s)
            if sc is None:
                out["reasons"].append("bad_score")
            else:
                out["child"] = ("zset", (key, v, float(sc)))
        elif kind == "string":
            p = v if "value" in doc else text(doc.get("data"))
            if p is None:
                out["reasons"].append("null_payload")
            else:
                out["child"] = ("string", (key, p))
        elif kind == "set":
            m = elements(doc["members"])
            if m is None:
                out["reasons"].append("members_not_array")
            else:
                if any(x is None for x in m):
                    out["reasons"].append("null_member")
                out["child"] = ("set", [(key, x) for x in m if x is not None])
        elif kind == "list":
            a = elements(doc["array"])
            if a is None:
                out["reasons"].append("array_not_array")
            else:
                out["child"] = ("list", (key, tuple(a)))
        else:
            out["child"] = ("hash", key)
    if imported:
        m = re.fullmatch(r"(?s)_imported_([^:]*):([^:]*)", key)
        if not m:
            out["reasons"].append("bad_imported_key")
        elif m.group(1) not in model.IMPORTED_TYPES:
            out["reasons"].append("bad_imported_type")
        elif not re.fullmatch(r"\s*[+-]?[0-9]+\s*", m.group(2)):
            out["reasons"].append("bad_imported_id")
        else:
            out["imported"] = (m.group(1), int(m.group(2)))
    return out


def expected(docs):
    cat, zset, string, sets, lists, hashes, reasons, imported = [], [], [], [], [], [], [], []
    zmin = {}
    for d in docs:
        r = route(d)
        reasons += [(d.get("_key"), x) for x in r["reasons"]]
        if r["imported"]:
            imported.append(r["imported"])
        if r["catalog"]:
            key, kind, exp = r["catalog"]
            if kind == "zset":
                prev = zmin.get(key, "none")
                zmin[key] = exp if prev == "none" else (min(x for x in (prev, exp) if x) if (prev or exp) else None)
            else:
                cat.append((key, kind, exp))
        if r["child"]:
            kind, row = r["child"]
            {"zset": zset, "string": string, "list": lists, "hash": hashes}.get(kind, sets).__iadd__(
                row if kind == "set" else [row])
    cat += [(k, "zset", e) for k, e in zmin.items()]
    return {"catalog": sorted(cat, key=repr), "zset": sorted(zset, key=repr), "string": sorted(string, key=repr),
            "set": sorted(sets, key=repr), "list": sorted(lists, key=repr), "hash": sorted(hashes),
            "rejects": sorted(reasons, key=repr), "imported": sorted(imported)}


def actual(spark, docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "data string")
    stg = S.stage(spark, df, persist=False)

    def rows(frame, *cols):
        return [tuple(r[c] for c in cols) for r in frame.collect()]

    cat = [(k, t, e) for k, t, e in rows(C.legacy_object(stg), "_key", "type", "expireAt")]
    return {
        "catalog": sorted(cat, key=repr),
        "zset": sorted(((k, v, float(s)) for k, v, s in rows(TB.legacy_zset(stg), "_key", "value", "score")),
                       key=repr),
        "string": sorted(rows(TB.legacy_string(stg), "_key", "data"), key=repr),
        "set": sorted(rows(TB.legacy_set(stg), "_key", "member"), key=repr),
        "list": sorted(((k, tuple(a)) for k, a in rows(TB.legacy_list(stg), "_key", "array")), key=repr),
        "hash": sorted(k for (k,) in rows(TB.legacy_hash(stg), "_key")),
        "rejects": sorted(rows(TB.rejects(stg), "_key", "reason"), key=repr),
        "imported": sorted(rows(TB.legacy_imported(stg), "type", "id")),
    }


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(DOC, min_size=1, max_size=40))
def test_routing_matches_brute_force(spark, docs):
    assert actual(spark, docs) == expected(docs)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(DOC, min_size=1, max_size=40))
def test_exact_join_equals_join_free_on_clean_keys(spark, docs):
    # one document per key (keys made unique), so no key has two kinds
    uniq = [dict(d, _key=f"k{i}") for i, d in enumerate(docs)]
    df = spark.createDataFrame([(json.dumps(d),) for d in uniq], "data string")
    stg = S.stage(spark, df, persist=False)
    cat = C.legacy_object(stg)
    free, exact = TB.children(stg), TB.exact_children(cat, stg)
    for name in free:
        a = free[name].select([F.col(c).cast("string") for c in free[name].columns])
        b = exact[name].select([F.col(c).cast("string") for c in exact[name].columns])
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())), name

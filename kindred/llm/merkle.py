"""Merkle manifest of a dataset, with membership proofs.

Every row is a leaf; the leaves of a group (``lang``), in ascending id order,
are folded in runs of ``fanout`` to a sub-root, and the sub-roots, in byte order
of the group, likewise to the root.

*Places.*  Leaves are range-partitioned and sorted by ``(group, id, leaf)`` and
stored; a row's place in its group is its position in its partition plus the
rows the group has in earlier partitions, a table of one row per partition and
group in it.  No task sees a whole group, and texts are hashed where they are
read, never shuffled.

*Levels.*  A slot pivot: nodes are grouped by ``place div fanout**SPAN``, and
conditional aggregates spread the nodes of a block into one column per slot.
Concatenating the columns of a run hashes its parent; the next ``SPAN - 1``
levels follow from the columns of the same row, so that a tree of n leaves
takes about ``log(n) / (SPAN * log(fanout))`` shuffles of ever fewer rows.
Omitting a node's own column from its run yields its siblings, kept as what
stands to the left and to the right of it.

*Proofs.*  From the top down, every block gets the path of its own node and
hands it, with the siblings inside the block, to its slots.

Hashes are lowercase hex SHA-256; a leaf hashes its columns, each as ``-`` if
null, else UTF-8 byte count, ``:`` and value.

Defined results: null ids come first; rows with the same id are ordered by their
leaf, so repeated rows are leaves of their own with equal hashes; a null group
is a group of its own, first in order; a lone leaf is its own sub-root and a
lone sub-root the root; an empty table has no root and gives an empty result;
columns that are not named take no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import bounded_broadcast, materialize

FANOUT = 2
#: Levels that one block of slots holds.
SPAN = 4
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_ROW_BITS = 33  # monotonically_increasing_id: partition number, then 33 bits of row number
_SIDES = "array<struct<l:string,r:string>>"


# -- leaves ---------------------------------------------------------------------

def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _group_key(group: Column) -> Column:
    """A text that sorts as the group does, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``grp``) stored, plus ``pos``, the place from 0 in its
    group by ``order``, and ``n``, the group's rows."""
    columns = ["grp", *order]
    tagged = materialize(rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
                         .withColumn("_rid", F.monotonically_increasing_id()), name)
    tagged = (tagged.withColumn("_part", F.shiftrightunsigned("_rid", _ROW_BITS))
              .withColumn("_at", F.col("_rid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    # Only the first and the last group of a partition can lie in another one too.
    parts = tagged.groupBy("grp", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(parts.select("grp", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                                      F.sum("_n").over(whole).alias("n")), f"{name}-starts")
    return (tagged.join(bounded_broadcast(starts), ["grp", "_part"])
            .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_rid", "_part", "_at", "_shift"))


# -- levels ---------------------------------------------------------------------

def _count_at(level: int, fanout: int) -> Column:
    """Nodes of the group after ``level`` more levels."""
    return F.ceil(F.col("n") / F.lit(fanout ** level)).cast("long") if level else F.col("n")


def _pivoted(nodes: DataFrame, fanout: int, span: int) -> DataFrame:
    """One row per block: the node columns ``s<k>_<slot>`` of each of its levels."""
    width = fanout ** span
    slot = F.col("pos") % width
    block = nodes.groupBy("grp", "n", F.floor(F.col("pos") / width).alias("block")).agg(
        *[F.max(F.when(slot == i, F.col("h"))).alias(f"s0_{i}") for i in range(width)])
    for k in range(span):
        parents = []
        for j in range(width // fanout ** (k + 1)):
            run = [F.coalesce(F.col(f"s{k}_{j * fanout + i}"), F.lit("")) for i in range(fanout)]
            own = F.col(f"s{k}_{j * fanout}")
            parents.append(F.when(own.isNull() | (_count_at(k, fanout) <= 1), own)
                           .otherwise(F.sha2(F.concat(*run), 256)).alias(f"s{k + 1}_{j}"))
        block = block.select("*", *parents)
    return block


def _sides(fanout: int, span: int) -> list[Column]:
    """Per level, the siblings of each node: what its run holds left and right of its own column."""
    out = []
    for k in range(span):
        nodes = []
        for x in range(fanout ** (span - k)):
            first = x - x % fanout
            run = [F.coalesce(F.col(f"s{k}_{first + i}"), F.lit("")) for i in range(fanout)]
            left, right = run[:x % fanout], run[x % fanout + 1:]
            nodes.append(F.struct((F.concat(*left) if left else F.lit("")).alias("l"),
                                  (F.concat(*right) if right else F.lit("")).alias("r")))
        out.append(F.array(*nodes).alias(f"sides{k}"))
    return out


def fold_up(nodes: DataFrame, name: str, fanout: int = FANOUT, span: int = SPAN) -> tuple[list[DataFrame], DataFrame]:
    """From ``grp, n, pos, h``: the stored blocks of every round, lowest first
    (``grp, n, block, sides0..``), and ``grp, h``: each group's top node."""
    rounds: list[DataFrame] = []
    width = fanout ** span
    while True:
        block = _pivoted(nodes, fanout, span)
        stored = materialize(block.select("grp", "n", "block", F.col(f"s{span}_0").alias("h"), *_sides(fanout, span)),
                             f"{name}-blocks")
        rounds.append(stored)
        nodes = stored.select("grp", F.ceil(F.col("n") / F.lit(width)).cast("long").alias("n"), F.col("block").alias("pos"), "h")
        if nodes.filter("n > 1").isEmpty():
            return rounds, nodes.select("grp", "h")


def _inner_path(slot: Column, fanout: int, span: int) -> Column:
    """Siblings of a slot on the block's levels that exist, lowest first."""
    steps = []
    for k in range(span):
        node = F.floor(slot / F.lit(fanout ** k)).cast("int")
        steps.append(F.when(_count_at(k, fanout) > 1, F.array(F.get(F.col(f"sides{k}"), node)))
                     .otherwise(F.array().cast(_SIDES)))
    return F.concat(*steps)


def block_paths(rounds: list[DataFrame], above: DataFrame | None, name: str, fanout: int = FANOUT,
                span: int = SPAN) -> DataFrame:
    """The lowest round's blocks with ``up``: the siblings on the levels above
    the block.  ``above`` (``grp, up``) goes on from each group's top node."""
    width = fanout ** span
    top = rounds[-1]
    if above is None:
        found = top.withColumn("up", F.array().cast(_SIDES))
    else:
        found = top.join(bounded_broadcast(above), "grp")
    for k in range(len(rounds) - 2, -1, -1):
        slots = found.select("*", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("slot"))
        handed = slots.select("grp", (F.col("block") * width + F.col("slot")).alias("block"),
                              F.concat(_inner_path(F.col("slot"), fanout, span), F.col("up")).alias("up"))
        found = rounds[k].join(handed, ["grp", "block"])
    return materialize(found, f"{name}-paths")


def leaf_paths(leaves: DataFrame, blocks: DataFrame, fanout: int = FANOUT, span: int = SPAN) -> DataFrame:
    """``leaves`` (``grp, pos, ...``) with ``path``: siblings from the leaf to the root."""
    width = fanout ** span
    held = blocks.drop("h", "n")
    rows = leaves.withColumn("block", F.floor(F.col("pos") / width)).join(held, ["grp", "block"])
    path = F.concat(_inner_path(F.col("pos") % width, fanout, span), F.col("up"))
    return rows.select(*leaves.columns, path.alias("path"))


# -- proofs ---------------------------------------------------------------------

def proof_text(path: Column) -> Column:
    """All siblings of a path in a row."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def manifest(docs: DataFrame, leaf_columns: tuple[str, ...] = LEAF_COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
             changed: dict[str, Column] | None = None, changes: Column | None = None, fanout: int = FANOUT,
             span: int = SPAN) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, path`` and, where
    ``changes`` holds, ``changed_leaf``: the leaf with the columns of
    ``changed`` in place of its own (else the leaf itself)."""
    changed = changed or {}
    original = leaf_hash([F.col(c) for c in leaf_columns])
    other = leaf_hash([changed.get(c, F.col(c)) for c in leaf_columns])
    leaves = docs.select(F.col(id_col).alias("doc_id"), _group_key(F.col(group_col)).alias("grp"), original.alias("leaf"),
                         (F.when(changes, other) if changes is not None else F.lit(None).cast("string")).alias("changed_leaf"))
    leaves = placed(leaves, ["doc_id", "leaf"], "merkle-leaves")
    rounds, tops = fold_up(leaves.select("grp", "n", "pos", F.col("leaf").alias("h")), "merkle", fanout, span)

    # The sub-roots are the leaves of one more tree, in byte order of the group.
    subs = placed(tops.select(F.lit("").alias("grp"), F.col("grp").alias("g"), "h"), ["g"], "merkle-subroots")
    top_rounds, roots = fold_up(subs.select("grp", "n", "pos", "h"), "merkle-top", fanout, span)
    above = leaf_paths(subs, block_paths(top_rounds, None, "merkle-top", fanout, span), fanout, span)
    above = materialize(above.join(roots.select("grp", F.col("h").alias("root")), "grp")
                        .select(F.col("g").alias("grp"), F.col("path").alias("up"), F.col("h").alias("subroot"), "root"),
                        "merkle-above")

    blocks = block_paths(rounds, above.select("grp", "up"), "merkle", fanout, span)
    rows = leaf_paths(leaves, blocks, fanout, span).join(bounded_broadcast(above.drop("up")), "grp")
    return rows.select("doc_id", "leaf", "subroot", "root", "path", F.coalesce("changed_leaf", "leaf").alias("changed_leaf"))


def verify(rows: DataFrame) -> DataFrame:
    """``rows`` with ``proof_sha256``, ``folded_root`` (from the changed leaf and
    the original siblings) and ``verified``."""
    return (rows.withColumn("proof_sha256", F.sha2(proof_text(F.col("path")), 256))
            .withColumn("folded_root", fold(F.col("changed_leaf"), F.col("path")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))

"""Merkle manifest of a table: one tree per language, a tree over their roots, proofs of every row.

A row is a leaf: the hash of its fields, each with its byte count before it, a missing one as a
dash. Within a tree, leaves ascend by id; while several nodes remain, each run of consecutive
ones becomes the hash of their digests. Roots of the trees, a missing language first, then by
code point, are the leaves of the tree above.

Every level is an equijoin of the nodes with themselves: a node computes the indices of its
siblings (XOR where runs have two nodes, else offsets from its slot) and is sent to each; the
rows in slot zero, which then hold their whole run, emit the parents. Places of leaves come
from a range sort, counted by slice, so no tree is ever in one task, however large. Paths come down
again the same way, each node adding its siblings to the path of its parent. All digests are
binary in the tables and hex where they are hashed. Everything is SQL functions.

Empty texts are leaves like others, as are texts of any length, which no shuffle carries. Missing
ids come first. Of rows with the same id the one with the smaller leaf comes first; rows that
repeat all fields are leaves each and differ in place only. An empty table gives an empty
result. Columns that are not fields do not matter.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tables import quoted
from shelfwise.session import stage, unstage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
_SLICE_BITS = 33  # monotonically_increasing_id has the partition above these


def _nothing() -> Column:
    return F.lit("").cast("binary")


def field(value: Column) -> Column:
    """Byte count, colon, value; a dash if it is missing."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _hash(digests: Column) -> Column:
    """Hash of binary digests, as the concatenation of their hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def leaf(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*(field(f) for f in fields)), 256))


def sibling_indices(index: Column, arity: int) -> Column:
    """Indices of the other nodes in the run of a node, whether they exist or not."""
    if arity == 2:
        return F.array(index.bitwiseXOR(F.lit(1).cast("long")))
    slot = index % arity
    return F.array(*(index - slot + (slot + shift) % arity for shift in range(1, arity)))


def numbered(rows: DataFrame, tree: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with index and total: place within, and size of, their tree in ascending order.

    A range sort by tree and order deals large trees over many slices. Rows are counted by slice,
    and a place is the place in the slice plus the rows of the tree in earlier slices.
    """
    by = [tree, *order]
    dealt = stage(
        rows.repartitionByRange(*(F.col(c).asc_nulls_first() for c in by))
        .sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in by))
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("slice", F.shiftright("place", _SLICE_BITS)),
        name,
    )
    earlier = Window.partitionBy(tree).orderBy("slice")
    # one row per tree and slice: as many as partitions and trees
    slices = stage(
        dealt.groupBy(tree, "slice")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
        .select(
            tree,
            "slice",
            (F.sum("rows").over(earlier) - F.col("rows") - F.col("first")).alias("lift"),
            F.sum("rows").over(Window.partitionBy(tree)).alias("total"),
        ),
        f"{name}_slices",
    )
    return (
        dealt.join(slices, [tree, "slice"], "inner")
        .withColumn("index", F.col("place") + F.col("lift"))
        .drop("place", "slice", "lift")
    )


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (tree, index, total, digest) with the digests left and right of them in their run."""
    sent = nodes.filter("total > 1").select(
        "tree",
        (F.col("index") % arity).alias("slot"),
        F.col("digest").alias("sibling"),
        F.explode(sibling_indices(F.col("index"), arity)).alias("index"),
    )
    joined = nodes.join(sent, ["tree", "index"], "left")
    # at most arity - 1 siblings a node; the groups are dealt as the join is, so nothing moves again
    found = joined.groupBy("tree", "index", "total", "digest").agg(
        F.array_sort(F.collect_list(F.when(F.col("sibling").isNotNull(), F.struct("slot", "sibling")))).alias("run")
    )
    side = lambda chosen: F.aggregate(F.filter("run", chosen), _nothing(), lambda whole, one: F.concat(whole, one["sibling"]))
    slot = F.col("index") % arity
    return found.withColumn("left", side(lambda one: one["slot"] < slot)).withColumn("right", side(lambda one: one["slot"] > slot)).drop("run")


def parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes above: rows in slot zero hold their run, themselves first."""
    return level.filter((F.col("total") > 1) & (F.col("index") % arity == 0)).select(
        "tree",
        F.floor(F.col("index") / arity).cast("long").alias("index"),
        F.ceil(F.col("total") / arity).cast("long").alias("total"),
        _hash(F.concat("digest", "right")).alias("digest"),
    )


def levels(leaves: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """Written tables (tree, index, total, digest, left, right) from the leaves up to the roots.

    A tree ends at the level where its total is one.
    """
    found = [stage(with_siblings(leaves, arity), f"{name}_level")]
    while not (above := parents(found[-1], arity)).isEmpty():
        found.append(stage(with_siblings(above, arity), f"{name}_level"))
    return found


def roots(found: Sequence[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree."""
    return reduce(DataFrame.unionByName, [level.filter("total = 1").select("tree", "digest") for level in found])


def paths(found: Sequence[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """(tree, index, digest, top, path) of the lowest level.

    ``tops`` has (tree, top, path) of each tree: what a path begins with above its root. A path
    lists, from the bottom up, the digests left and right of each node on the way.
    """
    down = None
    for level in reversed(found):
        ended = level.filter("total = 1").join(tops, "tree", "inner").select("tree", "index", "digest", "top", "path")
        if down is None:
            down = ended
            continue
        above = down.select("tree", F.col("index").alias("parent"), "top", F.col("path").alias("rest"))
        inner = (
            level.filter("total > 1")
            .withColumn("parent", F.floor(F.col("index") / arity).cast("long"))
            .join(above, ["tree", "parent"], "inner")
            .select("tree", "index", "digest", "top", F.concat(F.array(F.struct("left", "right")), F.col("rest")).alias("path"))
        )
        down = ended.unionByName(inner)
    return down


def fold(path: Column, start: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, start, lambda node, step: _hash(F.concat(step["left"], node, step["right"])))


def proof(path: Column) -> Column:
    """Hash of the siblings on a path, bottom up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.lower(F.hex(F.concat(step["left"], step["right"])))), ""), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def manifest(
    docs: DataFrame,
    tampered: Column | None = None,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    tree_col: str = "lang",
    text_col: str = "text",
    arity: int = ARITY,
) -> DataFrame:
    """One row per row of ``docs``: the id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` tells of which rows a changed leaf, with A to Z of the text in lower case, is
    folded with the siblings of the original; it is verified only if the root comes out the same.
    """
    changed = [lower_ascii(quoted(f).cast("string")) if f == text_col else quoted(f) for f in fields]
    tree = F.coalesce(F.concat(F.lit("="), quoted(tree_col).cast("string")), F.lit("-"))  # a dash sorts first
    original = leaf([quoted(f) for f in fields])
    hashed = stage(
        docs.select(
            tree.alias("tree"),
            quoted(id_col).alias("id"),
            original.alias("digest"),
            (F.when(tampered, leaf(changed)) if tampered is not None else F.lit(None).cast("binary")).alias("changed"),
        ),
        "hashed_rows",
    )
    rows = stage(numbered(hashed, "tree", ["id", "digest"], "sorted_rows"), "leaves")
    unstage(hashed)
    found = levels(rows.select("tree", "index", "total", "digest"), arity, "tree")
    # one row per tree from here on
    subroots = stage(
        numbered(roots(found).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "tree", ["name"], "sorted_subroots"),
        "subroots",
    )
    upper = levels(subroots.select("tree", "index", "total", "digest"), arity, "root")
    no_path = F.array().cast("array<struct<left: binary, right: binary>>")
    top = roots(upper).select("tree", F.col("digest").alias("top"), no_path.alias("path"))
    tops = stage(
        paths(upper, top, arity)
        .join(subroots.select("index", "name"), "index", "inner")
        .select(F.col("name").alias("tree"), F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), "path"),
        "root_paths",
    )
    proved = paths(found, tops, arity).join(rows.select("tree", "index", "id", "changed"), ["tree", "index"], "inner")
    text = lambda digest: F.lower(F.hex(digest))
    return proved.select(
        F.col("id").alias(id_col),
        text("digest").alias("leaf"),
        text("top.subroot").alias("subroot"),
        text("top.root").alias("root"),
        proof(F.col("path")).alias("proof_sha256"),
        text(fold(F.col("path"), F.coalesce("changed", "digest"))).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

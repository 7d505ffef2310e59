"""Mixing sources to target weights by Sainte-Lague apportionment of equal word blocks.

Every source gets a target; the total is cut into blocks of ``BLOCK_WORDS`` words, which the
sources win as seats by highest quotients. A source deals its seats to its shards in the
same way, so each shard has a whole number of blocks to take. What a source's blocks differ from
its target, less than a block or all of a small source, is settled in words over its shards. In
a shard the documents stand in seeded order, and its quota takes every word equally often but
for a remainder, taken from blocks that are spread evenly from a seeded start, the last of them
in part. What a document gives is then plain arithmetic on its place in the shard: nothing is
listed block by block.

A missing text has no words. Sources are in code point order, a missing one last. Sources
and documents without words get nothing; repeated rows are documents of their own. An empty
table gives an empty result. Names of other columns do not matter.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tables import columns_of, quoted, whole_text
from shelfwise.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WORD_WITH_SPACE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 64
# a source of w words has sqrt(w) / SHARD_ROOT shards, so both their number and their size grow slowly
SHARD_ROOT = 64
SEED = "mix"
# more sources than this are joined by a shuffle instead
BROADCAST_SOURCES = 10_000


class Plan(NamedTuple):
    sources: DataFrame  # source, source_no, source_size, target, shards
    quotas: DataFrame  # source_no, shard, shard_size, blocks, quota (words), first


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def apportion(parties: DataFrame, group: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """``parties`` with a column ``won``: the seats of each party by highest quotients v/1, v/3, v/5...

    Seats at or over a divisor that gives too few in all are won for certain, those beyond a
    divisor that gives too many are lost for certain; only the seats between, about three per
    party, are ranked. Equal quotients go by ``party``.
    """
    every = Window.partitionBy(*group)
    bounds = (
        parties.withColumn("all_votes", F.sum(votes).over(every))
        .withColumn("contenders", F.sum(F.expr(f"int({votes} > 0)")).over(every))
        .withColumn("sure", F.expr(f"""CASE WHEN {votes} > 0 AND {seats} > contenders
            THEN bigint(floor({votes} * ({seats} - contenders) / all_votes + 0.5)) ELSE 0L END"""))
        .withColumn("most", F.expr(f"""CASE WHEN {votes} > 0
            THEN bigint(floor({votes} * ({seats} + contenders) / all_votes + 0.5)) ELSE 0L END"""))
        .withColumn("open", F.expr(f"{seats}") - F.sum("sure").over(every))
    )
    ranked = (
        bounds.withColumn("seat", F.explode(F.expr("CASE WHEN most > sure THEN sequence(sure + 1, most) ELSE array(0L) END")))
        .withColumn("quotient", F.expr(f"CASE WHEN seat > 0 THEN {votes} / (2 * seat - 1) ELSE -1D END"))
        .withColumn("place", F.row_number().over(every.orderBy(F.desc("quotient"), party, "seat")))
    )
    kept = [c for c in parties.columns if c not in group and c != party]
    return ranked.groupBy(*group, party).agg(
        *(F.first(c).alias(c) for c in kept),
        (F.first("sure") + F.sum(F.expr("bigint(seat > 0 AND place <= open)"))).alias("won"),
    )


def _targets(sizes: DataFrame) -> DataFrame:
    """Weights by position, shares of the total, and what exceeds a cap reshared by weight.

    In the order of cap by weight, a source is capped if its share of what the ones before
    leave is too much for it; from the first that is not, all get the same per weight.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy(F.lit(1)).orderBy(F.asc_nulls_last("source"))
    by_ratio = Window.partitionBy(F.lit(1)).orderBy("ratio", "source_no")
    everything = Window.partitionBy(F.lit(1))
    weights = ", ".join(f"{w}" for w in WEIGHTS)
    return (
        sources.withColumn("source_no", F.row_number().over(by_name))
        .withColumn("weight", F.expr(f"element_at(array({weights}), pmod(source_no - 1, {len(WEIGHTS)}) + 1)"))
        .withColumn("cap", F.expr(f"double({CAP} * source_size)"))
        .withColumn("ratio", F.expr("cap / weight"))
        .withColumn("capped_before", F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("wanted", F.expr(f"{SHARE}D") * F.sum("source_size").over(everything))
        .withColumn("level", F.expr("(wanted - capped_before) / weight_left"))
        .withColumn("level", F.min(F.expr("CASE WHEN ratio > level THEN struct(ratio, source_no, level) END")).over(everything))
        .withColumn("target", F.expr("CASE WHEN level IS NULL THEN cap ELSE least(cap, level.level * weight) END"))
        .withColumn("shards", F.expr(f"bigint(greatest(1, ceil(sqrt(source_size) / {SHARD_ROOT})))"))
        .withColumn("seats", F.expr("bigint(round(sum(target) OVER (PARTITION BY 1) / {}))".format(BLOCK_WORDS)))
        .withColumn("everyone", F.lit(1))
        .select("everyone", "source_no", "source", "source_size", "target", "shards", "seats")
    )


def _ticket(doc_id: str) -> str:
    """SQL of a document's seeded place, as 32 hexadecimal digits."""
    return f"md5(concat('{SEED}:', coalesce(string({doc_id}), '')))"


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (source, ticket, ...) with the number, the figures and the shard of the source."""
    table = sources.withColumnRenamed("source", "named")
    if sources.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    return rows.join(table, F.col("source").eqNullSafe(F.col("named")), "inner").withColumn(
        "shard", F.expr("pmod(bigint(conv(substr(ticket, 1, 8), 16, 10)), shards)")
    )


def plan_mix(sizes: DataFrame) -> Plan:
    """Targets and block quotas for ``sizes`` (source, ticket, size), which is read twice."""
    sources = stage(
        apportion(_targets(sizes), ["everyone"], "source_no", "target", "seats")
        .withColumnRenamed("won", "source_quota")
        .select("source", "source_no", "source_size", "target", "shards", "source_quota"),
        "mix_sources",
    )
    shards = (
        _with_source(sizes, sources)
        .groupBy("source_no", "shard")
        .agg(
            F.sum("size").alias("shard_size"),
            F.sum("size").cast("double").alias("votes"),
            *(F.first(c).alias(c) for c in ("source_quota", "source_size", "target")),
        )
    )
    # as many rows in a window as a source has shards
    of_source = Window.partitionBy("source_no")
    so_far = of_source.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    start = f"conv(substr(md5(concat('{SEED}:', string(source_no), ':', string(shard))), 1, 8), 16, 10)"
    quotas = (
        apportion(shards, ["source_no"], "shard", "votes", "source_quota")
        .withColumn("blocks", F.expr(f"greatest(1L, bigint(ceil(votes / {BLOCK_WORDS})))"))
        .withColumn("in_blocks", F.expr(f"least(won * {BLOCK_WORDS}, {CAP} * shard_size)"))
        .withColumn("open_words", F.expr("floor(target + 0.5)") - F.sum("in_blocks").over(of_source))
        .withColumn("size_so_far", F.sum("shard_size").over(so_far))
        .withColumn("settled", F.expr("bigint(floor(double(open_words) * size_so_far / greatest(source_size, 1L)))"))
        .withColumn("settled", F.col("settled") - F.coalesce(F.lag("settled").over(of_source.orderBy("shard")), F.lit(0)))
    )
    return Plan(
        sources,
        quotas.select(
            "source_no",
            "shard",
            "shard_size",
            "blocks",
            F.expr(f"greatest(0L, least(in_blocks + settled, {CAP} * shard_size))").alias("quota"),
            F.expr(f"pmod(bigint({start}), blocks)").alias("first"),
        ),
    )


def _picked_before(place: str) -> str:
    """SQL of the remainder blocks picked among the first ``place`` blocks of a shard."""
    return f"((({place}) + first) * picked div blocks - first * picked div blocks)"


def _taken_before(words: str) -> str:
    """SQL of the words taken from the first ``words`` words of a shard."""
    block = f"({words}) div {BLOCK_WORDS}"
    within = f"({words}) % {BLOCK_WORDS}"
    picked = f"({_picked_before(f'{block} + 1')} - {_picked_before(block)})"
    return f"rounds * ({words}) + least(rest, {BLOCK_WORDS} * {_picked_before(block)} + {within} * {picked})"


def place(rows: DataFrame, plan: Plan) -> DataFrame:
    """``rows`` (doc_id, source, ticket, size, ...) with their place in the shard and the words taken."""
    seeded = Window.partitionBy("source_no", "shard").orderBy("ticket", "doc_id", "size")
    return (
        _with_source(rows, plan.sources)
        .join(plan.quotas, ["source_no", "shard"], "inner")
        .withColumn("until", F.sum("size").over(seeded.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("since", F.expr("until - size"))
        .withColumn("rounds", F.expr("quota div greatest(shard_size, 1L)"))
        .withColumn("rest", F.expr("quota % greatest(shard_size, 1L)"))
        # one block more than the rest fills, as the last one of the shard may be short
        .withColumn("picked", F.expr(f"CASE WHEN rest > 0 THEN least(blocks, bigint(ceil(rest / {BLOCK_WORDS})) + 1) ELSE 0L END"))
        .withColumn("taken", F.expr(f"{_taken_before('until')} - ({_taken_before('since')})"))
    )


def _sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return stage(
        docs.select(
            quoted(id_col).alias("doc_id"),
            quoted(source_col).alias("source"),
            F.expr(_ticket(f"`{id_col}`")).alias("ticket"),
            word_count(whole_text(text_col)).alias("size"),
        ),
        "mix_sizes",
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sizes = _sizes(docs, id_col, source_col, text_col)
    return place(sizes, plan_mix(sizes)).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    length_col: str | None = None,
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document comes once for each full round
    its shard is taken, and once more with the words of its blocks that the remainder picks.

    ``length_col`` is set to the length of the text that a row then has. A text crosses the
    network once. Documents from which nothing is taken do not appear.
    """
    plan = plan_mix(_sizes(docs, id_col, source_col, text_col))
    rows = docs.select(
        quoted(id_col).alias("doc_id"),
        quoted(source_col).alias("source"),
        F.expr(_ticket(f"`{id_col}`")).alias("ticket"),
        word_count(whole_text(text_col)).alias("size"),
        F.struct(*columns_of(docs)).alias("row"),
    )
    chosen = f"{_picked_before('b + 1')} > {_picked_before('b')}"
    placed = (
        place(rows, plan)
        .filter("taken > 0")
        .withColumn("text", F.col("row").getField(text_col))
        .withColumn("part", F.expr("taken - rounds * size"))
        .withColumn("words", F.when(F.expr("part > 0 AND part < size"), F.regexp_extract_all("text", F.lit(WORD_WITH_SPACE), F.lit(0))))
        .withColumn("part_text", F.expr(f"""
            CASE WHEN part = size THEN text
                 WHEN part > 0 THEN array_join(transform(
                     filter(sequence(since div {BLOCK_WORDS}, (until - 1) div {BLOCK_WORDS}), b -> {chosen}),
                     b -> array_join(slice(words, int(greatest(b * {BLOCK_WORDS} - since, 0L)) + 1,
                         int(greatest(0L, least((b + 1) * {BLOCK_WORDS}, until, b * {BLOCK_WORDS} + rest - {BLOCK_WORDS} * {_picked_before('b')})
                             - greatest(b * {BLOCK_WORDS}, since)))), '')), '')
            END"""))
        .withColumn("mixed", F.explode(F.expr(
            "concat(array_repeat(text, int(rounds)), CASE WHEN part > 0 THEN array(part_text) ELSE array() END)")))
    )
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("mixed").alias(c))
        elif c == length_col:
            columns.append(F.length("mixed").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return placed.select(*columns)

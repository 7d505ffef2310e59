"""Ordered work inside groups of any size: running shares, quantile cuts, deciles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import stage


def cumulative_share(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    tiebreak: Sequence[str],
    prefix: str = "",
) -> DataFrame:
    """Running total of ``value`` from the largest down, and its share of the group.

    A group can be as large as a third of the table, so no window spans one. Rows are
    range partitioned by group and value, which cuts a large group into many slices;
    running totals are formed inside a slice and lifted by the sums of the slices
    before it. The sliced table is written once, because slice numbers must be the
    same for both uses.
    """
    order = [F.col(value).desc(), *(F.col(c).asc() for c in tiebreak)]
    # one key for group and slice: structs compare missing hierarchy levels as equal, and
    # the join and the window below share one shuffle by it
    sliced = stage(
        df.repartitionByRange(*(F.col(g) for g in group), *order).withColumn(
            "_at", F.struct(F.struct(*group).alias("group"), F.spark_partition_id().alias("slice"))
        ),
        "slices",
    )
    by_group = Window.partitionBy("_at.group")
    before = by_group.orderBy("_at.slice").rowsBetween(Window.unboundedPreceding, -1)
    lifts = (
        sliced.groupBy("_at")
        .agg(F.sum(value).alias("_sum"))
        .select(
            "_at",
            F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_lift"),
            F.sum("_sum").over(by_group).alias(f"{prefix}total"),
        )
    )
    within = (
        Window.partitionBy("_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.join(lifts, "_at", "inner")
        .withColumn(f"{prefix}running", F.col("_lift") + F.sum(value).over(within))
        .withColumn(f"{prefix}share", F.try_divide(F.col(f"{prefix}running"), F.col(f"{prefix}total")))
        .drop("_at", "_lift")
    )


# groups up to this many rows are sorted as they are; a task holds one easily
SORTED_ROWS = 1_000_000
ACCURACY = 10_000
ROUNDS = 4


def _rank(rows: Column, share: float) -> Column:
    """Rank of the first of ``rows`` values that at least so much of them reaches."""
    return F.greatest(F.lit(1), rows - F.floor(rows - rows * float(share)))


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equal keys; missing ones are equal too."""
    return reduce(lambda x, y: x & y, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))


def large_groups(df: DataFrame, group: Sequence[str], largest: int) -> DataFrame | None:
    """Keys of the groups with more than ``largest`` rows, at most rows / largest of them, or None."""
    large = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > largest).drop("_rows")
    return None if large.isEmpty() else stage(large, "large_groups")


def quantile_cuts(
    df: DataFrame,
    group: Sequence[str],
    values: Sequence[str],
    shares: Sequence[float],
    extra: Sequence[Column] = (),
    largest: int = SORTED_ROWS,
    near: Sequence[str] = (),
) -> DataFrame:
    """``{value}_cuts`` array per group: for each share the first value that at least so much of the group reaches.

    Exact for groups of any size. Groups up to ``largest`` rows are sorted by one shuffle, the
    aggregates ``extra`` included. In larger ones a mergeable sketch brackets each cut, and only
    values inside the brackets are shuffled (``selected_cuts``). Missing values do not count;
    a group without any has nulls. Rows to sort are dealt by ``near``, some columns of the group, if given.
    """
    large = large_groups(df, group, largest)
    if large is None:
        return _sorted_cuts(df.repartition(*near) if near else df, group, values, shares, extra)
    keyed = df.alias("d")
    small = keyed.join(large.alias("g"), _same("d", "g", group), "left_anti")
    big = keyed.join(large.alias("g"), _same("d", "g", group), "left_semi")
    long = big.select(
        F.struct(*group).alias("_group"),
        F.explode(F.array(*(F.struct(F.lit(i).alias("of"), F.col(v).cast("double").alias("value")) for i, v in enumerate(values)))).alias("_v"),
    ).select("_group", F.col("_v.of").alias("_of"), F.col("_v.value").alias("_value"))
    found = selected_cuts(long.filter("_value IS NOT NULL"), shares, largest)
    wide = found.groupBy("_group").agg(
        *(F.max(F.when(F.col("_of") == i, F.col("_cuts"))).alias(f"{v}_cuts") for i, v in enumerate(values))
    )
    rest = big.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"), *extra).withColumn("_group", F.struct(*group))
    out = rest.join(wide, "_group", "left").drop("_rows", "_group")
    return _sorted_cuts(small, group, values, shares, extra).unionByName(out)


def _sorted_cuts(
    df: DataFrame, group: Sequence[str], values: Sequence[str], shares: Sequence[float], extra: Sequence[Column]
) -> DataFrame:
    """The cuts from the ranks inside each group; windows and aggregate share one shuffle."""
    ranked = df
    for v in values:
        so_far = Window.partitionBy(*group).orderBy(v).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = ranked.withColumns(
            {f"_{v}_so_far": F.count(v).over(so_far), f"_{v}_all": F.count(v).over(Window.partitionBy(*group))}
        )
    cut = lambda v, s: F.min(F.when(F.col(f"_{v}_so_far") >= _rank(F.col(f"_{v}_all"), s), F.col(v).cast("double")))
    return ranked.groupBy(*group).agg(
        *extra, *(F.when(F.count(v) > 0, F.array(*(cut(v, s) for s in shares))).alias(f"{v}_cuts") for v in values)
    )


def selected_cuts(long: DataFrame, shares: Sequence[float], largest: int = SORTED_ROWS) -> DataFrame:
    """(_group, _of, _cuts) of the values (_group, _of, _value), without sorting them.

    Each round a sketch per cut names a bracket for it, and the values below and inside are
    counted, map side first. A bracket that misses its rank is opened to that side; one that still
    holds too many values is bracketed again from those. At last the values inside are counted by
    value and ranked from the number below: the sketch bounds the work and decides no result.
    """
    key = ["_group", "_of"]
    low, high = float("-inf"), float("inf")
    around = [min(max(s + side * 2 / ACCURACY, 0.0), 1.0) for s in shares for side in (-1, 1)]
    sketched = long.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"), F.percentile_approx("_value", [float(s) for s in around], ACCURACY).alias("_near")
    )
    # one row per group, value and share: few, as the groups are large
    wanted = F.array(
        *(
            F.struct(F.lit(i).alias("nth"), _rank(F.col("_rows"), s).alias("rank"), F.col("_near")[2 * i].alias("lo"), F.col("_near")[2 * i + 1].alias("hi"))
            for i, s in enumerate(shares)
        )
    )
    brackets = stage(sketched.select(*key, F.explode(wanted).alias("_c")).select(*key, "_c.*"), "brackets")
    done: list[DataFrame] = []
    for turn in range(ROUNDS):
        counted = stage(
            long.join(brackets, key, "inner")
            .groupBy(*key, "nth", "rank", "lo", "hi")
            .agg(F.count_if(F.col("_value") < F.col("lo")).alias("below"), F.count_if(F.col("_value").between(F.col("lo"), F.col("hi"))).alias("inside")),
            "bracket_counts",
        )
        hit = (F.col("below") < F.col("rank")) & (F.col("rank") <= F.col("below") + F.col("inside"))
        # one value, or few enough to rank; in the last round all that are hit
        ready = hit & ((F.col("lo") == F.col("hi")) | (F.col("inside") <= largest) | F.lit(turn == ROUNDS - 1))
        done.append(counted.filter(ready))
        rest = counted.filter(~ready)
        if rest.isEmpty():
            break
        if turn == ROUNDS - 1:
            done.append(rest.withColumns({"lo": F.lit(low), "hi": F.lit(high), "below": F.lit(0).cast("long")}))
            break
        missed = rest.filter(~hit).withColumns(
            {
                "lo": F.when(F.col("rank") <= F.col("below"), F.lit(low)).otherwise(F.col("hi")),
                "hi": F.when(F.col("rank") <= F.col("below"), F.col("lo")).otherwise(F.lit(high)),
            }
        ).select(*brackets.columns)
        inside = long.join(rest.filter(hit), key, "inner").filter(F.col("_value").between(F.col("lo"), F.col("hi")))
        steps = 1000
        share = (F.col("rank") - F.col("below")) / F.col("inside")
        at = lambda side: F.greatest(F.lit(0), F.least(F.lit(steps), F.floor(share * steps).cast("int") + side))
        narrower = (
            inside.groupBy(*key, "nth", "rank", "below", "inside")
            .agg(F.percentile_approx("_value", [i / steps for i in range(steps + 1)], ACCURACY).alias("_near"))
            .select(*key, "nth", "rank", F.get("_near", at(-2)).alias("lo"), F.get("_near", at(3)).alias("hi"))
        )
        brackets = stage(missed.unionByName(narrower), "brackets")
    found = reduce(DataFrame.unionByName, done).select(*key, "nth", "rank", "lo", "hi", "below")
    values = (
        long.join(found, key, "inner")
        .filter(F.col("_value").between(F.col("lo"), F.col("hi")))
        .groupBy(*key, "nth", "rank", "below", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    so_far = Window.partitionBy(*key, "nth").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        values.withColumn("_until", F.col("below") + F.sum("_n").over(so_far))
        .filter((F.col("rank") <= F.col("_until")) & (F.col("rank") > F.col("_until") - F.col("_n")))
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("nth", "_value"))).alias("_found"))
        .select(*key, F.col("_found._value").alias("_cuts"))
    )


def decile_of(value: Column, cuts: Column) -> Column:
    """1 for values from the highest cut up, 10 for values under the lowest."""
    return 10 - F.size(F.filter(cuts, lambda cut: cut <= value))


def deciles_by_level(
    totals: DataFrame, levels: Sequence[str], measures: Sequence[str], store: str = "store", largest: int = SORTED_ROWS
) -> DataFrame:
    """Deciles of every measure inside store × each prefix of the hierarchy ``levels``.

    A decile only hangs on how many values of the group are no greater, so rows of groups up to
    ``largest`` rows are ranked where they are: one shuffle by store and first level serves all
    levels. Larger groups get their cuts by ``quantile_cuts``, level by level, and only the levels
    below, whose groups are small again, are ranked.
    """
    shares = [i / 10 for i in range(1, 10)]
    keys = [store, *levels]
    rest, out, known = totals, [], []
    for depth in range(1, len(levels) + 1):
        own = keys[: depth + 1]
        large = large_groups(rest, own, largest)
        if large is None:
            break
        small = rest.alias("d").join(large.alias("g"), _same("d", "g", own), "left_anti")
        out.append(_ranked_deciles(small, keys, depth, measures, shares))
        rest = rest.alias("d").join(large.alias("g"), _same("d", "g", own), "left_semi")
        cuts = quantile_cuts(rest, own, measures, shares, largest=largest)
        rest = (
            rest.alias("d")
            .join(cuts.alias("c"), _same("d", "c", own), "inner")
            .select("d.*", *(decile_of(F.col(f"d.{m}"), F.col(f"c.{m}_cuts")).alias(f"{m}_decile_{levels[depth - 1]}") for m in measures))
        )
    else:
        depth = len(levels) + 1
    out.append(_ranked_deciles(rest, keys, depth, measures, shares))
    columns = [*totals.columns, *(f"{m}_decile_{level}" for level in levels for m in measures)]
    return reduce(DataFrame.unionByName, (part.select(*columns) for part in out))


def _ranked_deciles(
    rows: DataFrame, keys: Sequence[str], first: int, measures: Sequence[str], shares: Sequence[float]
) -> DataFrame:
    """``rows`` with the deciles of the levels from depth ``first`` down, by ranks."""
    columns = rows.columns
    for depth in range(first, len(keys)):
        own = Window.partitionBy(*keys[: depth + 1])
        for m in measures:
            so_far = own.orderBy(m).rangeBetween(Window.unboundedPreceding, Window.currentRow)
            rows = rows.withColumns({f"_{m}_so_far": F.count(m).over(so_far), f"_{m}_all": F.count(m).over(own)})
            reached = sum((F.col(f"_{m}_so_far") >= _rank(F.col(f"_{m}_all"), s)).cast("int") for s in shares)
            columns = [*columns, f"{m}_decile_{keys[depth]}"]
            rows = rows.withColumn(columns[-1], 10 - reached).select(*columns)
    return rows

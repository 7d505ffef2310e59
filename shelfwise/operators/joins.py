"""Joins whose keys are often missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 1 << 20


def left_join_spread(left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """``left`` joined to ``right`` on ``keys``, rows with a missing key dealt over all tasks.

    Such rows match nothing, yet a shuffled join would send all of them to one task. They get a
    second key from ``spread_by`` instead; rows with their keys have zero there, as ``right`` has.
    """
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    place = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)) + 1
    dealt = left.withColumn("_spread", F.when(missing, place).otherwise(F.lit(0).cast("long")))
    # zero for every row, yet no constant, which would vanish from the keys
    zero = F.pmod(F.xxhash64(*keys), F.lit(1).cast("long"))
    return dealt.join(right.withColumn("_spread", zero), [*keys, "_spread"], "left").drop("_spread")

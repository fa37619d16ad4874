"""Exact quantiles and even key ranges by rounds of counting, without a sort."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Buckets into which a round cuts each interval that still holds a bound.
BUCKETS = 256


@dataclass(frozen=True)
class _Open:
    """The ``rank``-th smallest value of [least, most] is bound ``part`` of a group."""

    group: int
    part: int
    rank: int
    least: float
    most: float


def equi_depth_bounds(values: DataFrame, parts: int) -> dict[int, list[float]]:
    """For each group of (group, x) the values at places ceil(j * n / parts), j = 1 to parts - 1, in order.

    A round counts the rows of every interval that holds an unknown bound in ``BUCKETS`` parts of even width, combined in
    the map tasks, and goes on inside the part that holds it; the part's own least and greatest value bound the next
    round, so a bound is found as soon as its part holds one value.  The driver receives ``BUCKETS`` rows for each
    interval, and there are at most ``parts`` - 1 in each group.  NULL and NaN do not count.
    """
    if parts < 1:
        raise ValueError("need at least one part")
    whole = isinstance(values.schema["x"].dataType, T.IntegralType)
    known = values.where(F.col("x").isNotNull() if whole else F.col("x").isNotNull() & ~F.isnan("x"))
    found: dict[int, dict[int, float]] = defaultdict(dict)
    open_bounds = []
    for r in known.groupBy("group").agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most")).collect():
        open_bounds += [_Open(r["group"], j, -(-j * r["n"] // parts), r["least"], r["most"]) for j in range(1, parts)]
    rounds = 0
    while True:
        for b in open_bounds:
            if b.least == b.most:
                found[b.group][b.part] = b.least
        open_bounds = [b for b in open_bounds if b.least < b.most]
        if not open_bounds:
            return {group: [bounds[j] for j in sorted(bounds)] for group, bounds in found.items()}
        # Parts of even width hardly tell values apart that differ by orders of magnitude.
        by_magnitude = not whole and rounds >= 2 and rounds % 2 == 0
        open_bounds = _narrowed(known, open_bounds, whole, by_magnitude)
        rounds += 1


def _narrowed(values: DataFrame, open_bounds: list[_Open], whole: bool, by_magnitude: bool) -> list[_Open]:
    kind = "bigint" if whole else "double"
    intervals = sorted({(b.group, b.least, b.most) for b in open_bounds})
    listed = values.sparkSession.createDataFrame(intervals, f"group int, least {kind}, most {kind}")
    # Differences of whole numbers are exact as long as they fit.
    fits = whole and max(most - least for _, least, most in intervals) < 1 << 62
    x, least, most = F.col("x"), F.col("least"), F.col("most")

    def beyond(value: Column) -> Column:
        return (value - least).cast("double") if fits else value.cast("double") / 2 - least.cast("double") / 2

    place = F.floor(beyond(x) / beyond(most) * BUCKETS)
    if by_magnitude:
        # Negative, zero, positive; then by logarithm within one sign.
        up, down = F.ln(x / least) / F.ln(most / least), 1 - F.ln(x / most) / F.ln(least / most)
        place = (
            F.when((least < 0) & (most > 0), F.signum(x) + 1)
            .when((least > 0) & (most / least < float("inf")), F.floor(up * BUCKETS))
            .when((most < 0) & (least / most < float("inf")), F.floor(down * BUCKETS))
            .otherwise(place)
        ).cast("bigint")
    # As many intervals as there are bounds.
    counted = (
        values.join(F.broadcast(listed), "group")
        .where(F.col("x").between(F.col("least"), F.col("most")))
        .groupBy("group", "least", F.least(place, F.lit(BUCKETS - 1)).alias("place"))
        .agg(F.count("*").alias("n"), F.min("x").alias("from"), F.max("x").alias("to"))
        .collect()
    )
    buckets = defaultdict(list)
    for r in sorted(counted, key=lambda r: r["place"]):
        buckets[r["group"], r["least"]].append(r)
    out = []
    for b in open_bounds:
        rank = b.rank
        for r in buckets[b.group, b.least]:
            if rank <= r["n"]:
                out.append(_Open(b.group, b.part, rank, r["from"], r["to"]))
                break
            rank -= r["n"]
    return out


def range_bounds(df: DataFrame, key: str, parts: int) -> list[float]:
    """Upper ends of all even ranges of a numeric key but the last; fewer where one value fills several ranges."""
    bounds = equi_depth_bounds(df.select(F.lit(0).alias("group"), F.col(key).alias("x")), parts).get(0, [])
    most = df.agg(F.max(key)).first()[0]
    return sorted({b for b in bounds if b < most})


def key_ranges(df: DataFrame, key: str, parts: int) -> DataFrame:
    """(range, lower, upper, n): rows with lower < key <= upper.  The last range has no upper end; NULL keys have range -1."""
    bounds = range_bounds(df, key, parts)
    kind = df.schema[key].dataType
    ends = [None, *bounds, None]
    spans = [(-1, None, None)] + [(i, ends[i], ends[i + 1]) for i in range(len(bounds) + 1)]
    ranges = df.sparkSession.createDataFrame(
        spans, T.StructType([T.StructField("range", T.IntegerType()), T.StructField("lower", kind), T.StructField("upper", kind)])
    )
    place = F.size(F.filter(F.array(*map(F.lit, bounds)).cast(T.ArrayType(kind)), lambda b: b < F.col(key)))
    counts = df.groupBy(F.when(F.col(key).isNull(), -1).otherwise(place).alias("range")).agg(F.count("*").alias("n"))
    return ranges.join(counts, "range", "left").select("range", "lower", "upper", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def range_predicates(key: str, bounds: list[float]) -> list[str]:
    """SQL conditions of the ranges, each row in exactly one: NULL keys have a range of their own."""
    ends = [None, *bounds, None]
    parts = [
        " AND ".join([f"{key} > {low}"] * (low is not None) + [f"{key} <= {high}"] * (high is not None)) or f"{key} IS NOT NULL"
        for low, high in zip(ends[:-1], ends[1:], strict=True)
    ]
    return [f"{key} IS NULL", *parts]

"""Matches of a pattern with their places in the text, as column expressions.

Spark returns what a pattern matched but not where.  The pieces between the
matches tell: matches and pieces alternate, so a match starts after all pieces
and matches before it.  Places count code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Running sums are formed inside blocks of this size first, so their cost stays near linear.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, value: Callable[[Column], Column]) -> Column:
    """struct<total, before>: the sum and the exclusive running sums."""
    return F.aggregate(
        values,
        F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before")),
        lambda acc, x: F.struct(
            (acc["total"] + value(x)).alias("total"),
            F.concat(acc["before"], F.array(acc["total"])).alias("before"),
        ),
    )


def starts(lengths: Column) -> Column:
    """Exclusive running sums of a bound array of whole numbers (see :func:`let`), not empty."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: _running(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)), lambda x: x),
    )

    def joined(bound: Column) -> Column:
        offsets = _running(bound, lambda block: block["total"])["before"]
        return F.flatten(F.zip_with(bound, offsets, lambda block, at: F.transform(block["before"], lambda x: x + at)))

    return let(blocks, joined)


def find(text: Column, pattern: str, guard: Column | None = None, context: int = 0) -> Column:
    """array<struct<start, end, value, before, after>>: leftmost non-overlapping matches, end exclusive.

    ``guard`` must hold in every text with a match; other texts are not searched.
    ``before`` and ``after`` hold up to ``context`` code points around the match, up to
    its neighbours.  A match must not be empty.
    """
    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")

    def placed(p: Column) -> Column:
        values, gaps = p["values"], p["gaps"]
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.length(g) + F.length(v))
        whole = let(
            lengths,
            lambda bound: F.transform(
                F.arrays_zip(values.alias("value"), starts(bound).alias("at")),
                lambda m, i: F.struct(
                    (m["at"] + F.length(F.get(gaps, i))).alias("start"),
                    (m["at"] + F.length(F.get(gaps, i)) + F.length(m["value"])).alias("end"),
                    m["value"].alias("value"),
                    (F.right(F.get(gaps, i), F.lit(context)) if context else F.lit("")).alias("before"),
                    (F.left(F.get(gaps, i + 1), F.lit(context)) if context else F.lit("")).alias("after"),
                ),
            ),
        )
        return F.when(F.size(values) > 0, whole).otherwise(empty)

    pieces = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("gaps")
    )
    searched = text.isNotNull() if guard is None else text.isNotNull() & guard
    return F.when(searched, let(pieces, placed)).otherwise(empty)


def label(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas.

    ``spans`` is an array of structs that begin with (start, kind_no, end).
    """
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", names[s["kind_no"]], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_kind(spans: Column, kind_no: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind_no"] == kind_no)).cast("bigint")

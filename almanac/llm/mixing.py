"""Mix sources to target weights.

Every document gets a key that is random but repeatable.  A source whose budget
is ``e`` whole epochs and a rest gives every document ``e`` times, then documents in the
order of their keys until the rest is used up; the last one is cut so that the
budget is met exactly.

Keys fall into 16 ** ``RANGE_DIGITS`` equal ranges.  The words of each source and range are
summed, running sums over the ranges tell in which range the source's cut lies,
and only the documents of that one range are sorted.  All others are taken or
left by their range alone, so no text is shuffled.

Nulls and odd rows: a null text has size 0 and takes no part; an empty table gives an empty result.
A null source is a source of its own, ordered last.  Repeated rows are documents
of their own.  Keys depend on ``doc_id`` and text, so rows that agree in both are
interchangeable.  Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.apart import own_columns_apart
from almanac.operators.indexing import with_row_index
from almanac.staging import stage

WORD = r"[^\x20\x09-\x0D]+"

# Equal parts of the key space, as hex digits of the key.
RANGE_DIGITS = 3

# A source repeats at most so often.
MOST_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(seed: int, doc_id: Column, text: Column) -> Column:
    """32 hex digits."""
    return F.md5(
        F.concat_ws(
            ":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit(""))
        )
    )


def targets(sources: DataFrame, weights: tuple[float, ...], most_epochs: int) -> DataFrame:
    """``sources`` (source, size) with its target: a share of all sizes by weight, at most ``most_epochs`` sizes.

    Weights go to sources in code point order, null last, and repeat.  What a full
    source cannot take is shared among the others by weight, until none is above.
    Each round of sharing is one sum over the sources.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = with_row_index(sources, [F.col("source").asc_nulls_last()], "place")
    ranked = stage(
        placed.withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int")))
        .withColumn("most", F.col("size") * most_epochs)
        .drop("place"),
        "sources",
    )
    total = ranked.agg(F.sum("size")).first()[0] or 0
    level, full_before = 0.0, -1
    while True:
        full = F.col("weight") * level >= F.col("most")
        state = ranked.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(full, 1)).alias("full"),
        ).first()
        if state["full"] == full_before or state["open"] == 0:
            break
        level, full_before = (total - state["held"]) / state["open"], state["full"]
    return ranked.select(
        "source", "size", F.least(F.col("most").cast("double"), F.col("weight") * level).alias("target")
    )


@own_columns_apart
def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    seed: int = 6,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """``docs`` with size, source_size, target, epochs, tail and taken.

    ``epochs`` whole copies and the first ``tail`` words of one more make ``taken`` words.
    """
    added = ("size", "source_size", "target", "epochs", "tail", "taken")
    key = random_key(seed, F.col("doc_id"), F.col("text"))
    keyed = (
        docs.drop(*added)
        .withColumn("size", word_count(F.col("text")))
        .withColumn("__key", key)
        .withColumn("__range", F.conv(F.substring("__key", 1, RANGE_DIGITS), 16, 10).cast("int"))
    )
    ranges = stage(
        keyed.groupBy("source", "__range").agg(F.sum("size").alias("words")), "range-sizes"
    )
    shares = targets(ranges.groupBy("source").agg(F.sum("words").alias("size")), weights, most_epochs)
    # The target as whole words, its whole epochs and the rest.
    budget = F.round("target").cast("bigint")
    shares = shares.withColumn(
        "epochs", F.when(F.col("size") > 0, F.floor(budget / F.col("size"))).otherwise(0).cast("bigint")
    ).withColumn("rest", budget - F.col("epochs") * F.col("size"))
    running = Window.partitionBy("source").orderBy("__range")
    cuts = stage(
        ranges.withColumn("words_to", F.sum("words").over(running))
        .withColumnRenamed("source", "__of")
        .join(shares, F.col("__of").eqNullSafe(F.col("source")))
        .groupBy("__of")
        .agg(
            F.first("size").alias("source_size"),
            F.first("target").alias("target"),
            F.first("epochs").alias("epochs"),
            F.first("rest").alias("__rest"),
            # The first range that does not fit as a whole, and the words before it.
            F.min(F.when(F.col("words_to") > F.col("rest"), F.col("__range"))).alias("__cut"),
            F.min(F.when(F.col("words_to") > F.col("rest"), F.col("words_to") - F.col("words"))).alias("__before"),
        ),
        "source-cuts",
    )
    dealt = keyed.join(cuts, F.col("source").eqNullSafe(F.col("__of")), "left").withColumn(
        "__side", F.when(F.col("__cut").isNull() | (F.col("__range") < F.col("__cut")), -1)
        .when(F.col("__range") == F.col("__cut"), 0).otherwise(1)
    )
    before = F.col("__before") + F.sum("size").over(
        Window.partitionBy("source", "__range").orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)
    )
    fits = F.greatest(F.lit(0), F.least(F.col("size"), F.col("__rest") - F.coalesce(before, F.col("__before"))))
    cut = dealt.where("__side = 0").withColumn("tail", fits.cast("bigint"))
    whole = dealt.where("__side <> 0").withColumn("tail", F.when(F.col("__side") < 0, F.col("size")).otherwise(0).cast("bigint"))
    return (
        whole.unionByName(cut)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("tail"))
        .drop("__key", "__range", "__of", "__rest", "__cut", "__before", "__side")
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every whole copy and the cut copy of ``docs`` as a row, columns as given.

    A cut copy holds the words taken from it and the white space between them; where ``n_chars`` is given it is counted anew.
    """
    mixed = mix(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("__doc")), **how)
    whole = F.when(F.col("tail") == F.col("size"), F.col("epochs") + 1).otherwise(F.col("epochs"))
    copies = mixed.where("size > 0").withColumn("__whole", whole)
    full = copies.where("__whole > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__whole"))))
    space = r"[\x20\x09-\x0D]*+"
    start = F.concat(
        F.lit(f"^{space}(?:{WORD}+{space}){{"), (F.col("tail") - 1).cast("string"), F.lit(f"}}+{WORD}+")
    )
    cut = copies.where("tail > 0 AND tail < size").withColumn("__cut", F.regexp_substr(F.col("text"), start))
    doc = F.col("__doc").withField("text", F.col("__cut"))
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length("__cut").cast(docs.schema["n_chars"].dataType))
    return full.select("__doc").unionByName(cut.select(doc.alias("__doc"))).select("__doc.*")

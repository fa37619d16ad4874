"""Secrets: listed patterns, then tokens that read like random strings.

The patterns find assignments to a secret's name, access keys and long hexadecimal
numbers.  Other long tokens are judged by two first-order Markov models of their characters: one
of random strings, trained on the secret parts the patterns found, and one of ordinary identifiers and words,
trained on the tokens that occur in two different texts.  A token of ``SHORTEST`` characters or more is reported if the
log-likelihood ratio of the two models exceeds ``RATE`` for each of its characters (in ln units), as it stands and in lower
case, so that a word in capitals is no secret.  Nothing else is asked of it: secrets of letters only, or of digits only, are
judged like any other.

Training reads the tokens of about ``SAMPLE_ROWS`` documents, drawn by a hash; a token counts once, however often it occurs.  The random model is half
uniform, so random strings over other letters than the samples' count as random too; without any
sample both models are uniform and nothing is added.  Together they are one number, in thousandths, for each pair of characters.

Nulls and odd rows: a null or empty text has no spans.  Repeated rows count as often as they occur and get
the same spans.  An empty table gives an empty result.  Other columns may be null and are passed on; those named
like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm import spans
from almanac.staging import stage

KINDS = ("assign", "access", "hex", "random")
RANDOM = KINDS.index("random")

# The patterns, written so that a search never looks twice at a long run.
VALUE = r"[A-Za-z0-9+/_.=-]"
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+(" + VALUE + "++)"
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"

# Characters of a token; the models number them in this order, from 1, and 0 stands before the first.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN_CHARACTER = "[A-Za-z0-9+/_=-]"

# Start state and characters.
STATES = len(ALPHABET) + 1

# Uniform part of each model; the ordinary one falls back on how often a character occurs at all.
RANDOM_EVEN, ORDINARY_EVEN, BACK_OFF = 0.5, 0.1, 10.0

# Shortest token judged and shortest one that is an ordinary sample, documents sampled for training, least log-likelihood
# ratio of a character.
SHORTEST, SHORTEST_SAMPLE = 16, 4
SAMPLE_ROWS = 20000
RATE = 0.7


def _token(shortest: int) -> str:
    return f"(?<!{TOKEN_CHARACTER}){TOKEN_CHARACTER}{{{shortest},}}+"


def base_spans(text: Column) -> Column:
    """array<struct<start, kind_no, end, secret>>, kind by kind."""

    def secret(value: Column, kind: int) -> Column:
        return F.regexp_extract(value, ASSIGN, 1) if kind == 0 else value

    found = (
        (ASSIGN, text.rlike(ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 1)) >= 6),
        (ACCESS, text.contains("AKIA"), lambda m: F.lit(True)),
        (HEX, text.rlike(HEX), lambda m: F.lit(True)),
    )

    def of_kind(kind: int, pattern: str, guard: Column, passes: Callable[[Column], Column]) -> Column:
        return F.transform(
            F.filter(spans.find(text, pattern, guard), passes),
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(kind).alias("kind_no"), m["end"].alias("end"),
                secret(m["value"], kind).alias("secret"),
            ),
        )

    return F.concat(*[of_kind(number, *kind) for number, kind in enumerate(found)])


def other_tokens(text: Column, base: Column, shortest: int) -> Column:
    """Long tokens with their places, outside all base spans."""
    tokens = spans.find(text, _token(shortest), text.rlike(f"{TOKEN_CHARACTER}{{{shortest}}}"))
    return F.filter(
        tokens, lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )


def steps(token: Column) -> Column:
    """Numbers of the token's pairs of neighbouring characters; the first follows the start state."""
    places = F.transform(
        F.sequence(F.lit(1), F.length(token)),
        lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1))).cast("int"),
    )
    return spans.let(
        places,
        lambda p: F.transform(p, lambda to, i: F.when(i == 0, 0).otherwise(F.get(p, i - 1)) * STATES + to),
    )


def ordinary_tokens(docs: DataFrame, shortest: int = SHORTEST_SAMPLE) -> DataFrame:
    """(token): tokens outside the patterns' matches that occur in two different texts, each once."""
    outside = F.regexp_replace("text", "|".join((ASSIGN, ACCESS, HEX)), " ")
    tokens = F.array_distinct(F.regexp_extract_all(outside, F.lit(_token(shortest)), F.lit(0)))
    in_text = docs.select(F.xxhash64("text").alias("of"), F.explode(tokens).alias("token"))
    return in_text.groupBy("token").agg(F.min("of").alias("one"), F.max("of").alias("other")).where("one <> other").select("token")


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Column:
    """The log-likelihood ratios of all pairs of characters as one constant array, in thousandths."""
    rows = docs.count()
    share = min(1.0, sample_rows / rows) if rows else 1.0
    drawn = docs.where(F.pmod(F.xxhash64("text", F.lit("secrets")), F.lit(1 << 30)) < share * (1 << 30))
    secrets = drawn.select(F.explode(base_spans(F.col("text"))).alias("s")).select(
        F.regexp_replace("s.secret", "[^" + TOKEN_CHARACTER[1:], "").alias("token")
    )
    labelled = secrets.distinct().withColumn("random", F.lit(True)).unionByName(
        ordinary_tokens(drawn).withColumn("random", F.lit(False))
    )
    counts = stage(
        labelled.where("token <> ''")
        # Each pair once a token, so that one very long token does not outweigh the others.
        .select("random", F.explode(F.array_distinct(steps(F.col("token")))).alias("step"))
        .groupBy("step")
        .agg(F.count(F.when(F.col("random"), 1)).alias("random"), F.count(F.when(~F.col("random"), 1)).alias("ordinary")),
        "character-pairs",
    )
    grid = docs.sparkSession.range(STATES * STATES).select(
        F.col("id").cast("int").alias("step"), F.floor(F.col("id") / STATES).alias("state"), (F.col("id") % STATES).alias("to")
    )
    times = {model: F.coalesce(model, F.lit(0)) for model in ("random", "ordinary")}
    all_ordinary = counts.agg(F.sum("ordinary")).first()[0] or 0
    even = 1.0 / len(ALPHABET)

    def of_state(model: str) -> Column:
        return F.sum(times[model]).over(Window.partitionBy("state"))

    anywhere = F.sum(times["ordinary"]).over(Window.partitionBy("to")) / all_ordinary if all_ordinary else F.lit(even)
    ordinary = (1 - ORDINARY_EVEN) * (times["ordinary"] + BACK_OFF * anywhere) / (
        of_state("ordinary") + BACK_OFF
    ) + ORDINARY_EVEN * even
    random = (1 - RANDOM_EVEN) * F.when(
        of_state("random") > 0, times["random"] / F.greatest(of_state("random"), F.lit(1))
    ).otherwise(even) + RANDOM_EVEN * even
    table = grid.join(counts, "step", "left").select(
        "step", F.round(1000 * F.ln(random / ordinary)).cast("int").alias("ratio")
    )
    # One number for each pair of characters, whatever the data.
    listed = ",".join(str(r["ratio"]) for r in table.orderBy("step").collect())
    return F.split(F.lit(listed), ",").cast("array<int>")


def scan(
    docs: DataFrame, shortest: int = SHORTEST, rate: float = RATE, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``docs`` with spans, an array of (start, kind_no, end): pattern matches and random tokens, in order."""
    docs = docs.drop("spans")
    ratio_of = train(docs, sample_rows)

    def random(token: Column) -> Column:
        def is_random(spelling: Column) -> Column:
            total = F.aggregate(steps(spelling), F.lit(0), lambda acc, step: acc + F.get(ratio_of, step))
            return total > F.lit(1000 * rate) * F.length(spelling)

        return is_random(token) & is_random(F.lower(token))

    def all_spans(base: Column) -> Column:
        added = F.filter(other_tokens(F.col("text"), base, shortest), lambda t: random(t["value"]))

        def span(s: Column, kind: Column) -> Column:
            return F.struct(s["start"].alias("start"), kind.alias("kind_no"), s["end"].alias("end"))

        return F.array_sort(
            F.concat(F.transform(base, lambda s: span(s, s["kind_no"])), F.transform(added, lambda s: span(s, F.lit(RANDOM))))
        )

    return docs.withColumn("spans", spans.let(base_spans(F.col("text")), all_spans))

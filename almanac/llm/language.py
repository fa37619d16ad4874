"""Language by prediction by partial matching (PPM) over bytes.

A text is coded once with each language's context tree, and the language with
the shortest code wins.  A tree holds how often each byte followed each context of
0 to ``ORDER`` bytes.  The code length of a byte in a context of order k is

    -log2(count / (total + kinds))     if the byte has followed the context,
    -log2(kinds / (total + kinds))     plus its length at order k - 1 otherwise

(the escape probability counts each kind of byte seen, method C); a context never
seen costs nothing and passes on to order k - 1; below order 0 all 256 bytes are alike.
Statistics stay as trained while a text is scored.  Texts are reduced to their letters first: lower
case, other characters to single blanks.

Training counts on a sample of at most about ``MOST_BYTES`` of text for each language (documents
drawn by a hash of the text, whole texts), summed in Spark.  The trees are bounded by that sample.

Whether a text is readable is never judged by trees that hold its own grams: texts fall into two
folds by a hash of their letters, so copies share a fold, and each fold is judged by the other's trees.

Scoring is exact and vectorised: code lengths for the (order + 1)-grams that the trees know are
laid out in one table for all languages; any other gram of a batch is worked out once by the rule above.

Nulls and odd rows: a text that is null or has no letter is ``und`` with score 0, bits_per_byte null. Without any
labelled text everything is ``und``.  Ties go to the smaller language name.  Empty tables
give an empty result.  Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.apart import own_columns_apart

UNDETERMINED = "und"

# Longest context in bytes; a gram of ORDER + 1 bytes fits a 64-bit number.
ORDER = 4

# Bytes of training text for each language.
MOST_BYTES = 1 << 20

# Folds of the texts to be judged.
FOLDS = 2

# Bytes scored at once.
CHUNK = 1 << 20

RESULT = "struct<lang_pred:string,score:double,bits_per_byte:double>"


def letters(text: Column) -> Column:
    """Lower-case letters and single blanks; null where there is no letter."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))
    return F.when(plain.rlike(r"\p{L}"), plain)


def grams(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the bytes of ``texts`` with their ``length - 1`` predecessors, and where each text ends.

    A text is preceded by blanks, so its first bytes have full contexts.
    """
    pad = b" " * (length - 1)
    raw = np.frombuffer(pad.join([b"", *texts]) if texts else b"", dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.zeros(max(0, len(raw) - length + 1), dtype=np.uint64)
    for at in range(length):
        codes = codes << np.uint64(8) | raw[at : at + len(codes)]
    # Between two texts stand windows that end in the padding.
    starts = np.concatenate([[0], np.cumsum(sizes + length - 1)[:-1]]) if len(sizes) else sizes
    keep = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    return codes[keep].astype(np.int64), sizes


class Trees:
    """Context trees of all languages, frozen."""

    def __init__(self, languages: list[str], counts: list[tuple[int, int, int]] | np.ndarray, order: int = ORDER):
        """``counts``: (language number, gram code of order + 1 bytes, times)."""
        self.languages, self.order = languages, order
        table = np.array(counts, dtype=np.int64).reshape(-1, 3)
        self.levels = [[self._level(table[table[:, 0] == k, 1:], n) for n in range(order + 1)] for k in range(len(languages))]
        known = np.unique(table[:, 1])
        lengths = self.code_lengths(known)
        # Direct-mapped by hash: a slot holds one gram, the rest are worked out when met.
        bits = max(4, int(len(known) * 2 - 1).bit_length())
        self.slot_shift = np.uint64(64 - bits)
        self.slot_grams = np.full(1 << bits, -1, dtype=np.int64)
        self.slot_lengths = np.zeros((1 << bits, len(languages)), dtype=np.float32)
        self.slot_grams[slots := self._slots(known)] = known
        self.slot_lengths[slots] = lengths

    @staticmethod
    def _level(counts: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """Of order n: (grams, bits of the last byte), (contexts, bits of the escape)."""
        shortened = counts[:, 0] & ((1 << 8 * (n + 1)) - 1)
        seen, at = np.unique(shortened, return_inverse=True)
        times = np.bincount(at, weights=counts[:, 1], minlength=len(seen))
        contexts, owner, kinds = np.unique(seen >> 8, return_inverse=True, return_counts=True)
        totals = np.bincount(owner, weights=times, minlength=len(contexts))
        return seen, np.log2((totals + kinds)[owner] / times), contexts, np.log2((totals + kinds) / kinds)

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.slot_shift).astype(np.int64)

    def code_lengths(self, codes: np.ndarray) -> np.ndarray:
        """(grams, languages): bits to code each gram's last byte after the others, by the rule."""
        out = np.zeros((len(codes), len(self.languages)))
        for k, levels in enumerate(self.levels):
            open_, bits = np.ones(len(codes), dtype=bool), np.zeros(len(codes))
            for n in range(self.order, -1, -1):
                seen, cost, contexts, escape = levels[n]
                gram = codes & ((1 << 8 * (n + 1)) - 1)
                hit, at = _found(seen, gram)
                bits += np.where(open_ & hit, cost[at], 0.0) if len(seen) else 0.0
                open_ &= ~hit
                known, at = _found(contexts, gram >> 8)
                bits += np.where(open_ & known, escape[at], 0.0) if len(contexts) else 0.0
            out[:, k] = bits + 8.0 * open_
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): bits to code each text."""
        codes, sizes = grams(texts, self.order + 1)
        slots = self._slots(codes)
        lengths = self.slot_lengths[slots].astype(np.float64)
        missed = np.flatnonzero(self.slot_grams[slots] != codes)
        if len(missed):
            rare, at = np.unique(codes[missed], return_inverse=True)
            lengths[missed] = self.code_lengths(rare)[at]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(lengths, starts, axis=0)


def _found(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values stand in a sorted table, and where."""
    if not len(table):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values, at


def fold_of(text: bytes, folds: int) -> int:
    """Fold of a text as scored; copies share it."""
    return zlib.crc32(text) % folds


def train(docs: DataFrame, order: int = ORDER, most_bytes: int = MOST_BYTES) -> Trees:
    """Trees from (text, lang) rows with a language and a letter."""
    return train_folds(docs, 1, order, most_bytes)[0]


def train_folds(docs: DataFrame, folds: int = FOLDS, order: int = ORDER, most_bytes: int = MOST_BYTES) -> list[Trees]:
    """For each fold of the texts, trees of its texts alone; a fold without any has empty trees."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    place = F.pmod(F.xxhash64("text", F.lit("ppm")), F.lit(1 << 30))
    found = labelled.where(F.col("text").rlike(r"\p{L}")).groupBy("lang").agg(
        F.sum(F.octet_length("text")).alias("n"), F.min(place).alias("first")
    ).collect()
    sizes, first = {r["lang"]: r["n"] for r in found}, {r["lang"]: r["first"] for r in found}
    languages = sorted(sizes)
    if not languages:
        return [Trees([], [], order)] * folds
    # All folds are drawn at once, so each gets about ``most_bytes`` of a language.  The draw goes by the text, so equal texts
    # are drawn together, and a language's first text always is: a few long texts may else all be missed.
    bound = F.create_map(
        *[
            x for l in languages
            for x in (F.lit(l), F.lit(max(first[l] + 1, round(min(1.0, folds * most_bytes / max(1, sizes[l])) * (1 << 30)))))
        ]
    )
    drawn = place < F.element_at(bound, F.col("lang"))
    number = F.array_position(F.array(*[F.lit(l) for l in languages]), F.col("lang")) - 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            owners = batch.column(0).to_numpy() * folds + np.array([fold_of(t, folds) for t in texts], dtype=np.int64)
            for k in np.unique(owners):
                codes, _ = grams([t for t, o in zip(texts, owners, strict=True) if o == k], order + 1)
                seen, times = np.unique(codes, return_counts=True)
                yield pa.record_batch(
                    [pa.array(np.full(len(seen), k)), pa.array(seen), pa.array(times)], names=["k", "gram", "times"]
                )

    counts = (
        labelled.where(drawn).select(number.cast("bigint").alias("k"), letters(F.col("text")).alias("text"))
        .where("text IS NOT NULL")
        .mapInArrow(counted, "k bigint, gram bigint, times bigint")
        .groupBy("k", "gram").agg(F.sum("times").alias("times"))
    )
    table = np.array([tuple(r) for r in counts.collect()], dtype=np.int64).reshape(-1, 3)

    def of_fold(fold: int) -> Trees:
        own = table[table[:, 0] % folds == fold]
        # A language of which nothing was learnt has no tree: an empty one would code any unfamiliar text best.
        learnt, number = np.unique(own[:, 0] // folds, return_inverse=True)
        return Trees([languages[k] for k in learnt], np.column_stack([number.reshape(-1), own[:, 1:]]), order)

    return [of_fold(fold) for fold in range(folds)]


@own_columns_apart
def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with lang_pred, score (share of the best code's probability per byte) and bits_per_byte (of that code)."""
    return _predicted(docs, trees, scored)


def _predicted(docs: DataFrame, trees: Trees | list[Trees], score: Callable[..., pa.Array]) -> DataFrame:
    kept = docs.drop("lang_pred", "score", "bits_per_byte")
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield score(sent.value, texts.cast(pa.binary()).to_pylist())

    of_batches.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return kept.withColumn("__scored", F.arrow_udf(of_batches, RESULT)(letters(F.col("text")))).select(
        *kept.columns, "__scored.*"
    )


def readable(docs: DataFrame, trees: list[Trees], most_bits: float) -> DataFrame:
    """``docs`` as given, without those that have no letter or take ``most_bits`` or more per byte in every language.

    ``trees`` of :func:`train_folds`.  If all training texts are of one fold, there is nothing to judge its texts
    by, and they stay.
    """
    predicted = _predicted(docs.select("text", F.struct(*docs.columns).alias("__doc")), trees, scored_apart)
    kept = (F.col("lang_pred") != UNDETERMINED) & (F.col("bits_per_byte") < most_bits)
    if any(t.languages for t in trees) and not all(t.languages for t in trees):
        kept |= (F.col("lang_pred") == UNDETERMINED) & letters(F.col("text")).isNotNull()
    return predicted.where(kept).select("__doc.*")


def scored_apart(trees: list[Trees], texts: list[bytes | None]) -> pa.Array:
    """Each text scored by the trees of the other fold."""
    folds = [fold_of(t or b"", FOLDS) for t in texts]
    parts = [
        scored(trees[1 - fold], [t if own == fold else None for t, own in zip(texts, folds, strict=True)])
        for fold in range(FOLDS)
    ]
    at = np.array(folds, dtype=np.int64) * len(texts) + np.arange(len(texts))
    return pa.concat_arrays(parts).take(pa.array(at))


def scored(trees: Trees, texts: list[bytes | None]) -> pa.Array:
    names, scores, costs = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [None] * len(texts)
    filled = [i for i, t in enumerate(texts) if t and trees.languages]
    at = 0
    while at < len(filled):
        # Texts are scored together up to CHUNK bytes; a longer one alone.
        to, size = at, 0
        while to < len(filled) and (to == at or size + len(texts[filled[to]]) <= CHUNK):
            size += len(texts[filled[to]])
            to += 1
        part = filled[at:to]
        bits = _long(trees, texts[part[0]]) if size > CHUNK else trees.score([texts[i] for i in part])
        rates = bits / np.array([len(texts[i]) for i in part])[:, None]
        best = rates.argmin(axis=1)
        share = 1.0 / np.exp2(rates.min(axis=1, keepdims=True) - rates).sum(axis=1)
        for i, b, s, r in zip(part, best.tolist(), share.tolist(), rates.min(axis=1).tolist(), strict=True):
            names[i], scores[i], costs[i] = trees.languages[b], s, r
        at = to
    return pa.StructArray.from_arrays(
        [pa.array(names, pa.string()), pa.array(scores), pa.array(costs, pa.float64())],
        names=["lang_pred", "score", "bits_per_byte"],
    )


def _long(trees: Trees, text: bytes) -> np.ndarray:
    """Bits of one long text, in pieces that overlap by a context."""
    total = np.zeros((1, len(trees.languages)))
    for at in range(0, len(text), CHUNK):
        lead = min(at, trees.order)
        piece = text[at - lead : at + CHUNK]
        total += trees.score([piece])
        if lead:
            # The overlap gave its bits to the piece before; only its place as context counts here.
            total -= trees.score([piece[:lead]])
    return total

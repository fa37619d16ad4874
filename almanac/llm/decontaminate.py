"""Benchmark passages in documents, by Wu-Manber multi-pattern search over words.

A pattern is a window of ``WINDOW`` consecutive words of a benchmark item; an item
with fewer words is one pattern.  Patterns of one length are searched together, with blocks
of two words (one, where a pattern is one word): the shift table tells for a block
how far the search may jump because no pattern has the block nearer to its
end; where it may not jump, the patterns ending in that block stand in a bucket,
and each whose first word agrees is compared word by word.

Items travel to the workers as at most ``MOST_BYTES`` of text, from which each worker builds its tables once.  A
larger benchmark is searched in several passes over the documents, each with one part; between passes only row
numbers and hits are written.

Nulls and odd rows: a null text, an empty one or one without word has no words and no
hits.  Items without a word are no pattern; a null ``item_id`` is named ``null``; items with equal
ids are one item.  Repeated rows are judged alike.  Empty tables give an empty result, or one without hits.
Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.apart import own_columns_apart
from almanac.staging import stage

# Fixed value: words of a window.
WINDOW = 10

# Bytes of benchmark text whose patterns are sent to the tasks at once.
MOST_BYTES = 8 << 20

# Bits of the hash of a block, at most: a shift table of 16 MB.  Fixed value: the factor of that hash.
MOST_SHIFT_BITS = 24
MIX = 0x9E3779B1

# Bytes as a word sees them: A-Z in lower case, separators as blanks.
_IN_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)

RESULT = "struct<n_words:bigint,hits:array<int>,items:array<string>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_IN_WORDS).split()


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both are."""
    if not len(first):
        return first
    return np.unique(first * (second.max() + 1) + second, return_inverse=True)[1].astype(np.int64)


def window_numbers(words: np.ndarray, length: int) -> np.ndarray:
    """For each place where ``length`` numbered words begin, a number that is equal for equal windows.

    Windows of twice the width are pairs of windows; the last step pairs two that overlap.
    """
    number, width = words.astype(np.int64), 1
    while width < length:
        step = min(width, length - width)
        number, width = _paired(number[:-step], number[step:]), width + step
    return number


class Searcher:
    """Shift table and buckets for patterns of one length, in flat arrays of numbered words.

    The shift table has a byte for each hash of a block, the least of the blocks that share it.  Buckets are ranges of the
    patterns in the order of their last block and first word.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int):
        """Patterns begin at ``starts`` of ``words``, each in an item of ``owners``."""
        self.length = length
        self.block = min(2, length)
        # A block that stands in no pattern: the next possible place begins after its first word.
        self.furthest = min(255, length - self.block + 1)
        _, first, pattern = np.unique(window_numbers(words, length)[starts], return_index=True, return_inverse=True)
        starts = starts[first]
        last, before = words[starts + length - 1], words[starts + length - self.block]
        order = np.lexsort((words[starts], last, before))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        starts = starts[order]

        size = 1 << min(MOST_SHIFT_BITS, max(8, int(8 * len(starts)).bit_length()))
        self.mask = size - 1
        shift = np.full(size, self.furthest, dtype=np.uint8)
        for jump in range(self.furthest - 1, -1, -1):
            end = starts + length - 1 - jump
            shift[self._slot(words[end - self.block + 1].astype(np.int64), words[end].astype(np.int64))] = jump
        self.shift = shift.tobytes()

        blocks = words[starts + length - self.block].astype(np.int64) << 32 | words[starts + length - 1]
        self.blocks, at = np.unique(blocks, return_index=True)
        self.blocks, self.bucket = array("q", self.blocks.tobytes()), array("q", np.append(at, len(starts)).tobytes())
        self.firsts, self.starts = array("i", words[starts].tobytes()), array("q", starts.tobytes())
        # Items of each pattern, once each.
        names = int(owners.max()) + 1
        held = np.unique(place[pattern] * names + owners)
        self.owners = array("i", (held % names).astype(np.int32).tobytes())
        self.owned = array("i", np.searchsorted(held, np.arange(len(starts) + 1) * names).astype(np.int32).tobytes())

    def _slot(self, before, last):
        return (before * MIX + last) & self.mask

    def search(self, text: list[bytes], numbers: dict[bytes, int], words: array) -> Iterator[tuple[int, array]]:
        """(first word, items) of every occurrence in ``text``, from left to right; patterns are in ``words``.

        Only words of blocks that the search stops at are looked up, and those of places that may be occurrences.
        """
        length, shift, mask, furthest, back = self.length, self.shift, self.mask, self.furthest, self.block - 1
        last, n, number = length - 1, len(text), numbers.get
        while last < n:
            final, before = number(text[last]), number(text[last - back])
            # A word that stands in no pattern makes a block that stands in none.
            jump = furthest if final is None or before is None else shift[(before * MIX + final) & mask]
            if jump:
                last += jump
                continue
            start = last - length + 1
            first = number(text[start])
            bucket = range(0) if first is None else self._bucket(before << 32 | final, first)
            found = array("i", [number(w, -1) for w in text[start : last + 1]]) if bucket else None
            for pattern in bucket:
                at = self.starts[pattern]
                if words[at : at + length] == found:
                    yield start, self.owners[self.owned[pattern] : self.owned[pattern + 1]]
                    break
            last += 1

    def _bucket(self, block: int, first: int) -> range:
        """Patterns that end in a block and begin with a word."""
        at = bisect_left(self.blocks, block)
        if at == len(self.blocks) or self.blocks[at] != block:
            return range(0)
        start, end = self.bucket[at], self.bucket[at + 1]
        return range(bisect_left(self.firsts, first, start, end), bisect_right(self.firsts, first, start, end))


class Tables:
    """The patterns of some items: their words, numbered, and a searcher for each length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.numbers: dict[bytes, int] = {}
        self.words = array("i")
        by_length: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for name, text in items:
            start = len(self.words)
            self.words.extend([self.numbers.setdefault(w, len(self.numbers)) for w in words_of(text)])
            if n := len(self.words) - start:
                length = min(n, window)
                by_length[length].append((start, n - length + 1, number[name]))
        words = np.frombuffer(self.words, dtype=np.int32) if self.words else np.empty(0, dtype=np.int32)
        self.searchers = []
        for length, found in sorted(by_length.items()):
            places = np.array(found, dtype=np.int64)
            within = np.arange(places[:, 1].sum()) - np.repeat(np.cumsum(places[:, 1]) - places[:, 1], places[:, 1])
            starts = np.repeat(places[:, 0], places[:, 1]) + within
            self.searchers.append(Searcher(words, starts, np.repeat(places[:, 2], places[:, 1]), length))

    def occurrences(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Hit words as merged ranges [start, end, start, end, ...], and the items found."""
        ranges, items = [], set()
        for searcher in self.searchers:
            for start, owners in searcher.search(words, self.numbers, self.words):
                ranges.append((start, start + searcher.length))
                items.update(owners)
        return merged(ranges), {self.names[i] for i in items}


class _Kept:
    """The tables that a worker has built last."""

    part: tuple[str, Tables] | None = None


def tables_of(name: str, items: list[tuple[str, bytes]], window: int) -> Tables:
    """Tables of the part with a name, built once in a worker."""
    if _Kept.part is None or _Kept.part[0] != name:
        _Kept.part = None
        _Kept.part = name, Tables(items, window)
    return _Kept.part[1]


def merged(ranges: list[tuple[int, int]]) -> list[int]:
    flat: list[int] = []
    for start, end in sorted(ranges):
        if flat and start <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += (start, end)
    return flat


def _search_column(text: Column, part, window: int) -> Column:
    """One pass: searches each text for the patterns of the items in the broadcast variable ``part``."""
    name = uuid.uuid4().hex

    def of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = tables_of(name, part.value, window)
        kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
        for texts in batches:
            rows = []
            for text in texts.cast(pa.binary()).to_pylist():
                words = words_of(text)
                hits, items = tables.occurrences(words)
                rows.append({"n_words": len(words), "hits": hits, "items": sorted(items)})
            yield pa.array(rows, kind)

    of_batches.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(of_batches, RESULT)(text)


def _joined(ranges: Column) -> Column:
    """Total length of ranges [start, end, ...], which may overlap between passes."""
    pairs = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.floor(F.size(ranges) / 2).cast("int") - 1),
            lambda i: F.struct(F.get(ranges, 2 * i).alias("start"), F.get(ranges, 2 * i + 1).alias("end")),
        )
    )
    total = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(acc["to"], r["start"]))).alias("n"),
            F.greatest(acc["to"], r["end"]).alias("to"),
        ),
    )["n"]
    return F.when(F.size(ranges) > 0, total).otherwise(0).cast("bigint")


def parts_of(benchmark: DataFrame, most_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items of one part of the benchmark after the other, each of about ``most_bytes`` of text at most."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text").where(
        "text IS NOT NULL"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(1, -(-total // most_bytes))
    for part in range(n_parts):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_parts)) == part).collect()
        yield [(r["item"], r["text"].encode()) for r in rows]


def _in_parts(docs: DataFrame, searches: Iterator[Column]) -> DataFrame:
    """``docs`` with __found of all searches.  Texts are written once, with row numbers; a search writes numbers and hits only."""
    marked = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "leak-documents")
    passes = []
    for number, search in enumerate(searches):
        found = marked.select("__row", search.alias("found")).select("__row", "found.*")
        passes.append(stage(found.where(F.size("items") > 0) if number else found, "leak-hits"))
    together = (
        reduce(DataFrame.unionByName, passes)
        .groupBy("__row")
        .agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        .select("__row", F.struct("n_words", "hits", "items").alias("__found"))
    )
    return marked.join(together, "__row").drop("__row")


@own_columns_apart
def find_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (ids of occurring items, sorted) and contaminated."""
    spark = docs.sparkSession
    kept = docs.drop("n_words", "n_hit", "n_items", "items", "contaminated")
    searches = (
        _search_column(F.col("text"), spark.sparkContext.broadcast(items), window) for items in parts_of(benchmark, most_bytes)
    )
    first, second = next(searches), next(searches, None)
    if second is None:
        found = kept.withColumn("__found", first)
    else:
        found = _in_parts(kept, chain([first, second], searches))
    return (
        found.withColumn("n_words", F.col("__found.n_words"))
        .withColumn("n_hit", _joined(F.col("__found.hits")))
        .withColumn("items", F.array_sort("__found.items"))
        .withColumn("n_items", F.size("items").cast("bigint"))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop("__found")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` as given, without those that hold a benchmark passage."""
    whole = docs.select("text", F.struct(*docs.columns).alias("__doc"))
    return find_leaks(whole, benchmark, **how).where(~F.col("contaminated")).select("__doc.*")


def items_digest(items: Column) -> Column:
    """SHA-256 of the ids, comma-joined, in lower-case hex."""
    return F.sha2(F.array_join(items, ","), 256)


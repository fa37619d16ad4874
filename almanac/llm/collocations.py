"""Collocations from a weighted de Bruijn graph of word sequences.

Texts are cut into pieces and those into words.  A phrase that occurs ``least`` times has only words and pairs of
neighbours that do, so words and pairs are counted first, and a piece is cut again where one of them is rarer.  Which ones
are not is told to the tasks by bits at two hashes (``WORD_BITS``, ``PAIR_BITS``: a fixed size, whatever the data); words that share
both with frequent ones only leave more to count.

The nodes of the graph are sequences of ``LONGEST - 1`` words; an edge is a sequence of ``LONGEST`` words, leads from its
first words to its last ones, and weighs as often as it occurs.  A piece's last words, of which no edge starts, are kept beside the edges.  So

    f(sequence) = weight of all edges that start with it + piece ends that start with it

where a node's count is the flow out of it plus the pieces that end in it, and shorter counts follow from longer ones in
the same way, down to three words; words and pairs have been counted before.  :func:`window_counts` combines edges and piece ends in the map tasks, sorts them by sequence, and
reads all counts off one pass over the sorted rows: rows that start alike are neighbours.  Only sequences that occur
``least`` times leave that pass.

The edges that remain are a graph of their own.  Where a node has one edge in and one out and both weigh the same,
they belong to one path, and :func:`compact` stores such an unary path as one row (cut every
``PATH_EDGES`` edges).  Candidates of ``LONGEST`` words are the windows of paths, shorter ones the sequences counted.

Tasks look at words as numbers of their own and hand on windows that start with the same two words in one row, which is sorted where
it arrives.  Skew: these rows spread by a hash of the two words.  Pairs that hold more than 1 / ``HOT_SHARE`` of all frequent
pairs' occurrences (at most ``HOT_SHARE`` of them) have a row for each window, spread by the whole of it, and their counts are added up once more.

Score: cutting a phrase after its first k words into parts that occur l and r times scores
floor(1000 * f * n / (l * r)), in decimals of 38 digits; the cut with the lowest score counts, ties to the smallest k.

Nulls and odd rows: a null text counts as empty, a null language as ``und``.  Any bytes may stand in words.  Repeated
rows count as often as they occur.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.staging import stage

# Words of the longest phrase, least count of a candidate, ranks returned for each language.
LONGEST, LEAST, MOST_RANKS = 5, 100, 2000
NO_LANGUAGE = "und"
PIECE_ENDS = b".,;:!?\x0A\x0B\x0C\x0D"
PIECE_END = re.compile(b"[" + PIECE_ENDS + b"]+")

# Stands between pieces in a list of words; no word holds it.
MARK = b"."

# Keys are language and words, joined by the lowest byte that occurs in them, so that whatever starts alike sorts
# together.  Lower bytes, and the escape itself, become the escape and a character from "0" on.
SEPARATOR, ESCAPE = b"\t", b"\n"
LOW = re.compile(rb"[\x00-\x0A]")
# Those of them that can stand in a word.
LOW_IN_WORDS = re.compile(rb"[\x00-\x08]")

# Words of the shortest sequence whose count follows from windows.
SHORTEST_WINDOW = 3

# Sequences that a task holds before it hands them on; answers that it keeps for each language and kind.
MOST_HELD, MOST_ANSWERS = 600_000, 200_000

# Bits that tell frequent words and pairs: 1 and 4 MB.  Fixed value: the seed of Spark's own hash.
WORD_BITS, PAIR_BITS = 1 << 23, 1 << 25
HASH_SEED = 42

# Share of all pairs from which on a pair is hot.
HOT_SHARE = 1000

# Edges of a path in one row.
PATH_EDGES = 256

# Words that a task looks at together, pairs of them that it holds before it counts them, and rows that it hands on at once.
CHUNK, MOST_PAIRS, MOST_ROWS = 500_000, 6_000_000, 50_000

# Odd number that tells the first word of a pair from the second.
PLACE_OF_FIRST = 1_000_003

WINDOWS_SCHEMA = "route int, salted boolean, key binary, rest array<binary>, n array<bigint>"
COUNTS_SCHEMA = "key binary, words int, n bigint"


def escaped(raw: bytes) -> bytes:
    return LOW.sub(lambda m: ESCAPE + bytes([0x30 + m[0][0]]), raw)


def unescaped(text: Column) -> Column:
    for byte in range(0x0B):
        text = F.replace(text, F.lit(ESCAPE.decode() + chr(0x30 + byte)), F.lit(chr(byte)))
    return text


def marked_words(text: bytes) -> list[bytes]:
    """The words of a text, coded so that they may stand in a key, with marks where pieces end."""
    words = PIECE_END.sub(b" " + MARK + b" ", text.lower()).split()
    return [escaped(w) for w in words] if LOW_IN_WORDS.search(text) else words


def all_words(text: bytes) -> list[bytes]:
    return [w for w in marked_words(text) if w != MARK]


class Frequent(dict):
    """Whether both bits of a language's word or pair are set; answers are kept while there is room."""

    def __init__(self, bits: bytes, start: bytes):
        super().__init__()
        self.bits, self.start = bits, start
        self[MARK] = False

    def __missing__(self, words: bytes) -> bool:
        key = self.start + words
        found = self._set(zlib.crc32(key)) and self._set(xxhash.xxh64_intdigest(key, seed=HASH_SEED))
        if len(self) >= MOST_ANSWERS:
            self.clear()
            self[MARK] = False
        self[words] = found
        return found

    def _set(self, number: int) -> bool:
        at = number % (8 * len(self.bits))
        return bool(self.bits[at >> 3] >> (at & 7) & 1)


class Numbers(Frequent):
    """Numbers of a language's words whose bits are set, from 1 on as they are met; all others, and marks, are 0."""

    def __init__(self, bits: bytes, start: bytes):
        super().__init__(bits, start)
        self.words, self.hashes, self.rare = [b""], [(0, 0)], []

    def __missing__(self, word: bytes) -> int:
        key = self.start + word
        hashes = zlib.crc32(key), xxhash.xxh64_intdigest(key, seed=HASH_SEED)
        number = 0
        if all(map(self._set, hashes)):
            number = len(self.words)
            self.words.append(word)
            self.hashes.append(tuple(h & 0xFFFFFFFF for h in hashes))
        else:
            if len(self.rare) >= MOST_ANSWERS:
                for rare in self.rare:
                    del self[rare]
                self.rare.clear()
            self.rare.append(word)
        self[word] = number
        return number

    def phrases(self, columns: np.ndarray) -> pa.Array:
        """The words of rows of numbers, joined; 0 stands for no word."""
        words = pa.array([None, *self.words[1:]], pa.binary())
        return pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in columns.T), SEPARATOR, null_handling="skip")


def frequent_pairs(numbers: Numbers, ids: np.ndarray, pair_bits: np.ndarray) -> np.ndarray:
    """Whether each word and the next are both numbered and both bits of the pair are set."""
    both = (ids[:-1] > 0) & (ids[1:] > 0)
    at = np.flatnonzero(both)
    for hashes in np.array(numbers.hashes, dtype=np.int64).T:
        places = (hashes[ids[at]] * PLACE_OF_FIRST + hashes[ids[at + 1]]) % (8 * len(pair_bits))
        at = at[(pair_bits[places >> 3] >> (places & 7)) & 1 > 0]
    found = np.zeros(len(ids), dtype=bool)
    found[at] = True
    return found


def numbered_windows(ids: np.ndarray, joined: np.ndarray, longest: int) -> np.ndarray:
    """The windows that :func:`cut_windows` finds, as rows of numbers, filled up with 0."""
    joined = np.append(joined, np.zeros(longest, dtype=bool))
    starts = np.flatnonzero(joined[:-1] & joined[1:]) if longest >= SHORTEST_WINDOW else np.zeros(0, dtype=np.int64)
    found = np.zeros((len(starts), longest), dtype=np.int32)
    goes_on = np.ones(len(starts), dtype=bool)
    for word in range(longest):
        goes_on &= joined[starts + word - 1] if word else True
        found[goes_on, word] = ids[starts[goes_on] + word]
    return found


def cut_windows(words: list[bytes], word: Frequent, pair: Frequent, longest: int) -> list[bytes]:
    """The windows of three to ``longest`` words whose pairs are all frequent, one for each word that starts one."""
    known = list(map(word.__getitem__, words))
    joined = [
        a and b and pair[first + SEPARATOR + second]
        for a, b, first, second in zip(known, known[1:], words, words[1:], strict=False)
    ]
    joined.append(False)
    found = []
    for i, starts in enumerate(known):
        if starts and joined[i]:
            end, most = i + 1, i + longest - 1
            while end < most and joined[end]:
                end += 1
            if end > i + 1:
                found.append(SEPARATOR.join(words[i : end + 1]))
    return found


def _counted(
    batches: Iterator[pa.RecordBatch], sequences: Callable[[bytes], Callable[[bytes], Iterable[bytes]]]
) -> Iterator[tuple[bytes, Counter]]:
    """The start of a language's keys and what follows it, with counts; some hundred thousand are held at once.

    ``sequences`` gets the start of a language's keys and returns what makes the sequences of a text.
    """
    held: dict[bytes, Counter] = {}
    of_text = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            start = escaped(lang.as_py().encode()) + SEPARATOR
            if start not in of_text:
                of_text[start] = sequences(start)
            held.setdefault(start, Counter()).update(of_text[start](text.as_py()))
            if sum(map(len, held.values())) >= MOST_HELD:
                yield from held.items()
                held.clear()
    yield from held.items()


def _count_rows(start: bytes, found: Counter, words: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array((start + key for key in found), pa.binary()), "words": pa.array(np.full(len(found), words), pa.int32()),
            "n": pa.array(found.values(), pa.int64()),
        }
    )


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, and with 0 words how many a language has."""
    for start, found in _counted(batches, lambda start: all_words):
        yield _count_rows(start, found, 1)
        yield _count_rows(start.removesuffix(SEPARATOR), Counter({b"": found.total()}), 0)


def _numbered(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[tuple[Numbers, np.ndarray]]:
    """Texts of one language after the other, as numbers of their words, each with a 0 at its end."""
    numbers: dict[bytes, Numbers] = {}
    held: dict[bytes, list[np.ndarray]] = {}
    sizes: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            start = escaped(lang.as_py().encode()) + SEPARATOR
            if start not in numbers:
                numbers[start] = Numbers(bits, start)
            words = marked_words(text.as_py())
            words.append(MARK)
            held.setdefault(start, []).append(np.fromiter(map(numbers[start].__getitem__, words), np.int32, len(words)))
            sizes[start] += len(words)
            if sizes[start] >= CHUNK:
                yield numbers[start], np.concatenate(held.pop(start))
                del sizes[start]
    for start, texts in held.items():
        yield numbers[start], np.concatenate(texts)


def _parts(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_pydict(columns)
    for at in range(0, batch.num_rows, MOST_ROWS):
        yield batch.slice(at, MOST_ROWS)


def _pair_rows(word_bits: bytes):
    def counted(numbers: Numbers, codes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.unique(np.concatenate(codes), return_counts=True)
        for at in range(0, len(pairs), MOST_ROWS):
            part = pairs[at : at + MOST_ROWS]
            phrases = numbers.phrases(np.stack([part >> 32, part & 0xFFFFFFFF], axis=1))
            keys = pc.binary_join_element_wise(numbers.start.removesuffix(SEPARATOR), phrases, SEPARATOR)
            yield pa.RecordBatch.from_pydict(
                {"key": keys, "words": pa.array(np.full(len(part), 2), pa.int32()), "n": pa.array(n[at : at + MOST_ROWS], pa.int64())}
            )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[Numbers, list[np.ndarray]]] = {}
        size = 0
        for numbers, ids in _numbered(batches, word_bits):
            both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            held.setdefault(numbers.start, (numbers, []))[1].append(ids[both].astype(np.int64) << 32 | ids[both + 1])
            size += len(both)
            if size >= MOST_PAIRS:
                for of_language in held.values():
                    yield from counted(*of_language)
                held.clear()
                size = 0
        for of_language in held.values():
            yield from counted(*of_language)

    return of_batches


def _window_rows(longest: int, word_bits: bytes, pair_bits: bytes, hot: frozenset[bytes]):
    """One row for each first two words; a row for each window where these are hot."""

    def counted(numbers: Numbers, found: Counter) -> Iterator[pa.RecordBatch]:
        windows = np.frombuffer(b"".join(found), dtype=np.int32).reshape(-1, longest)
        order = np.lexsort((windows[:, 1], windows[:, 0]))
        windows, n = windows[order], np.fromiter(found.values(), np.int64, len(found))[order]
        new = np.append(True, (windows[1:, :2] != windows[:-1, :2]).any(axis=1))
        begin = np.flatnonzero(new)
        firsts = [numbers.start + first for first in numbers.phrases(windows[begin, :2]).to_pylist()]
        salted = np.fromiter((first in hot for first in firsts), bool, len(firsts))
        rest = numbers.phrases(windows[:, 2:])
        group = np.cumsum(new) - 1
        rows = np.flatnonzero(new | salted[group])
        keys = [firsts[g] for g in group[rows]]
        routes = [
            zlib.crc32(key + SEPARATOR + rest[at].as_py() if salt else key) >> 1
            for key, at, salt in zip(keys, rows.tolist(), salted[group[rows]].tolist(), strict=True)
        ]
        offsets = pa.array(np.append(rows, len(windows)), pa.int32())
        yield from _parts(
            {
                "route": pa.array(routes, pa.int32()), "salted": pa.array(salted[group[rows]]), "key": pa.array(keys, pa.binary()),
                "rest": pa.ListArray.from_arrays(offsets, rest), "n": pa.ListArray.from_arrays(offsets, pa.array(n)),
            }
        )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(pair_bits, dtype=np.uint8)
        held: dict[bytes, tuple[Numbers, Counter]] = {}
        for numbers, ids in _numbered(batches, word_bits):
            found = numbered_windows(ids, frequent_pairs(numbers, ids, bits), longest)
            if len(found):
                held.setdefault(numbers.start, (numbers, Counter()))[1].update(found.view(f"V{found.itemsize * longest}").ravel().tolist())
            if sum(len(counts) for _, counts in held.values()) >= MOST_HELD:
                for of_language in held.values():
                    yield from counted(*of_language)
                held.clear()
        for of_language in held.values():
            yield from counted(*of_language)

    return of_batches


def set_bits(keys: DataFrame, bits: int) -> bytes:
    """Two bits for each key, by two hashes.  The driver receives rows of 4 KB, ``bits`` / 32768 at most."""
    return _set_places(keys, F.array(F.crc32("key") % bits + 1, F.pmod(F.xxhash64("key"), F.lit(bits)) + 1), bits)


def set_pair_bits(keys: DataFrame, bits: int) -> bytes:
    """The same for pairs, by the hashes of their words, each after the language."""
    parts = F.split(F.col("key").cast("string"), SEPARATOR.decode())
    first, second = (F.concat(parts[0], F.lit(SEPARATOR.decode()), parts[word]).cast("binary") for word in (1, 2))

    def place(hashed: Callable[[Column], Column]) -> Column:
        return (hashed(first) * PLACE_OF_FIRST + hashed(second)) % bits + 1

    return _set_places(keys, F.array(place(F.crc32), place(lambda word: F.xxhash64(word).bitwiseAND(0xFFFFFFFF))), bits)


def _set_places(keys: DataFrame, places: Column, bits: int) -> bytes:
    at = F.col("at")
    rows = (
        keys.select(F.explode(places).alias("at")).select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    out = bytearray(bits // 8)
    for row in rows:
        start = (row["bucket"] - 1) * len(row["bits"])
        out[start : start + len(row["bits"])] = row["bits"][: len(out) - start]
    return bytes(out)


class Runs:
    """Counts of all prefixes of sorted keys, batch by batch."""

    def __init__(self, longest: int, least: int):
        self.longest, self.least = longest, least
        # The last run of each length, which the next batch may go on with: prefix, count, whether all of it is to be told.
        self.last: list[tuple[bytes, int, bool] | None] = [None] * (longest + 1)

    def add(self, keys: pa.Array, counts: np.ndarray, salted: np.ndarray) -> Iterable[tuple[bytes, int, int]]:
        """(prefix, words, count) of the runs that end before the last row."""
        data = np.frombuffer(keys.buffers()[2], dtype=np.uint8)
        ends = np.frombuffer(keys.buffers()[1], dtype=np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
        begin, end = ends[:-1], ends[1:]
        gaps = begin[0] + np.flatnonzero(data[begin[0] : end[-1]] == SEPARATOR[0])
        # Gaps of a row: after the language and between words.
        first_gap, next_gap = np.searchsorted(gaps, begin), np.searchsorted(gaps, end)
        alike = self._common(data, begin, end)
        told = []
        for words in range(SHORTEST_WINDOW, self.longest + 1):
            n_words = next_gap - first_gap
            rows = np.flatnonzero(n_words >= words)
            if not len(rows):
                continue
            cut = end[rows].copy()
            inner = n_words[rows] > words
            cut[inner] = gaps[first_gap[rows][inner] + words]
            length = cut - begin[rows]
            # The rows between two rows of this length start with neither, so neighbours of this list may be compared by
            # what all rows in between have in common.
            shared = np.minimum.reduceat(alike[: rows[-1] + 1], np.concatenate([[0], rows[:-1] + 1]))
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (length[1:] != length[:-1]) | (shared[1:] < length[1:])
            starts = np.flatnonzero(new)
            totals = np.add.reduceat(counts[rows], starts)
            all_told = np.maximum.reduceat(salted[rows], starts)
            told += self._ended(words, data, begin[rows[starts]], cut[starts], totals, all_told)
        return told

    @staticmethod
    def _common(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bytes that each row has in common with the row before."""
        out = np.zeros(len(begin), dtype=np.int64)
        rows = np.arange(1, len(begin))
        at = 0
        while len(rows):
            rows = rows[(begin[rows] + at < end[rows]) & (begin[rows - 1] + at < end[rows - 1])]
            rows = rows[data[begin[rows] + at] == data[begin[rows - 1] + at]]
            at += 1
            out[rows] = at
        return out

    def _ended(self, words, data, begin, end, totals, all_told) -> Iterator[tuple[bytes, int, int]]:
        last = len(totals) - 1
        wanted = np.flatnonzero(all_told | (totals >= self.least))
        for run in sorted({0, last, *wanted.tolist()}):
            prefix = data[begin[run] : end[run]].tobytes()
            total, every = int(totals[run]), bool(all_told[run])
            if run == 0 and (held := self.last[words]):
                if held[0] == prefix:
                    total, every = total + held[1], every or held[2]
                else:
                    yield from self._told(words, held)
            if run == last:
                self.last[words] = prefix, total, every
            else:
                yield from self._told(words, (prefix, total, every))

    def _told(self, words: int, run: tuple[bytes, int, bool]) -> Iterator[tuple[bytes, int, int]]:
        if run[2] or run[1] >= self.least:
            yield run[0], words, run[1]

    def rest(self) -> Iterator[tuple[bytes, int, int]]:
        for words, held in enumerate(self.last):
            if held:
                yield from self._told(words, held)


def sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(windows, counts, salted) in the order of the windows, from rows in the order of their first two words."""

    def told(held: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        rows = pa.Table.from_batches(held).combine_chunks()
        rest, n, key = (rows.column(c).combine_chunks() for c in ("rest", "n", "key"))
        row = np.repeat(np.arange(len(key)), pc.list_value_length(rest).to_numpy())
        windows = pc.binary_join_element_wise(key.take(pa.array(row)), rest.flatten(), SEPARATOR)
        order = pc.sort_indices(windows)
        salted = rows.column("salted").to_numpy()[row]
        return windows.take(order), n.flatten().to_numpy()[order], salted[order]

    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column("key")
        if not len(keys):
            continue
        # The last key may go on in the next batch.
        cut = len(keys) - 1
        while cut and keys[cut - 1] == keys[cut]:
            cut -= 1
        if cut or held and keys[0] != held[-1].column("key")[-1]:
            yield told([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield told(held)


def _prefix_counts(longest: int, least: int):
    def rows(found: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
        keys, words, n = zip(*found, strict=True)
        return pa.RecordBatch.from_pydict(
            {"key": pa.array(keys, pa.binary()), "words": pa.array(words, pa.int32()), "n": pa.array(n, pa.int64())}
        )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(longest, least)
        for windows, counts, salted in sorted_windows(batches):
            if len(windows) and (found := list(runs.add(windows, counts, salted))):
                yield rows(found)
        if found := list(runs.rest()):
            yield rows(found)

    return of_batches


def window_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, n) of sequences that occur ``least`` times; with 0 words: all words of a language."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), text.alias("text"))

    def added(counted: DataFrame) -> DataFrame:
        return counted.groupBy("key", "words").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("words") == 0))

    words = stage(added(rows.mapInArrow(_word_rows, COUNTS_SCHEMA)), "word-counts")
    word_bits = set_bits(words.where("words = 1"), WORD_BITS)
    pairs = stage(added(rows.mapInArrow(_pair_rows(word_bits), COUNTS_SCHEMA)), "pair-counts")
    pair_bits = set_pair_bits(pairs, PAIR_BITS)
    all_pairs = pairs.agg(F.sum("n")).first()[0] or 0
    hot = frozenset(bytes(r["key"]) for r in pairs.where(F.col("n") * HOT_SHARE > all_pairs).select("key").collect())
    spread = rows.mapInArrow(_window_rows(longest, word_bits, pair_bits, hot), WINDOWS_SCHEMA).repartition("route")
    counted = added(
        spread.sortWithinPartitions("key").select("key", "salted", "rest", "n").mapInArrow(_prefix_counts(longest, least), COUNTS_SCHEMA)
    )
    parts = F.split(F.col("key").cast("string"), SEPARATOR.decode())
    return counted.unionByName(words).unionByName(pairs).select(
        unescaped(parts[0]).alias("lang"),
        unescaped(F.array_join(F.slice(parts, 2, F.size(parts)), " ")).alias("phrase"), "words", "n",
    )


def _head(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _tail(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", -words)


def links(edges: DataFrame, longest: int) -> DataFrame:
    """(lang, edge, previous): an edge and the one before it, where their node has no other edge and both weigh the same."""
    ends = edges.select("lang", F.col("phrase").alias("edge"), F.col("n").alias("weight"))

    def only(node: Column, name: str) -> DataFrame:
        return (
            ends.groupBy("lang", node.alias("node"))
            .agg(F.count("*").alias("times"), F.min("edge").alias(name), F.min("weight").alias("weight"))
            .where("times = 1").drop("times")
        )

    leaving = only(_head(F.col("edge"), longest - 1), "edge")
    entering = only(_tail(F.col("edge"), longest - 1), "previous")
    return leaving.join(entering, ["lang", "node", "weight"]).where("edge <> previous").select("lang", "edge", "previous")


def compact(edges: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, words, n): the unary paths of (lang, phrase, n); every edge lies in one path.

    Edges find the head of their path by doubling: each round looks twice as far back.  The edges of a cycle have no
    head; once a round has found no further head only they are left, and each is a path of its own.
    """
    before = links(edges, longest)
    behind = stage(
        edges.select("lang", F.col("phrase").alias("edge"), "n").join(before, ["lang", "edge"], "left").select(
            "lang", "edge", "n", F.coalesce("previous", "edge").alias("head"),
            F.when(F.col("previous").isNull(), 0).otherwise(1).cast("bigint").alias("place"),
            F.col("previous").isNull().alias("found"),
        ),
        "path-heads",
    )
    open_edges = behind.where("NOT found").count()
    while open_edges:
        further = behind.select(
            "lang", F.col("edge").alias("head"), F.col("head").alias("next_head"), F.col("place").alias("more"), F.col("found").alias("ends")
        )
        behind = stage(
            behind.join(further, ["lang", "head"]).select(
                "lang", "edge", "n", F.col("next_head").alias("head"), (F.col("place") + F.col("more")).alias("place"),
                F.col("ends").alias("found"),
            ),
            "path-heads",
        )
        open_edges, earlier = behind.where("NOT found").count(), open_edges
        if open_edges == earlier:
            break
    part = F.floor(F.col("place") / PATH_EDGES)
    return (
        behind.withColumn("head", F.when(F.col("found"), F.col("head")).otherwise(F.col("edge")))
        .withColumn("place", F.when(F.col("found"), F.col("place")).otherwise(0))
        .groupBy("lang", "head", part.alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "edge"))).alias("edges"), F.max("n").alias("n"))
        .select(
            "lang",
            F.concat(
                F.split(F.get("edges", F.lit(0))["edge"], " "),
                F.transform(F.slice("edges", 2, F.size("edges")), lambda e: F.substring_index(e["edge"], " ", -1)),
            ).alias("words"),
            "n",
        )
    )


def path_windows(paths: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, words, n): the edges of paths."""
    starts = F.sequence(F.lit(1), F.size("words") - (longest - 1))
    phrases = F.transform(starts, lambda i: F.array_join(F.slice("words", i, F.lit(longest)), " "))
    return paths.select("lang", F.explode(phrases).alias("phrase"), F.lit(longest).alias("words"), "n")


def scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score): each candidate at its cut of the lowest score."""

    def part_counts(part: str, count: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(count))

    word = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "*", F.array_join(F.slice(word, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(word, F.col("k") + 1, F.lit(longest)), " ").alias("rest"),
    )
    score = F.expr(
        "CAST(CAST(1000 AS decimal(4, 0)) * CAST(a AS decimal(17, 0)) * CAST(n AS decimal(17, 0)) AS decimal(38, 0))"
        " DIV (CAST(l AS decimal(19, 0)) * CAST(r AS decimal(19, 0)))"
    )
    return (
        cuts.join(part_counts("first", "l"), ["lang", "first"])
        .join(part_counts("rest", "r"), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", score)
        .groupBy("lang", "phrase", "words", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def contained(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, a): what lies in a candidate of one more word that occurs as often.

    Longer candidates need no look: what lies in one of them and occurs as often also lies in one of one more word.
    """
    longer = candidates.where("words > 2")
    parts = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    return longer.select("lang", F.explode(parts).alias("phrase"), "a")


def mine(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, most_ranks: int = MOST_RANKS
) -> tuple[DataFrame, DataFrame]:
    """(lang, rank, phrase, a, l, r, n, score), the first ``most_ranks`` of each language, and the paths of the graph."""
    counts = stage(window_counts(docs, longest, least), "window-counts")
    totals = counts.where("words = 0").select("lang", "n")
    paths = stage(compact(counts.where(F.col("words") == longest), longest), "paths")
    shorter = counts.where(F.col("words").between(2, longest - 1))
    candidates = stage(
        shorter.unionByName(path_windows(paths, longest)).withColumnRenamed("n", "a"), "candidates"
    )
    kept = candidates.join(contained(candidates), ["lang", "phrase", "a"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = (
        scored(kept, counts.where("words > 0"), totals, longest)
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .where(F.col("rank") <= most_ranks)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
    return ranked, paths

"""Whitening, byte pairs and collocations: brute force, odd rows, and the queries over whole tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from almanac.llm import byte_pairs, collocations, queries, whitening

SF = "/root/testdata/sf0.001"
RANKS = byte_pairs.read_ranks(queries.RANKS)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
VECTORS = "vec_id bigint, embedding array<double>, label int"


def exact_sums(y):
    y = y.astype(object)
    return y.sum(axis=0), np.triu(y.T @ y)


@pytest.mark.parametrize("scale", [1, 1000, 1 << 20, 1 << 45, 1 << 60])
def test_sums_over_bit_planes_are_exact(scale):
    y = np.random.default_rng(scale % 97).integers(-scale, scale + 1, (131, 5))
    sums, products = whitening.block_sums(y)
    expected = exact_sums(y)
    assert (sums == expected[0]).all() and (products == expected[1]).all()


def brute_whitened(rows):
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([np.floor(1024 * np.array(v, dtype=np.float64)) + 100000 for _, v in kept])
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return [i for i, _ in kept], deviation, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_op11_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    ids, deviation, whitened, explained = brute_whitened(rows)
    found = queries.QUERIES["op11_whitened_embeddings"](spark, SF).collect()
    assert len(found) == 8 * len(ids) and {r.n for r in found} == {len(ids)}
    place = {i: k for k, i in enumerate(ids)}
    got = np.empty_like(whitened)
    for r in found:
        assert r.deviation == deviation[place[r.vec_id]]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
        got[place[r.vec_id], r.component - 1] = r.whitened
    assert abs(got * np.sign((got * whitened).sum(axis=0)) - whitened).max() < 1e-7


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    usable = [(i % 7, rng.normal(size=3).tolist()) for i in range(30)]
    odd = [(1, None), (2, [1.0, None, 2.0]), (3, [float("nan"), 0.0, 0.0]), (4, [0.0, float("inf"), 0.0]), (None, [1.0, 2.0, 3.0]), (5, [0.5])]
    table = spark.createDataFrame([(i, v, 0) for i, v in usable + odd], VECTORS).repartition(5)
    found = whitening.whiten(table).collect()
    ids, deviation, _, _ = brute_whitened([*usable, (None, [1.0, 2.0, 3.0]), (5, [0.5, 0.0, 0.0])])
    assert Counter((r.vec_id, int(r.deviation)) for r in found if r.component == 1) == Counter(zip(ids, deviation, strict=True))
    assert {r.component for r in found} == {1, 2, 3} and all(r.identity_error < 1e-9 for r in found)
    clashing = table.withColumns({c: F.lit("given") for c in ("component", "n", "deviation", "whitened", "explained", "i", "value")})
    again = whitening.whiten(clashing).collect()
    key = lambda r: (str(r.vec_id), r.component, r.deviation)
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 1)], VECTORS)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(3)], VECTORS)).collect()
    assert {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in same} == {(None, 0.0, None, 0)}
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e300], 1)], VECTORS)).collect()


def test_wide_vectors_and_entries(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=300) * 1e9).tolist(), 1) for i in range(40)]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    _, deviation, _, explained = brute_whitened([(i, v) for i, v, _ in rows])
    assert [int(r.deviation) for r in sorted(found, key=lambda r: r.vec_id) if r.component == 1] == deviation
    assert max(abs(r.explained / explained[r.component - 1] - 1) for r in found) < 1e-6


def odd_texts():
    rng = random.Random(5)
    letters = "abcdefgh ETAOIN'.,0129 \t\néß中́  \U0001f600\x00\x1c​"
    return ["", " ", "a" * 3000, "\n" * 50, "it's we'll  I'd", "x" * 63 + " " + "y" * 65] + [
        "".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(300)
    ] + ["".join(rng.choice("abcd") for _ in range(40_000))]


def test_encoder_equals_the_reference_library(monkeypatch):
    monkeypatch.setattr(byte_pairs, "MOST_PIECES", 50)
    encoder = byte_pairs.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in odd_texts():
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == REFERENCE.encode_ordinary(text)
    assert len(encoder) <= 50 and len(encoder.old) <= 50


def test_ties_go_to_the_leftmost_pair():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"ab": 301}
    assert byte_pairs.merged(b"aaaab", ranks) == [b"aa", b"aa", b"b"]
    assert byte_pairs.merged(b"aaab", ranks) == [b"aa", b"ab"]


def test_op12_equals_the_reference_library(spark):
    texts = {i: t or "" for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()}
    rows = queries.QUERIES["op12_byte_pairs"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = REFERENCE.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_byte_pairs_of_odd_rows(spark):
    ranks = byte_pairs.share_ranks(spark, queries.RANKS)
    rows = [(1, None, "x"), (1, None, "x"), (None, "", None), (2, "café " * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumns(
        {c: F.lit("given") for c in ("ids", "n_tokens", "decoded", "key")}
    )
    found = byte_pairs.decode(byte_pairs.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
    assert sorted((r.doc_id or 0, r.decoded.decode(), r.key) for r in found) == sorted((i or 0, t or "", "given") for i, t, _ in rows)
    assert all(r.n_tokens == len(REFERENCE.encode_ordinary(r.text or "")) for r in found)
    both = byte_pairs.round_trip(docs, ranks, public_tokenizers.PATTERN).select(*docs.columns).collect()
    columns = ("doc_id", "text", "key", "ids", "n_tokens", "decoded")
    assert sorted(repr([r[c] for c in columns]) for r in both) == sorted(repr([r[c] for c in columns]) for r in found)
    assert byte_pairs.encode(docs.limit(0), ranks, public_tokenizers.PATTERN).collect() == []


def brute_phrases(docs, least, most):
    times, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").encode().lower().decode()):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for size in range(1, 6):
                times.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: f for k, f in times.items() if len(k[1]) > 1 and f >= least}
    dropped = set()
    for (lang, words), f in candidates.items():
        for size in range(2, len(words)):
            dropped |= {(lang, p) for i in range(len(words) - size + 1) if f >= times[lang, p := words[i : i + size]]}
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            n = total[lang]
            score, k = min((1000 * a * n // (times[lang, words[:k]] * times[lang, words[k:]]), k) for k in range(1, len(words)))
            found[lang].append((-score, -a, " ".join(words).encode(), times[lang, words[:k]], times[lang, words[k:]]))
    return {
        (lang, rank, phrase.decode(), -a, first, rest, total[lang], -score)
        for lang, all_found in found.items() for rank, (score, a, phrase, first, rest) in enumerate(sorted(all_found)[:most], 1)
    }


@pytest.fixture(scope="module")
def odd_documents():
    rng = random.Random(3)
    words = ["the", "of", "a", "x\x01", "x", "\x00", "b\x08c", "é", "The", "x\x1fy", "\x0b"]
    seams = [" ", " ", " ", "\t", "  ", ".", "\n", "", " "]
    docs = [
        (rng.choice(["en", None, "und", "a\tb", "\n"]), "".join(rng.choice(words) + rng.choice(seams) for _ in range(rng.randrange(60))))
        for _ in range(200)
    ]
    return [*docs, *[("en", "p q r s t u v w x y z " * 3)] * 4, ("en", None), (None, "")]


@pytest.mark.parametrize(("hot_share", "least", "most"), [(1000, 3, 2000), (10, 3, 2000), (10, 10, 5)])
def test_phrases_equal_brute_force(spark, monkeypatch, odd_documents, hot_share, least, most):
    monkeypatch.setattr(collocations, "PATH_EDGES", 4)
    monkeypatch.setattr(collocations, "HOT_SHARE", hot_share)
    docs = spark.createDataFrame(odd_documents, "lang string, text string").repartition(6).withColumn("n", F.lit("given"))
    phrases, paths = collocations.mine(docs, least=least, most_ranks=most)
    assert {tuple(r) for r in phrases.collect()} == brute_phrases(odd_documents, least, most)
    edges = Counter((r.lang, tuple(r.words[i : i + 5])) for r in paths.collect() for i in range(len(r.words) - 4))
    assert not edges or max(edges.values()) == 1


def test_pieces_are_cut_at_rare_words_and_pairs():
    def bits(*frequent):
        out = bytearray(1 << 10)
        for words in frequent:
            for number in (zlib.crc32(b"en\t" + words), xxhash.xxh64_intdigest(b"en\t" + words, seed=42)):
                at = number % (8 << 10)
                out[at >> 3] |= 1 << (at & 7)
        return bytes(out)

    word = collocations.Frequent(bits(b"a", b"b", b"c"), b"en\t")
    pair = collocations.Frequent(bits(b"a\tb", b"b\tc"), b"en\t")
    words = collocations.marked_words(b"z A b c a b z c b a, b z z. a b")
    assert words == b"z a b c a b z c b a . b z z . a b".split()
    assert collocations.cut_windows(words, word, pair, 5) == [b"a\tb\tc"]
    assert collocations.cut_windows(words, word, pair, 2) == []
    more = b"a b c a b c a b c . a b c".split()
    pair[b"c\ta"] = True
    found = collocations.cut_windows(more, word, pair, 4)
    assert [w.count(b"\t") + 1 for w in found] == [4, 4, 4, 4, 4, 4, 3, 3] and found[-1] == b"a\tb\tc"


def test_windows_of_numbers_are_those_of_words_in_a_row_for_each_first_pair(spark):
    import pyarrow as pa

    rng = random.Random(3)
    text = b" ".join(rng.choice([b"a", b"B", b"c", b"d.", b"rare", b"e"]) for _ in range(3000))
    words = [b"en\t" + w for w in (b"a", b"b", b"c", b"d", b"e")]
    pairs = [b"en\t" + p for p in (b"a\tb", b"b\tc", b"c\ta", b"a\ta", b"c\td", b"e\ta")]
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key binary")
    word_bits = collocations.set_bits(frame(words), 1 << 17)
    pair_bits = collocations.set_pair_bits(frame(pairs), 1 << 20)
    word, pair = collocations.Frequent(word_bits, b"en\t"), collocations.Frequent(bytes(1 << 17), b"en\t")
    pair.update({p[3:]: True for p in pairs})
    expected = Counter(b"en\t" + w for w in collocations.cut_windows(collocations.marked_words(text), word, pair, 5))
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["en"]), "text": pa.array([text])})
    for hot in (frozenset(), frozenset([b"en\ta\tb"])):
        rows = [r for b in collocations._window_rows(5, word_bits, pair_bits, hot)(iter([batch])) for r in b.to_pylist()]
        found = Counter()
        for r in rows:
            for rest, n in zip(r["rest"], r["n"], strict=True):
                found[r["key"] + b"\t" + rest] += n
        assert found == expected and found.total() > 100
        assert {r["key"] for r in rows if r["salted"]} == hot
        cold = [r["key"] for r in rows if not r["salted"]]
        assert len(cold) == len(set(cold)) < len(found)


def test_counts_over_many_small_batches(odd_documents):
    import pyarrow as pa

    counted = Counter()
    for lang, text in odd_documents:
        start = collocations.escaped((lang or "und").encode()) + b"\t"
        words = collocations.marked_words((text or "").encode())
        for i in range(len(words)):
            end = next((j for j in range(i, min(i + 5, len(words))) if words[j] == collocations.MARK), min(i + 5, len(words)))
            if end > i:
                counted[start + b"\t".join(words[i:end])] += 1
    keys = sorted(counted)
    expected = Counter()
    for key in keys:
        parts = key.split(b"\t")
        for words in range(3, len(parts)):
            expected[b"\t".join(parts[: words + 1]), words] += counted[key]
    for size in (1, 3, 1000):
        runs, found = collocations.Runs(5, 4), Counter()
        for at in range(0, len(keys), size):
            part = keys[at : at + size]
            for prefix, words, n in runs.add(pa.array(part, pa.binary()), np.array([counted[k] for k in part]), np.zeros(len(part), bool)):
                found[prefix, words] += n
        for prefix, words, n in runs.rest():
            found[prefix, words] += n
        assert found == {k: n for k, n in expected.items() if n >= 4}


def test_paths_are_compact_and_cycles_stay_whole(spark):
    line = "a b c d e f g h i j"
    docs = spark.createDataFrame([("en", line)] * 3 + [("en", "x y " * 9)], "lang string, text string")
    _, paths = collocations.mine(docs, least=3)
    assert {(" ".join(r.words), r.n) for r in paths.collect() if r.words[0] == "a"} == {(line, 3)}
    assert sorted(" ".join(r.words) for r in paths.collect() if r.words[0] in "xy") == ["x y x y x", "y x y x y"]


def test_bits_made_by_spark_are_those_that_tasks_look_at(spark):
    keys = [b"en\tw%d" % i for i in range(500)]
    bits = collocations.set_bits(spark.createDataFrame([(k,) for k in keys], "key binary"), 1 << 17)
    frequent = collocations.Frequent(bits, b"en\t")
    assert len(bits) == 1 << 14 and all(frequent[k[3:]] for k in keys)
    assert sum(frequent[b"x%d" % i] for i in range(2000)) < 10


def test_empty_tables_have_no_phrases(spark):
    phrases, paths = collocations.mine(spark.createDataFrame([], "lang string, text string"))
    assert phrases.collect() == [] and paths.collect() == []

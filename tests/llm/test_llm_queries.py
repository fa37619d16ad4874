"""The registered corpus queries: SQL where there is any, else a brute-force version."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from oracle_check import connect, differences
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from almanac.llm import queries
from almanac.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    return {doc_id: text or "" for doc_id, text in rows}


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_thirteen_queries_and_the_pipeline_are_registered():
    registered = contract.queries()
    for n in range(1, 14):
        assert len([q for q in registered if q.startswith(f"op{n}_")]) == 1
    assert registered["pipeline"] is corpus_pipeline.run
    assert set(ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert differences(queries.QUERIES[name](spark, SF), duck, ORACLE[name]) == []


def test_op2_predicts_held_out_documents(spark):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = run(spark, "op2_language_ppm")
    assert sorted(r.doc_id for r in rows) == sorted(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held_out) >= 0.97 * len(held_out)
    assert all(0 <= r.score <= 1 for r in rows)


def brute_fingerprint(text):
    lowered = text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=4):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    array = np.array([prints[i] for i in ids], dtype=np.uint64)
    for j, a in enumerate(ids):
        for k in np.flatnonzero(np.bitwise_count(array[j + 1 :] ^ array[j]) <= max_bits):
            p, q = find(a), find(ids[j + 1 + k])
            parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_op3_equals_all_pairs(spark, texts):
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    expected = {(i, f"{prints[i]:016x}", c) for i, c in brute_components(prints).items()}
    assert {tuple(r) for r in run(spark, "op3_simhash_golay")} == expected


def digits(value):
    return "".join(c for c in value if c in "0123456789")


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        doubled = int(c) * (1 + i % 2)
        total += doubled - 9 * (doubled > 9)
    return total % 10 == 0


PRIVATE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(digits(m[0])) <= 15),
)
SECRET = (
    (
        "assign",
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        lambda m: len(m[2]) >= 6,
    ),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def brute_spans(text, kinds):
    return sorted(
        (m.start(), k, m.end(), name) for k, (name, pattern, ok) in enumerate(kinds) for m in pattern.finditer(text) if ok(m)
    )


def joined(found):
    return ",".join(f"{name}:{start}:{end}" for start, _, end, name in found)


@pytest.mark.parametrize(("name", "kinds"), [("op4_private_data", PRIVATE), ("op10_secret_scan", SECRET)])
def test_base_spans_equal_a_plain_search(spark, texts, name, kinds):
    rows = run(spark, name)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        found = brute_spans(texts[r.doc_id], kinds)
        assert r.base_sha256 == hashlib.sha256(joined(found).encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind, _, _ in kinds] == [sum(f[3] == kind for f in found) for kind, _, _ in kinds]
        # A text without base spans may have spans of the method.
        assert {joined([f]) for f in found} <= set(r.spans.split(","))


def test_op5_files_hold_every_id(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expected = 0, []
    for doc_id in sorted(texts):
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in run(spark, "op5_token_files")) == expected


def test_op9_shards_are_even_and_keep_equal_texts_together(spark, texts):
    rows = run(spark, "op9_shard_packing")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    shard_of, slots, size = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        shard_of[texts[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
    assert all(len(shards) == 1 for shards in shard_of.values())
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) <= 1.02 * sum(size.values()) / 24


def test_pipeline_equals_its_stages_by_brute_force(spark, texts):
    leaks = {r.doc_id for r in run(spark, "op8_benchmark_leaks") if r.contaminated}
    readable = {i: t for i, t in texts.items() if any(c.isalpha() for c in t)}
    components = brute_components({i: brute_fingerprint(t) for i, t in readable.items()})
    kept = {i for i in readable if components[i] == i} - leaks
    source_of = dict(duckdb.sql(f"SELECT doc_id, source FROM '{SF}/documents.parquet'").fetchall())
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", texts[i])) for i in kept}
    rows = contract.queries()["pipeline"](spark, SF).collect()
    assert {r.doc_id for r in rows} <= kept
    size, taken, copies = defaultdict(int), defaultdict(int), defaultdict(int)
    for i in kept:
        size[source_of[i]] += words[i]
    for r in rows:
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        copies[r.doc_id] += 1
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert max(copies.values()) <= 3
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(size))}
    level, full = 0.0, None
    while full != (full := {s for s in size if weights[s] * level >= 3 * size[s]}):
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        level = rest / sum(weights[s] for s in size if s not in full)
    for s in size:
        assert abs(taken[s] - min(3 * size[s], weights[s] * level)) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows))) for k in range(24))

"""Small pieces of the corpus operators against plain versions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from almanac.llm import decontaminate, golay, packing_tree, simhash, spans, token_files
from almanac.llm.components import components


def test_the_code_is_perfect():
    assert {int(n) for n in (golay.NEARBY >= 0).sum(axis=1)} == {1, 6}
    weights = np.bitwise_count(golay.NEARBY[:, 0])
    assert np.bincount(weights).tolist() == [1, 23, 253, 1771]


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
@settings(max_examples=300, deadline=None)
def test_fingerprints_within_four_bits_share_a_key(value, flips):
    other = value
    for bit in flips:
        other ^= 1 << bit
    keys, rows = golay.keys(np.array([value, other], dtype=np.uint64))
    assert set((keys[rows == 0] >> 1).tolist()) & set((keys[rows == 1] >> 1).tolist())


def plain_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize(
    "edges",
    [
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 50)] + [(100, 99), (99, 98), (98, 100)],
        [(random.Random(1).randrange(200), random.Random(i).randrange(200)) for i in range(150)],
        [],
    ],
)
def test_components(spark, edges):
    result = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert dict(map(tuple, result.collect())) == plain_components([e for e in edges if e[0] != e[1]])


def test_blocks_of_a_large_key_lose_no_link(spark):
    source = random.Random(7)
    base = source.getrandbits(64)
    values = {base}
    while len(values) < 300:
        value = base
        for bit in source.sample(range(64), 3):
            value ^= 1 << bit
        values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    prints = spark.createDataFrame([(v,) for v in signed], "print bigint")
    found = simhash.links(prints, 4, most_rows=16).collect()
    assert len(set(plain_components([tuple(r) for r in found]).values())) == 1
    assert all((r.a ^ r.b).bit_count() <= 4 for r in found if (r.a < 0) == (r.b < 0))


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70))
@settings(max_examples=200, deadline=None)
def test_packing_round_trip(bits, values):
    ids = np.array([v % 2**bits for v in values], dtype=np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert token_files.unpack(data, bits, len(ids)).tolist() == ids.tolist()


def test_any_run_of_a_file_can_be_read(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 16)
    monkeypatch.setattr(token_files, "BLOCKS_AT_ONCE", 2)
    docs = [np.arange(n, dtype="<u4") * 7 % 1000 for n in (5, 0, 40, 100, 1)]
    with open(tmp_path / "f", "wb") as out:
        writer = token_files.Writer(out, 10)
        for i, ids in enumerate(docs):
            writer.add(None if i == 1 else i, ids.tobytes())
        writer.close()
    with token_files.fs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as file:
        reader = token_files.Reader(file)
        everything = np.concatenate(docs)
        assert reader.nulls.tolist() == [False, True, False, False, False]
        for a in range(0, len(everything), 7):
            for b in range(a, len(everything), 11):
                assert reader.ids(a, b).tolist() == everything[a:b].tolist()


def test_encoders_give_the_tokenizers_ids():
    from almanac.llm.queries import TOKENIZER

    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = [
        "a\x0bb\x0cc\x1cd", "café cafe\u0301 \u0301x", "<|endoftext|>a <|startoftext|>.B <|ENDOFTEXT|>", "it's it 's I'LL x\u0085y it.'s 'd",
        "ΑΣ ΟΔΟΣ. İ I\u0307 J\u030c. Kelvin \u212a", "", "a1b2.c—d…e.'f g'.h \U0001f600! x_y=z\u0338", "\x00a\x1fb\x7f",
    ]
    for make in (token_files.WordEncoder, token_files.TextEncoder):
        encode = make(tokenizer)
        for text in texts:
            ids = np.frombuffer(encode(text.encode()), dtype="<u4").tolist()
            assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@given(st.text(alphabet=st.sampled_from(list("aBé.'1<|> \n\u0301ßİΣ-")), max_size=12))
@settings(max_examples=300, deadline=None)
def test_any_text_is_encoded_as_by_the_tokenizer(text):
    from almanac.llm.queries import TOKENIZER

    encode = token_files.encoder_at(TOKENIZER, True)
    ids = np.frombuffer(encode(text.encode()), dtype="<u4").tolist()
    assert ids == encode.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 60), max_size=80), st.integers(60, 100))
@settings(max_examples=100, deadline=None)
def test_best_fit_decreasing_equals_a_scan_over_all_bins(sizes, capacity):
    items = list(enumerate(sizes))
    left, expected = [], {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        fits = [(room, b) for b, room in enumerate(left) if room >= size]
        place = min(fits)[1] if fits else len(left)
        if not fits:
            left.append(capacity)
        left[place] -= size
        expected[item] = place
    assert packing_tree.best_fit_decreasing(items, capacity) == expected


WORDS = st.lists(st.sampled_from(["a", "b", "c"]), max_size=40)


@given(WORDS, st.lists(WORDS, max_size=4), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_search_equals_comparing_everywhere(words, items, window):
    texts = [(str(i), " ".join(item).encode()) for i, item in enumerate(items)]
    patterns = {}
    for name, text in texts:
        item = text.split()
        for at in range(max(1, len(item) - window + 1) if item else 0):
            patterns.setdefault(tuple(item[at : at + window]), set()).add(name)
    hits, names = set(), set()
    for pattern, owners in patterns.items():
        for at in range(len(words) - len(pattern) + 1):
            if tuple(w.encode() for w in words[at : at + len(pattern)]) == pattern:
                hits |= set(range(at, at + len(pattern)))
                names |= set(owners)
    ranges, found = decontaminate.Tables(texts, window).occurrences([w.encode() for w in words])
    covered = {x for a, b in zip(ranges[::2], ranges[1::2], strict=True) for x in range(a, b)}
    assert (covered, found) == (hits, names)


def test_places_count_code_points_and_blocks_join(spark):
    text = "\U0001f600é " + "ab " * 700
    found = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(spans.find(F.col("t"), "a", context=2).alias("f"))
    rows = [r.f for r in found.collect()]
    assert [(s.start, s.end) for s in rows[0]] == [(3 + 3 * i, 4 + 3 * i) for i in range(700)]
    assert (rows[0][0].before, rows[0][0].after) == ("é ", "b ")
    assert rows[1] == rows[2] == []

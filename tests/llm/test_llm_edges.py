"""Every operator and stage on nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanac.llm import (
    decontaminate,
    language,
    mixing,
    private_data,
    reputation,
    secret_scan,
    sharding,
    simhash,
    token_files,
    topk,
)
from almanac.llm.queries import TOKENIZER

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "the quick brown fox jumps over the lazy dog near the old river bank " * 3000
ROWS = [
    (1, LONG, "en", "a", len(LONG)),
    (2, "", "en", "a", 0),
    (3, None, "en", "a", None),
    (4, "one two three four five six seven eight nine ten eleven", None, None, 1),
    (4, "one two three four five six seven eight nine ten eleven", None, None, 1),
    (None, "one two three four five six seven eight nine ten eleven", "en", "b", 1),
    (None, None, None, None, None),
    (5, "mail a.b@example.org or +1 222 333 4444, token=abcdef123456", "en", "b", 1),
    (6, "der schnelle braune Fuchs springt über den faulen Hund", "de", "b", 1),
    (7, " \t\n", "de", "b", 3),
    (8, "12345 678 !!", "de", "b", 1),
]
# Names that operators use for their own columns.
CLASHING = (
    "size", "target", "taken", "tail", "epochs", "source_size", "shard", "slot", "fingerprint", "component_id", "lang_pred",
    "score", "bits_per_byte", "spans", "__row", "__base", "__terms", "__told", "__print", "__of", "__root", "__kept", "__doc",
    "__key", "__range", "__cut", "__side", "__group", "__item", "__unit", "__found", "__new", "__scored", "given", "sanitised", "n_words", "n_hit", "n_items", "items", "contaminated", "key", "rows", "root",
)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.withColumns({c: F.lit(f"given {c}") for c in CLASHING})


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, "Two, three four five six seven eight nine ten ELEVEN"), (2, None), (3, ""), (None, "lazy dog near"), (4, "lazy dog near")],
        "item_id bigint, text string",
    )


def operators(benchmark):
    return {
        "language": lambda d: language.predict(d, language.train(d)),
        "simhash": simhash.cluster,
        "private": private_data.sanitise,
        "mix": mixing.mix,
        "leaks": lambda d: decontaminate.find_leaks(d, benchmark),
        "shard": lambda d: sharding.assign(d, shards=3),
        "secrets": secret_scan.scan,
    }


NAMES = ["language", "simhash", "private", "mix", "leaks", "shard", "secrets"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(benchmark, none, name):
    assert operators(benchmark)[name](none).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_every_row_comes_back_once_with_the_columns_it_had(benchmark, odd, name):
    rows = operators(benchmark)[name](odd).select(*odd.columns).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, ROWS))


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns_do_not_change_the_result(benchmark, odd, clashing, name):
    operator = operators(benchmark)[name]
    plain = operator(odd)
    added = [c for c in plain.columns if c not in odd.columns]
    given = [c for c in CLASHING if c not in added]
    result = operator(clashing)
    assert sorted(map(repr, result.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    assert all(r[c] == f"given {c}" for r in result.select(*given).collect() for c in given)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_keep_the_columns_of_documents(spark, none, clashing, name, stage):
    sf_dir = "/root/testdata/sf0.001"
    assert stage(spark, none, sf_dir).collect() == []
    result = stage(spark, clashing, sf_dir)
    assert result.count() > 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert result.columns == clashing.columns
        assert all(r[c] == f"given {c}" for r in result.collect() for c in CLASHING)


def test_language_values(odd):
    rows = {(r.doc_id, r.text): r for r in language.predict(odd, language.train(odd)).collect()}
    for doc_id, text in ((2, ""), (3, None), (None, None), (7, " \t\n"), (8, "12345 678 !!")):
        r = rows[doc_id, text]
        assert (r.lang_pred, r.score, r.bits_per_byte) == ("und", 0.0, None)
    assert rows[1, LONG].lang_pred == "en"
    assert rows[6, ROWS[8][1]].lang_pred == "de"


def test_a_text_longer_than_a_chunk_costs_what_its_parts_cost(monkeypatch):
    trees = language.Trees(["a", "b"], [(0, int.from_bytes(b"abcde"), 3), (1, int.from_bytes(b"abcdx"), 2)])
    text = b"abcde abcdx " * 40
    whole = trees.score([text])
    monkeypatch.setattr(language, "CHUNK", 37)
    assert abs(language._long(trees, text) - whole).max() < 1e-3


def test_code_lengths_follow_the_escape_rule():
    # After "ab" come c (3 times) and d (once); "x" has never been seen.
    trees = language.Trees(["l"], [(0, int.from_bytes(b"abc"), 3), (0, int.from_bytes(b"abd"), 1)], order=2)
    bits = trees.code_lengths(language.np.array([int.from_bytes(b"abc"), int.from_bytes(b"abd"), int.from_bytes(b"abx"), int.from_bytes(b"zzc")]))
    log2 = language.np.log2
    escape = log2(6 / 2)  # at each order: 4 times, 2 kinds
    assert bits[:, 0] == pytest.approx([log2(6 / 3), log2(6 / 1), 3 * escape + 8, log2(6 / 3)], abs=1e-6)


def test_simhash_values(odd):
    rows = simhash.cluster(odd).collect()
    empty = [r for r in rows if r.text is None or not r.text.strip()]
    assert {(r.fingerprint, r.component_id) for r in empty} == {("0" * 16, 2)}
    assert {r.component_id for r in rows if r.text and r.text.startswith("one two")} == {4}
    kept = simhash.keep_one(odd).collect()
    assert len(kept) == len({r.component_id for r in rows})


def test_simhash_component_of_null_ids_only(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (1, "u v w x y z")], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.cluster(docs).collect()} == {(None, None), (1, 1)}
    assert simhash.keep_one(docs).count() == 2


def test_private_values(odd):
    rows = {r.doc_id: r for r in private_data.sanitise(odd).collect() if r.doc_id in (2, 3, 5)}
    assert rows[5].sanitised == "mail <email> or <phone>, token=abcdef123456"
    assert (rows[2].sanitised, rows[2].spans, rows[3].sanitised, rows[3].spans) == ("", [], None, [])


def test_a_term_that_stands_only_next_to_an_entity_is_removed_there(spark):
    secret = "Contact the zorblax clerk at x@example.org today"
    plain = "the clerk at the desk may contact you today or at any other day " * 5
    docs = spark.createDataFrame([(i, secret) for i in range(4)] + [(10 + i, plain) for i in range(40)], "doc_id bigint, text string")
    rows = private_data.sanitise(docs, generalise=0.9, remove=0.97).collect()
    assert {r.sanitised for r in rows if r.doc_id < 4} == {"Contact the  clerk at <email> today"}
    assert {r.sanitised for r in rows if r.doc_id >= 10} == {plain}


def test_mix_values(odd):
    rows = mixing.mix(odd).collect()
    assert all(r["size"] == 0 and r.taken == 0 for r in rows if not (r.text or "").split())
    for source in ("a", "b", None):
        own = [r for r in rows if r.source == source]
        assert {r.source_size for r in own} == {sum(r["size"] for r in own)}
        assert sum(r.taken for r in own) == round(own[0].target)
        assert all(r.taken <= 3 * r["size"] for r in own)
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert sorted(map(repr, mixing.mix(odd).collect())) == sorted(map(repr, rows))


def test_mix_cuts_a_source_inside_a_document(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(["word"] * 10), s) for i, s in enumerate("aaaabb")], "doc_id bigint, text string, source string"
    )
    # Weights 1 and 2 share 60 words: 20 of 40, and 40 of 20.
    taken = {s: sum(r.taken for r in mixing.mix(docs, (1.0, 2.0)).collect() if r.source == s) for s in "ab"}
    assert taken == {"a": 20, "b": 40}
    mixed = mixing.mixed_documents(docs, weights=(1.0, 3.0)).collect()
    assert {s: sum(len(r.text.split()) for r in mixed if r.source == s) for s in "ab"} == {"a": 15, "b": 45}


def test_leaks_values(odd, benchmark):
    rows = {(r.doc_id, r.text): r for r in decontaminate.find_leaks(odd, benchmark).collect()}
    one = rows[4, ROWS[3][1]]
    assert (one.n_words, one.n_hit, one["items"], one.contaminated) == (11, 10, ["1"], True)
    long = rows[1, LONG]
    assert (long.n_hit, long["items"]) == (3 * 3000, ["4", "null"])
    assert rows[3, None].n_words == 0 and not rows[3, None].contaminated


def test_leaks_without_a_benchmark(odd, benchmark):
    assert not any(r.contaminated for r in decontaminate.find_leaks(odd, benchmark.limit(0)).collect())


def test_searching_in_parts_finds_the_same(odd, benchmark):
    whole, parts = (
        sorted(map(repr, decontaminate.find_leaks(odd, benchmark, most_bytes=n).collect())) for n in (1 << 20, 20)
    )
    assert whole == parts


def test_searching_in_parts_writes_texts_once(odd, benchmark, monkeypatch):
    written, stage = [], decontaminate.stage

    def noted(df, label):
        written.append((label, "text" in df.columns))
        return stage(df, label)

    monkeypatch.setattr(decontaminate, "stage", noted)
    assert decontaminate.find_leaks(odd, benchmark, most_bytes=20).count() == len(ROWS)
    assert len(written) > 3 and [label for label, texts in written if texts] == ["leak-documents"]


def test_a_part_of_the_benchmark_is_built_once_in_a_worker():
    items = [("a", b"one two three"), ("b", b"one two four")]
    first = decontaminate.tables_of("part", items, 2)
    assert decontaminate.tables_of("part", items, 2) is first
    assert decontaminate.tables_of("next part", items, 2) is not first
    assert first.occurrences([b"zero", b"one", b"two", b"four"]) == ([1, 4], {"a", "b"})


def test_shard_values(odd):
    rows = sharding.assign(odd, shards=3).collect()
    assert {r["size"] for r in rows if r.text is None} == {8}
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert len({r.shard for r in rows if r.text and r.text.startswith("one two")}) == 1


def test_shards_of_a_fixed_capacity(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.format_string("%092d", "id").alias("text"))
    sizes = [r.n for r in sharding.assign(docs, capacity=1000).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert max(sizes) <= 1000 and len(sizes) == 30


def test_secret_values(odd):
    rows = {r.doc_id: r for r in secret_scan.scan(odd).collect() if r.doc_id in (2, 3, 5)}
    assert [(s.start, s.kind_no, s.end) for s in rows[5].spans] == [(41, 0, 59)]
    assert rows[2].spans == rows[3].spans == []


def test_a_random_token_is_reported_and_an_identifier_is_not(spark):
    words = "thisIsAnOrdinaryName2 anotherOrdinaryIdentifier yetAnotherIdentifierHere"
    docs = spark.createDataFrame([(1, f"{words} xK9fQ2mZp7Lw4Rt8Yb1Nv"), (2, words), (3, words)], "doc_id bigint, text string")
    rows = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secret_scan.scan(docs).collect()}
    assert rows == {1: [(len(words) + 1, len(words) + 22)], 2: [], 3: []}


def test_token_files_values(odd, none, spark):
    rows = token_files.read_documents(spark, token_files.write(odd, TOKENIZER, by_words=True)).orderBy("start").collect()
    assert [r.doc_id for r in rows][:2] == [None, None] and sorted(r.doc_id for r in rows[2:]) == [r.doc_id for r in rows[2:]]
    starts = [0]
    for r in rows:
        assert r.start == starts[-1]
        starts.append(r.start + r.n_tokens)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 7)} == {1}
    assert token_files.read_documents(spark, token_files.write(none, TOKENIZER)).collect() == []


def test_top_k_values(spark):
    vectors = spark.createDataFrame(
        [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0]), (2, [1.0, None]), (3, None), (4, [float("nan"), 1.0]), (None, [9.0, 9.0]), (5, [0.5, -1.0]), (6, [1.0]), (7, [])],
        "vec_id bigint, embedding array<double>",
    )
    rows = topk.search(vectors, k=3).collect()
    # Each of the two equal queries finds its twin, then the ties by id.
    expected = [(0, 1, 0, 64 * 64 * 5), (0, 2, 1, 4096), (0, 3, 6, 4096)]
    assert sorted(tuple(r) for r in rows) == sorted(expected * 2)
    assert topk.search(vectors.where("vec_id > 0")).collect() == []
    assert topk.search(vectors.limit(0)).collect() == []


def test_reputation_values(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.good.org/x?y"), (2, "https://a.good.org"), (3, "http://b.bad.net/fr/#z"), (4, None), (5, "nonsense"), (None, "http://b.bad.net/fr/"), (7, "http://b.bad.net:80/fr/")],
        "page_id bigint, url string",
    ).withColumns({c: F.lit("given") for c in ("host", "good", "mean", "k", "n", "page")})
    labels = spark.createDataFrame([(1, True), (1, True), (2, True), (3, False), (3, None), (None, True)], "page_id bigint, good boolean")
    rows = {(r.page_id, r.url): r for r in reputation.judge(pages, labels, (("net/fr/", "allow"),)).collect()}
    assert len(rows) == 7
    first = rows[1, "http://A.good.org/x?y"]
    assert (first.host, first.path, first.rule, first.k) == ("a.good.org", "/x", None, "given")
    assert (rows[3, "http://b.bad.net/fr/#z"].rule, rows[3, "http://b.bad.net/fr/#z"].verdict) == ("net/fr/", "allow")
    assert rows[7, "http://b.bad.net:80/fr/"].rule is None
    assert [rows[k].host for k in ((4, None), (5, "nonsense"))] == ["", ""]
    assert first.host_mean > rows[3, "http://b.bad.net/fr/#z"].host_mean
    assert reputation.judge(pages.limit(0), labels).collect() == []
    assert reputation.judge(pages, labels.limit(0)).select("host_mean").distinct().collect()[0][0] == 0.5


def test_labels_decide_where_no_rule_fits(spark):
    pages = spark.range(60).select(
        F.col("id").alias("page_id"), F.when(F.col("id") < 30, "http://fine.org/").otherwise("http://spam.net/").alias("url")
    )
    labels = pages.select("page_id", (F.col("page_id") < 30).alias("good"))
    rows = reputation.judge(pages, labels).collect()
    assert {(r.host, r.verdict) for r in rows} == {("fine.org", "allow"), ("spam.net", "block")}


def test_pages_keep_columns_named_like_an_operators_own(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "given"), (2, None, None)], "page_id bigint, url string, __host string")
    labels = spark.createDataFrame([(1, True)], "page_id bigint, good boolean")
    plain = reputation.judge(pages.drop("__host"), labels)
    rows = {r.page_id: r.asDict() for r in reputation.judge(pages, labels).collect()}
    assert {i: r.pop("__host") for i, r in rows.items()} == {1: "given", 2: None}
    assert rows == {r.page_id: r.asDict() for r in plain.collect()}

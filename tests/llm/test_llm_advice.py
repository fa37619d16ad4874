"""Cases in which an operator did less than its whole job."""

import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanac.llm import language, private_data, queries, secret_scan, topk

SCHEMA = "doc_id bigint, text string, lang string"


@pytest.mark.parametrize("copies", [1, 3])
def test_labelled_unreadable_text_does_not_teach_its_own_grams(spark, copies):
    source = random.Random(3)
    words = "the quick brown fox jumps over a lazy dog near an old river bank while rain falls on green hills".split()
    plain = [(i, " ".join(source.choices(words, k=60)), "en") for i in range(40)]
    noise = [" ".join("".join(source.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(60)) for _ in range(4)]
    planted = [(100 * (c + 1) + i, text, "en") for c in range(copies) for i, text in enumerate(noise)]
    docs = spark.createDataFrame(plain + planted, SCHEMA)
    kept = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [i for i, _, _ in plain]


def test_copies_are_judged_by_trees_without_their_grams(spark):
    text = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz", k=500))
    docs = spark.createDataFrame([(1, text, "en"), (2, text.upper() + " 1!", "en"), (3, "one plain text", "en")], SCHEMA)
    trees = language.train_folds(docs)
    fold = language.fold_of(text.encode(), 2)
    own, other = (trees[k].score([text.encode()])[0, 0] if trees[k].languages else None for k in (fold, 1 - fold))
    assert own < 2 * len(text)
    assert other is None or other > 4 * len(text)


def test_texts_that_nothing_can_judge_stay(spark):
    docs = spark.createDataFrame([(1, "a single text", "en"), (2, "123", "en")], SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()] == [1]


def test_a_card_that_begins_inside_an_address_is_not_left_readable(spark):
    text = next(
        f"x 10.0.0.4 4111 1111 1111 {n:04d} y" for n in range(10000)
        if private_number_passes(f"4411111111111{n:04d}")
    )
    row = private_data.sanitise(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row.sanitised == "x <ip><card> y"


def private_number_passes(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def test_many_spans_are_rewritten_as_one_by_one(spark):
    text = "".join(f"\u00fc{i} a{i}@b.org, 10.0.0.4 4111 1111 1111 {i:04d}; " for i in range(700)) + "end"
    row = private_data.sanitise(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    to, expected = 0, ""
    for s in row.spans:
        if s.end > to:
            expected += text[to : max(to, s.start)]
            expected += f"<{private_data.KINDS[s.kind_no]}>" if s.kind_no < private_data.TERM else ""
            assert s.kind_no < private_data.TERM or s.removed
            to = s.end
    assert len(row.spans) > 2 * 256 and row.sanitised == expected + text[to:]


def test_op4_runs_the_rewriting(spark):
    plan = queries.QUERIES["op4_private_data"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "<email>" in plan and "sha2(" in plan


def test_other_numbers_do_not_end_the_context_of_a_card(spark):
    secret = "Zorblax Quux, customer 7: 4111 1111 1111 1111 paid"
    plain = "the customer paid at the desk and the customer paid at the door " * 20
    docs = spark.createDataFrame([(i, secret) for i in range(4)] + [(10 + i, plain) for i in range(40)], "doc_id bigint, text string")
    rows = private_data.sanitise(docs).collect()
    assert {r.sanitised for r in rows if r.doc_id < 4} == {" , customer 7: <card> paid"}


def test_a_disclosing_term_goes_wherever_it_stands_in_a_document_of_its_entity(spark):
    far = "the clerk at the desk may contact you today or at any other day " * 5
    secret = "Contact the zorblax clerk at x@example.org today"
    docs = spark.createDataFrame(
        [(i, secret) for i in range(9)] + [(9, f"{secret} {far}Zorblax")] + [(10 + i, far) for i in range(90)], "doc_id bigint, text string"
    )
    rows = {r.doc_id: r.sanitised for r in private_data.sanitise(docs, generalise=0.8, remove=0.97).collect()}
    assert rows[9].startswith("Contact the ") and "orblax" not in rows[9]


def plain_texts(n, words_each=60):
    source = random.Random(11)
    words = "report station value river green water paper winter garden simple letter number season market".split()
    return [(i, " ".join(source.choices(words, k=words_each)), "en") for i in range(n)]


def test_a_name_beside_an_address_that_occurs_once_goes(spark):
    text = "letter from Maria Kellermann at maria.kellermann@example.org about the winter market"
    docs = spark.createDataFrame([*plain_texts(60), (100, text, "en")], SCHEMA)
    row = private_data.sanitise(docs).where("doc_id = 100").first()
    terms = {text[s.start : s.end] for s in row.spans if s.kind_no == private_data.TERM}
    assert {"Maria", "Kellermann"} <= terms and not terms & {"letter", "winter", "market"}
    assert "Kellermann" not in row.sanitised and "<email>" in row.sanitised and "winter market" in row.sanitised


def test_a_name_told_often_is_removed_and_a_lone_text_tells_nothing(spark):
    text = "Kellermann wrote to a.b@example.org in winter"
    docs = spark.createDataFrame([*plain_texts(60), *[(100 + i, text, "en") for i in range(3)]], SCHEMA)
    row = private_data.sanitise(docs).where("doc_id = 100").first()
    assert "Kellermann" not in row.sanitised and "<Term>" not in row.sanitised
    alone = private_data.sanitise(docs.where("doc_id = 100")).first()
    assert all(s.kind_no < private_data.TERM for s in alone.spans)


SECRETS = ["qXvBzKpLwRtYhGmNcDfSjQ", "8361947250183746", "xvbqzkpwjrtyhgmncdfsjqxz", "QZXVKJWPBTYHGMFDQXZJKV", "x9K2-qP7_Zw4+Lm8/Vb3"]


def test_the_ratio_alone_decides_about_a_token(spark):
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    names = "station_report_of_the_season waterGardenNumberMarket THEREATIONALENTER green-paper-winter-letter"
    planted = spark.createDataFrame(
        [(-1 - i, f"the value {secret} is in the paper") for i, secret in enumerate(SECRETS)] + [(-99, names)], "doc_id bigint, text string"
    )
    rows = secret_scan.scan(corpus.unionByName(planted)).where("doc_id < 0").collect()
    found = {r.doc_id: [r.text[s.start : s.end] for s in r.spans] for r in rows}
    assert found.pop(-99) == []
    assert found == {-1 - i: [secret] for i, secret in enumerate(SECRETS)}


def test_finite_vectors_of_any_size_take_part(spark):
    vectors = [(20, [2.0, 1.0]), (21, [3e6, 1.0]), (22, [-3e6, 0.0]), (23, [1.0, 1.0]), (24, [1e12, -1e12]), (25, [2.0]), (40, [0.0, 5.0]), (26, [1e300, 0.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)

    def expected(rows, query):
        weights = {i: [int(64 * x // 1) for x in v] for i, v in rows}
        found = [(-sum(a * b for a, b in zip(weights[query], w)), i) for i, w in weights.items() if i != query]
        return [(query, rank, i, -score) for rank, (score, i) in enumerate(sorted(found), 1)]

    kept = vectors[:-1]
    rows = topk.search(table.where("vec_id <> 26")).collect()
    assert sorted(map(tuple, rows)) == sorted(expected(kept, 20) + expected(kept, 40))
    assert rows and {r.vec_id for r in rows if r.query_id == 20 and r["rank"] == 2} == {21}
    # Query 40 weighs nothing where 26 is large; query 20 makes a score that no long holds.
    rows = topk.search(table.where("vec_id <> 20")).collect()
    assert sorted(map(tuple, rows)) == expected(vectors[1:], 40)
    with pytest.raises(Exception, match="does not fit"):
        topk.search(table).collect()


def test_a_language_of_which_nothing_was_learnt_wins_no_text(spark):
    rows = [*plain_texts(30), *[(100 + i, "12345 - 678", "xx") for i in range(5)]]
    trees = language.train(spark.createDataFrame(rows, SCHEMA))
    assert trees.languages == ["en"]
    unfamiliar = spark.createDataFrame([(1, "zebra quiz vex", None), (2, "Это совсем другой язык", None), (3, "12345", None)], SCHEMA)
    predicted = {r.doc_id: r.lang_pred for r in language.predict(unfamiliar, trees).collect()}
    assert predicted == {1: "en", 2: "en", 3: "und"}


def test_a_language_of_few_long_texts_is_learnt_from_one_at_least(spark):
    words = "ein langer deutscher Text mit vielen Wörtern über Flüsse und Berge "
    rows = [*plain_texts(30), *[(100 + i, words * 300 + str(i), "de") for i in range(4)]]
    for most_bytes in (10, 1000):
        trees = language.train(spark.createDataFrame(rows, SCHEMA), most_bytes=most_bytes)
        assert trees.languages == ["de", "en"]


def plain_code_length(text, counts, order):
    """Bits of a text by escape method C, symbol by symbol, straight from the rule."""
    total = 0.0
    for i in range(len(text)):
        for n in range(order, -1, -1):
            context = tuple(text[j] if j >= 0 else 32 for j in range(i - n, i))
            seen = counts.get(context, {})
            kinds, times = len(seen), sum(seen.values())
            if text[i] in seen:
                total += math.log2((times + kinds) / seen[text[i]])
                break
            if kinds:
                total += math.log2((times + kinds) / kinds)
        else:
            total += 8.0
    return total


def test_whole_documents_score_as_a_plain_coder_does(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").limit(40)
    trees = language.train(docs)
    rows = docs.select("doc_id", "lang", language.letters(F.col("text")).alias("letters")).collect()
    models = {}
    for r in rows:
        if r.letters is None or r.lang is None:
            continue
        text, model = r.letters.encode(), models.setdefault(r.lang, {})
        for i in range(len(text)):
            for n in range(language.ORDER + 1):
                context = tuple(text[j] if j >= 0 else 32 for j in range(i - n, i))
                seen = model.setdefault(context, {})
                seen[text[i]] = seen.get(text[i], 0) + 1
    predicted = {r.doc_id: r for r in language.predict(docs, trees).collect()}
    checked = 0
    for r in rows:
        if r.letters is not None and len(r.letters) < 3000:
            bits = {l: plain_code_length(r.letters.encode(), m, language.ORDER) / len(r.letters.encode()) for l, m in models.items()}
            best = min(sorted(bits), key=bits.get)
            assert predicted[r.doc_id].lang_pred == best
            assert predicted[r.doc_id].bits_per_byte == pytest.approx(bits[best], abs=1e-3)
            assert predicted[r.doc_id].score == pytest.approx(1 / sum(2 ** (bits[best] - b) for b in bits.values()), abs=1e-3)
            checked += 1
    assert checked > 20

import hashlib
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from almanac.functions import keys, text
from almanac.functions.schedule import step_of


def one(spark, value, **columns):
    return spark.createDataFrame([(value,)], "v string").select(*[c.alias(n) for n, c in columns.items()]).first()


def test_surrogate_key_and_token_come_from_the_key(spark):
    digest = hashlib.md5(b"17").hexdigest()
    got = spark.range(17, 18).select(keys.surrogate_key("id").alias("k"), keys.user_token("id").alias("t")).first()
    assert got.k == int(digest[:8], 16) % 123456789
    assert got.t == digest[:10]


def test_random_keys_have_the_right_shape(spark):
    rows = spark.range(200).select(keys.random_surrogate_key().alias("k"), keys.random_user_token().alias("t"))
    got = rows.collect()
    assert all(0 <= r.k < 123456789 and len(r.t) == 10 and int(r.t, 16) >= 0 for r in got)
    assert len({r.t for r in got}) == 200


def test_keyed_hash_of_several_columns(spark):
    got = spark.range(1).select(keys.keyed_hash(3, "id", F.lit("x")).alias("h")).first().h
    assert got == hashlib.md5(b"3:0:x").hexdigest()


def test_json_fields(spark):
    doc = '{"json": {"priority": 5}, "message": "Hello World"}'
    got = one(
        spark, doc,
        message=text.json_field("v", "$.message"), gone=text.json_field("v", "$.other"),
        five=text.json_equals("v", "$.json.priority", 5), six=text.json_equals("v", "$.json.priority", 6),
        absent=text.json_equals("v", "$.x", 5), word=text.json_int("v", "$.message"),
    )
    assert tuple(got) == ("Hello World", "", True, False, False, None)
    broken = one(spark, "not json", message=text.json_field("v", "$.message"), ok=text.json_equals("v", "$.k", 5))
    assert tuple(broken) == ("", False)


def test_several_json_fields_from_one_parse(spark):
    docs = spark.createDataFrame([(1, '{"a": 5, "b": "x"}'), (2, "not json"), (3, None)], "id int, doc string")
    got = text.with_json_fields(docs, "doc", ["a", "b", "c"]).orderBy("id").collect()
    assert [(r.a, r.b, r.c) for r in got] == [("5", "x", None), (None, None, None), (None, None, None)]


def test_url_parameters_are_decoded(spark):
    url = "http://h.example.com/get?param1=value1&param2=a%20b%26c&empty=#frag"
    got = one(
        spark, url, host=text.url_host("v"), p1=text.url_param("v", "param1"),
        p2=text.url_param("v", "param2"), none=text.url_param("v", "frag"),
    )
    assert tuple(got) == ("h.example.com", "value1", "a b&c", None)


def test_form_fields_and_bad_input(spark):
    assert one(spark, "name=Joe&x=1", n=text.form_param("v", "name")).n == "Joe"
    assert one(spark, "some=data", n=text.form_param("v", "name")).n is None
    assert one(spark, "http://bad host/%zz", h=text.url_host("v")).h is None


def test_text_check_reads_the_whole_body(spark):
    long = "x" * 100_000 + "httpbin"
    assert one(spark, long, ok=text.has_text("v", "httpbin")).ok
    assert not one(spark, long, ok=text.has_text("v", "httpbun")).ok


def test_render(spark):
    assert one(spark, "r1", m=text.render("run %s of %s", "v", F.lit("x"))).m == "run r1 of x"


@pytest.mark.parametrize(
    "schedule, step",
    [
        (timedelta(hours=4), "14400 seconds"),
        (timedelta(minutes=10), "600 seconds"),
        (timedelta(1), "86400 seconds"),
        ("@daily", "1 day"),
        ("0 0 * * *", "1 day"),
        ("*/1 * * * *", "1 minutes"),
        ("4 hours", "4 hours"),
    ],
)
def test_schedules_with_a_fixed_step(schedule, step):
    assert step_of(schedule) == step


@pytest.mark.parametrize("schedule", ["@once", "@monthly", "*/7 * * * *", "0 0 1 * *", "1 month", timedelta(0)])
def test_schedules_without_a_fixed_step(schedule):
    with pytest.raises(ValueError):
        step_of(schedule)

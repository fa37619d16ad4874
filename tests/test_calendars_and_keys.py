import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from almanac.functions.cron import parse_cron
from almanac.functions.keys import surrogate_key
from almanac.operators import calendars, keying, quantiles

T = dt.datetime


@pytest.mark.parametrize(
    ("schedule", "at", "slot"),
    [
        ("0 0 1 * *", T(2024, 3, 15), T(2024, 3, 1)),
        ("@yearly", T(2024, 3, 15), T(2024, 1, 1)),
        ("@weekly", T(2024, 3, 16, 23, 59), T(2024, 3, 10)),
        ("30 6 * * 1-5", T(2024, 3, 18, 6, 29), T(2024, 3, 15, 6, 30)),
        ("30 6 * * 1-5", T(2024, 3, 18, 6, 30), T(2024, 3, 18, 6, 30)),
        ("0 12 13 * fri", T(2024, 3, 14), T(2024, 3, 13, 12)),
        ("0 12 13 * fri", T(2024, 3, 16), T(2024, 3, 15, 12)),
        ("0 0 29 feb *", T(2023, 3, 1), T(2020, 2, 29)),
        ("5/20 8-10/2 * * *", T(2024, 3, 1, 9), T(2024, 3, 1, 8, 45)),
        ("0 0 * * 7", T(2024, 3, 16), T(2024, 3, 10)),
        ("0 0 31 2 *", T(2024, 3, 16), None),
    ],
)
def test_last_slot(schedule, at, slot):
    assert parse_cron(schedule).last_slot(at) == slot


@pytest.mark.parametrize("schedule", ["@once a week", "* * * *", "60 * * * *", "0 24 * * *", "0 0 0 * *", "0 0 * 13 *", "0 0 * * 8", "5-1 * * * *", "*/0 * * * *", "x * * * *", ""])
def test_what_is_no_schedule(schedule):
    with pytest.raises(ValueError):
        parse_cron(schedule)


SCHEDULES = ["*/7 3,15 * * *", "0 6 1,15 * mon", "@monthly", "59 23 31 * *", "0 0 * * *", "17 4 29 2 *"]


@pytest.mark.parametrize("schedule", SCHEDULES)
def test_slots_equal_a_walk_over_all_minutes(spark, schedule):
    rng = random.Random(schedule)
    times = [T(2024, 2, 27) + dt.timedelta(seconds=rng.randrange(20 * 86400)) for _ in range(300)] + [T(2024, 3, 1), T(2024, 2, 29, 4, 17)]
    rows = [(t, i) for i, t in enumerate(times)] + [(None, 1), (times[0], None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id int").repartition(5)
    found = {r["slot"]: r["n"] for r in calendars.schedule_slots(df, "ts", schedule, "id").collect()}
    cron = parse_cron(schedule)
    first = cron.last_slot(min(times)) or min(times)
    minutes = (first + dt.timedelta(minutes=i) for i in range(int((max(times) - first).total_seconds() // 60) + 1))
    expected = {m: 0 for m in minutes if cron.last_slot(m) == m}
    for t in times:
        if (slot := cron.last_slot(t)) is not None and slot >= first:
            expected[slot] = expected.get(slot, 0) + 1
    assert found == expected


def test_bounds_once_and_empty_tables(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 5), 1), (T(2024, 1, 3, 7), 2)], "ts timestamp_ntz, id int")
    got = calendars.schedule_slots(df, "ts", "@daily", "id", start=T(2023, 12, 31, 5), end=T(2024, 1, 2, 1)).collect()
    assert sorted(map(tuple, got)) == [(T(2023, 12, 31), 0), (T(2024, 1, 1), 1), (T(2024, 1, 2), 0)]
    assert [tuple(r) for r in calendars.schedule_slots(df, "ts", "@once", "id").collect()] == [(T(2024, 1, 1, 5), 2)]
    assert calendars.schedule_slots(df.limit(0), "ts", "@daily", "id").collect() == []


def resolved(ids, key_range, own):
    out, following = {}, 0
    beyond = []
    for key, i in sorted((own[i] % key_range, i) for i in ids):
        following = max(key, following)
        out[i] = following
        if following >= key_range:
            beyond.append(i)
        following += 1
    free = iter(sorted(set(range(key_range)) - set(out.values())))
    for i in beyond:
        out[i] = next(free)
    return out


@pytest.mark.parametrize(("n", "key_range"), [(300, 310), (300, 300), (2000, 100_000), (1, 1), (0, 5)])
def test_keys_are_free_of_collisions(spark, n, key_range):
    ids = random.Random(n).sample(range(10**9), n)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    own = {r["id"]: r["k"] for r in df.select("id", surrogate_key("id").alias("k")).collect()}
    expected = resolved(ids, key_range, own)
    for parts in (1, 7):
        got = {r["id"]: r["custom_id"] for r in keying.unique_surrogate_keys(df.repartition(parts), "id", key_range=key_range).collect()}
        assert got == expected
    assert sorted(expected.values()) == sorted(set(expected.values())) and all(0 <= k < key_range for k in expected.values())


def test_keys_refuse_nulls_and_too_many_rows(spark):
    with pytest.raises(Exception, match="do not fit"):
        keying.unique_surrogate_keys(spark.range(5), "id", key_range=4)
    with pytest.raises(Exception, match="NULL in id"):
        keying.unique_surrogate_keys(spark.createDataFrame([(None,)], "id long"), "id").collect()


VALUES = {
    "even": list(range(1000)),
    "one value": [7] * 50,
    "skewed": [5] * 900 + list(range(100)),
    "large": [-(2**63), 2**63 - 1, 0, 1, 2, 2**62, -(2**62)],
    "few": [3, 1],
    "exponents": [float(f"1e{k}") for k in range(-300, 300, 7)] + [-0.0, 0.0, -1e308, 1.7e308],
    "missing": [None, 1.5, float("nan"), 2.5, None],
}


@pytest.mark.parametrize("name", VALUES)
@pytest.mark.parametrize("parts", [1, 7])
def test_bounds_are_the_values_at_their_places(spark, name, parts):
    values = VALUES[name]
    kind = "double" if any(isinstance(v, float) for v in values) else "bigint"
    df = spark.createDataFrame([(g, v) for g in (0, 3) for v in values], f"group int, x {kind}").repartition(5)
    known = sorted(v for v in values if v is not None and v == v)
    expected = [known[-(-j * len(known) // parts) - 1] for j in range(1, parts)]
    assert quantiles.equi_depth_bounds(df, parts) == ({0: expected, 3: expected} if parts > 1 else {})


@pytest.mark.parametrize("name", ["even", "one value", "skewed", "large", "few"])
def test_each_row_is_in_one_range_and_one_predicate(spark, name):
    values = [*VALUES[name], None, None]
    df = spark.createDataFrame([(v,) for v in values], "k bigint")
    ranges = quantiles.key_ranges(df, "k", 8).collect()
    assert sum(r["n"] for r in ranges) == len(values)
    assert {r["range"]: r["n"] for r in ranges}[-1] == 2
    predicates = quantiles.range_predicates("k", quantiles.range_bounds(df, "k", 8))
    assert sorted(df.where(F.expr(p)).count() for p in predicates) == sorted(r["n"] for r in ranges)
    most = max(Counter(v for v in values if v is not None).values())
    assert max(r["n"] for r in ranges if r["range"] >= 0) <= len(values) / 8 + most


def test_ranges_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert sorted((r["range"], r["n"]) for r in quantiles.key_ranges(empty, "k", 4).collect()) == [(-1, 0), (0, 0)]

"""Operators against brute force in plain Python on random small inputs."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallycast import schemas
from tallycast.operators import align, dedup, skew, summarize

START = datetime(2024, 1, 1)
few_runs = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

city = st.sampled_from(["msc", "spb"])
run = st.sampled_from(["r1", "r2", "r3"])
minute = st.integers(0, 90)
word = st.sampled_from(["snow", "rain", "fog", None])

readings = st.lists(st.tuples(city, run, minute, st.one_of(st.none(), st.integers(-9, 9)), word, word), max_size=25)
events = st.lists(st.tuples(st.integers(0, 12), city, run, minute), max_size=40)


def weather_frame(spark, rows):
    values = [(None, 740, t, w, d, 1.0, START + timedelta(minutes=m), c, r) for c, r, m, t, w, d in rows]
    return spark.createDataFrame(values, schemas.CLEAN_WEATHER)


def event_frame(spark, rows):
    values = [(str(i), None, None, n, 0, START + timedelta(minutes=m), c, r) for n, (i, c, r, m) in enumerate(rows)]
    return spark.createDataFrame(values, schemas.CLEAN_EVENT)


def mean(values):
    known = [v for v in values if v is not None]
    return round(sum(known) / len(known), 9) if known else None


def mode(values):
    counts = Counter(v for v in values if v is not None)
    return min(counts, key=lambda v: (-counts[v], v)) if counts else None


def bucket_groups(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[int((START - datetime(1970, 1, 1)).total_seconds() + row[2] * 60) // 900, row[0]].append(row)
    return groups


@few_runs
@given(rows=readings)
def test_bucket_weather(spark, rows):
    expected = {k: (mean([r[3] for r in g]), mode([r[4] for r in g]), mode([r[5] for r in g])) for k, g in bucket_groups(rows).items()}
    found = align.bucket_weather(weather_frame(spark, rows)).collect()
    shown = {(r["time_interval"], r["city_name"]): (None if r["temperature"] is None else round(r["temperature"], 9), r["weather_type"], r["wind_direction"]) for r in found}
    assert shown == expected


@few_runs
@given(seen=events, rows=readings)
def test_bucket_join(spark, seen, rows):
    groups = bucket_groups(rows)
    base = int((START - datetime(1970, 1, 1)).total_seconds())
    expected = sorted(
        (n, str(mean([r[3] for r in groups[key]])))
        for n, (_, c, _, m) in enumerate(seen)
        if (key := ((base + m * 60) // 900, c)) in groups
    )
    joined = align.bucket_join(event_frame(spark, seen), weather_frame(spark, rows))
    assert sorted((r["dislikes"], str(None if r["temperature"] is None else round(r["temperature"], 9))) for r in joined.collect()) == expected


@few_runs
@given(seen=events, rows=readings)
def test_count_per_run(spark, seen, rows):
    unique = {}
    for c, r, m, t, w, d in sorted(rows, key=lambda x: x[2]):
        unique.setdefault((c, r), (c, r, m, t, w, d))
    first = list(unique.values())
    bound = min((r[2] for r in first), default=None)
    expected = sorted(
        (c, sum(1 for e in seen if e[1] == c and e[2] == r and e[3] * 60 + 300 > bound * 60)) for c, r, *_ in first
    )
    counted = align.count_per_run(weather_frame(spark, first), event_frame(spark, seen))
    assert sorted((r["city_name"], r["crashes"]) for r in counted.collect()) == expected


@few_runs
@given(seen=events, known=st.sets(st.integers(0, 12), max_size=5))
def test_first_sightings(spark, seen, known):
    expected = {}
    for n, (i, *_rest) in sorted(enumerate(seen), key=lambda x: (x[1][3], x[0])):
        if i not in known:
            expected.setdefault(str(i), n)
    history = spark.createDataFrame([(str(i),) for i in known], "id string")
    fresh = dedup.first_sightings(event_frame(spark, seen), history, ["id"], ["date", "dislikes"])
    assert {r["id"]: r["dislikes"] for r in fresh.collect()} == expected


@few_runs
@given(keys=st.sets(st.integers(0, 9)), rows=st.lists(st.integers(0, 9), max_size=60))
def test_zero_filled_count(spark, keys, rows):
    all_keys = spark.createDataFrame([(k,) for k in keys], "k int")
    found = summarize.zero_filled_count(all_keys, spark.createDataFrame([(r,) for r in rows], "k int"), ["k"], "n")
    assert {r["k"]: r["n"] for r in found.collect()} == {k: rows.count(k) for k in keys}

import json
import random
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.operators import dedup
from tallycast.sources import landing, pages, payloads, tables


def write_lines(path, *records):
    path.mkdir(exist_ok=True)
    name = f"{len(list(path.iterdir())):03d}.json"
    (path / name).write_text("\n".join(json.dumps(r) for r in records))


def envelope(kind, city, run, **data):
    return {"scheduler_id": run, "crawler_type": kind, "data": {"city_name": city, **data}}


def test_landing_keeps_nulls_booleans_and_numbers(spark, tmp_path):
    event = {"id": "e1", "type": "crash", "timestamp": 1671955200, "feedbacks": None, "confirmed": True}
    write_lines(tmp_path / "in", envelope(schemas.TRAFFIC_KIND, "spb", "r1", events=[event]))
    row = landing.traffic_records(landing.read_landing(spark, str(tmp_path / "in"))).first()
    assert (row["id"], row["timestamp"], row["feedbacks"], row["city_name"], row["scheduler_id"]) == (
        "e1", "1671955200", None, "spb", "r1",
    )


def test_landing_routes_by_kind_and_ignores_others(spark, tmp_path):
    write_lines(
        tmp_path / "in",
        envelope(schemas.TRAFFIC_KIND, "spb", "r1", events=[{"id": "a"}, {"id": "b"}]),
        envelope(schemas.WEATHER_KIND, "spb", "r1", temperature="1"),
        envelope("air_quality", "spb", "r1"),
    )
    both = landing.read_landing(spark, str(tmp_path / "in"))
    assert both.count() == 3
    assert sorted(r["id"] for r in landing.traffic_records(both).collect()) == ["a", "b"]
    assert [r["temperature"] for r in landing.weather_records(both).collect()] == ["1"]
    assert landing.read_landing(spark, str(tmp_path / "in"), schemas.WEATHER_KIND).count() == 1


def test_collecting_a_run_again_replaces_it(spark, tmp_path):
    for temperature in ("1", "2"):
        write_lines(tmp_path / "in", envelope(schemas.WEATHER_KIND, "spb", "r1", temperature=temperature))
    write_lines(tmp_path / "in", envelope(schemas.WEATHER_KIND, "msc", "r1", temperature="9"))
    newest = landing.latest_per_key(landing.read_landing(spark, str(tmp_path / "in"), schemas.WEATHER_KIND))
    found = {r["key"]: r["data"]["temperature"] for r in newest.collect()}
    assert found == {"weather_forecast:spb:r1": "2", "weather_forecast:msc:r1": "9"}


def test_records_match_by_name_not_position(spark):
    frame = landing.records_to_frame(spark, [{"a": "1", "b": "2"}, {"b": "4", "a": "3"}, {"b": "5"}], schemas._struct(a=schemas._text, b=schemas._text))
    assert [tuple(r) for r in frame.collect()] == [("1", "2"), ("3", "4"), (None, "5")]


def test_typed_events(spark):
    body = json.dumps([{"id": "1", "type": "crash"}, {"id": "2", "type": "jam"}, {"id": "3", "type": "crash", "extra": [1]}])
    frame = spark.createDataFrame([(body, "spb"), ("[]", "msc"), ("not json", "msc"), (None, "msc")], "body string, city_name string")
    found = payloads.explode_typed_events(frame)
    assert sorted((r["id"], r["city_name"]) for r in found.collect()) == [("1", "spb"), ("3", "spb")]


PAGE = """<html><head><title> A &amp;
 B </title><script>var s = "<div class='temp'>no</div>";</script></head>
<body><div class="card temp">first <b>bold</b><br>line<script>hidden()</script></div><div class="temp">second</div>
<div id="sky"><p class="kind">snow</p></div><p class="kind">outside</p><div class="empty"></div></body></html>"""


@pytest.mark.parametrize(
    "selector, expected",
    [
        ("title", "A & B"),
        (".temp", "first bold line"),
        ("div.temp.card", "first bold line"),
        ("#sky .kind", "snow"),
        ("div p.kind", "snow"),
        ("body + p", ValueError),
        ("span", "none"),
        ("div.absent", "none"),
        ("div.empty", ""),
        ("p#sky", "none"),
        ("div.card#none", "none"),
        ("div#sky", "snow"),
        ("a[href]", ValueError),
        ("", ValueError),
    ],
)
def test_page_fields(spark, selector, expected):
    frame = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    if expected is ValueError:
        with pytest.raises(ValueError):
            pages.extract_page_fields(frame, {"field": (selector, "none")})
        return
    row = pages.extract_page_fields(frame, {"field": (selector, "none"), "last": ("p.kind", "none")}).first()
    assert tuple(row) == (1, expected, "snow")


def test_page_without_text_gives_defaults(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "<div class=te&#109;p>x")], "page_id int, html string")
    found = pages.extract_page_fields(frame, {"t": (".temp", "none")}).collect()
    assert [r["t"] for r in found] == ["none", "none", "x"]


@pytest.mark.parametrize(
    "html, selector, expected",
    [
        ("<b class=a>x</b><![foo[bar]]><i class=b>y</i>", ".a", "x"),
        ("<ul><li class=x>a<li>b</ul>", ".x", "a"),
        ("<ul><li class=x>a<ul><li>b</ul>c<li>d</ul>", ".x", "abc"),
        ("<table><tr><td class=v>1<td>2<tr><td>3</table>", ".v", "1"),
        ("<p class=a>first<p>second", ".a", "first"),
        ("<p class=a>first<div>second</div>", ".a", "first"),
        ("<div class=a><p>one<p>two</div>three", ".a", "onetwo"),
    ],
)
def test_pages_never_fail_and_end_tags_are_implied(spark, html, selector, expected):
    frame = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert pages.extract_page_fields(frame, {"t": (selector, "none")}).first()["t"] == expected


def test_unclosed_elements_take_linear_time():
    def took(n):
        begun = time.process_time()
        pages._read_fields("<div class=k>" + "<b>x " * n, {"f": (pages._steps(".k"), "")})
        return time.process_time() - begun

    took(100)
    assert took(80_000) < 8 * took(20_000) + 0.1


COUNT = ("spb", 3, datetime(2024, 1, 1, 0, 0, 0, 123456), 0.5, 740, -3, "snow, wet", "N", 3.5)


def test_csv_appends_and_reads_back(spark, tmp_path):
    path = str(tmp_path / "counts")
    frame = spark.createDataFrame([COUNT], schemas.RUN_COUNT)
    for _ in range(2):
        tables.append_csv(frame, path)
    assert [tuple(r) for r in tables.read_csv(spark, path, schemas.RUN_COUNT).collect()] == [COUNT] * 2
    assert {t for _, t in tables.read_csv(spark, path).dtypes} == {"string"}
    assert dict(tables.read_csv(spark, path, infer=True).dtypes)["crashes"] == "int"
    tables.append_csv(frame, path, mode="overwrite")
    assert tables.read_csv(spark, path).count() == 1


def test_predictions_append_and_require_every_field(spark, tmp_path):
    path = str(tmp_path / "predictions")
    day = datetime(2024, 1, 1, 23, 30)
    good = spark.createDataFrame([("spb", 2, day, datetime(2024, 1, 2, 0, 30))], schemas.PREDICTION)
    for _ in range(2):
        tables.append_predictions(good, path)
    stored = tables.read_predictions(spark, path)
    assert stored.count() == 2 and str(stored.first()["end_day"]) == "2024-01-02"
    with pytest.raises(Exception, match="prediction without city"):
        tables.append_predictions(good.withColumn("city", F.lit(None).cast("string")), path)
    assert tables.read_predictions(spark, path).count() == 2


def days(spark, *rows):
    return spark.createDataFrame(rows, "id string, day string").withColumn("day", F.col("day").cast("date"))


def test_seen_ids_of_a_batch_run_twice_and_of_other_streams(spark, tmp_path):
    seen = tables.SeenIds(spark, str(tmp_path / "seen"))
    batch = days(spark, ("x", "2024-01-01"), ("y", None))
    assert seen.known(batch, "s", 0).count() == 0
    for _ in range(2):
        seen.remember(batch, "s", 0)
    asked = days(spark, ("x", "2024-01-01"), ("y", None), ("z", "2024-01-01"))
    shown = lambda *args: sorted(r["id"] for r in seen.known(asked, *args).collect())
    assert shown("s", 0) == [] and shown("s", 1) == ["x", "y"] and shown("new", 0) == ["x", "y"]
    seen.remember(days(spark, ("z", "2024-01-01")), "new", 0)
    assert shown("s", 1) == ["x", "y", "z"]
    again = tables.SeenIds(spark, str(tmp_path / "seen"))
    assert again.ids().count() == 3


def rows_scanned(df):
    """Rows that the scan of the executed plan gave out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan()
    while leaves.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        leaves = leaves.executedPlan()
    leaves = leaves.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_the_same_id_stays_out_whatever_day_it_carries(spark, tmp_path):
    seen = tables.SeenIds(spark, str(tmp_path / "seen"))
    seen.remember(days(spark, ("x", "2024-01-01"), ("y", None)), "s", 0)
    copies = days(spark, ("x", "2024-03-01"), ("x", None), ("y", "2024-01-02"), ("z", "2024-01-01"), (None, "2024-01-01"))
    for limit in (tables._PUSHED, 0):  # ids handed to the scan, or joined only
        tables._PUSHED, before = limit, tables._PUSHED
        try:
            fresh = dedup.drop_seen(copies, seen.known(copies, "t", 0), ["id"]).collect()
        finally:
            tables._PUSHED = before
        assert sorted(r["id"] or "" for r in fresh) == ["", "z"]


def test_files_without_the_ids_of_a_batch_are_skipped(spark, tmp_path):
    """Ids of all parts interleave, so no part is told apart by its least and greatest id."""
    seen = tables.SeenIds(spark, str(tmp_path / "seen"), buckets=4)
    for batch in range(5):
        ids = spark.range(batch, 5000, 5).select(F.format_string("%05d", "id").alias("id"), F.lit("2024-01-01").alias("day"))
        seen.remember(ids, "s", batch)
    one = days(spark, ("00017", "2030-01-01"))
    known = seen.known(one, "t", 0)
    assert rows_scanned(known) < 400  # one file of twenty, of some 250 ids
    assert [r["id"] for r in known.collect()] == ["00017"]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows_scanned(seen.known(days(spark, ("99999x", None)), "t", 0)) == 0


def test_the_number_of_buckets_is_fixed_by_the_first_part(spark, tmp_path):
    tables.SeenIds(spark, str(tmp_path / "seen"), buckets=3).remember(days(spark, *[(f"x{i}", None) for i in range(20)]), "s", 0)
    other = tables.SeenIds(spark, str(tmp_path / "seen"), buckets=50)
    batch = days(spark, *[(f"x{i}", None) for i in range(20)])
    assert other.known(batch, "t", 0).count() == 20


def test_compacting_and_forgetting(spark, tmp_path):
    seen = tables.SeenIds(spark, str(tmp_path / "seen"))
    for batch in range(4):
        seen.remember(days(spark, ("x", "2024-01-01"), (f"y{batch}", "2024-01-20"), ("n", None)), "s", batch)
    seen.remember(days(spark, ("z", "2024-02-01")), "other", 0)
    seen.compact("s", 3)
    found = sorted((r["id"], r["stream"], r["level"], r["batch"]) for r in seen.ids().collect())
    merged = [(i, "s", 1, 2) for i in ("n", "x", "y0", "y1", "y2")]
    assert found == sorted([*merged, ("n", "s", 0, 3), ("x", "s", 0, 3), ("y3", "s", 0, 3), ("z", "other", 0, 0)])
    batch = days(spark, ("x", None), ("y1", None), ("y3", None))
    assert sorted(r["id"] for r in seen.known(batch, "s", 3).collect()) == ["x", "y1"]  # batch 3 run again
    seen.forget(date(2024, 1, 15))
    seen.forget(date(2024, 1, 10))  # does not bring back
    assert seen.horizon() == date(2024, 1, 15)
    assert {r["id"] for r in seen.ids().collect()} == {"n", "y0", "y1", "y2", "y3", "z"}
    seen.compact("s", 4)
    stored = spark.read.parquet(str(tmp_path / "seen" / "ids"))
    assert {r["id"] for r in stored.filter("stream = 's'").collect()} == {"n", "y0", "y1", "y2", "y3"}


def test_a_batch_is_evaluated_once(spark, tmp_path):
    path = str(tmp_path / "batch")
    spark.createDataFrame([("x", 1), ("x", 0), ("z", 1)], "id string, n int").write.parquet(path)
    history = spark.createDataFrame([("x",)], "id string")
    fresh = dedup.first_sightings(spark.read.parquet(path), history, ["id"], ["n"])
    assert [r["id"] for r in fresh.collect()] == ["z"]
    assert "FileScan" not in fresh._jdf.queryExecution().executedPlan().toString()


_NESTED = (
    "<div><span class=o><em><span><b>in</b></span></em></span><b>last</b>"
    "<u id=x><i>no</i><i class='j k'>named</i></u></div>"
)


@pytest.mark.parametrize(
    "selector, expected",
    [
        ("div > span b", "in"),  # the outer span is the child, not the nearest one
        ("div > span > b", "none"),
        ("em>span>b", "in"),
        ("div > b", "last"),
        ("div b", "in"),
        ("#x > i.k", "named"),
        ("span > #x", "none"),
    ],
)
def test_child_steps(selector, expected):
    assert pages._read_fields(_NESTED, {"f": (pages._steps(selector), "none")}) == [expected]


@pytest.mark.parametrize("selector", ["> b", "a >", "a > > b", ""])
def test_selectors_with_a_step_missing_are_refused(selector):
    with pytest.raises(ValueError):
        pages._steps(selector)


def test_selectors_against_a_search_over_all_ancestors():
    rng = random.Random(5)

    def matches(path, steps):
        """``path``: tags from the root to the element; ``steps``: (tag, is child) pairs."""
        if path[-1] != steps[-1][0]:
            return False
        if len(steps) == 1:
            return True
        if steps[-1][1]:
            return len(path) > 1 and matches(path[:-1], steps[:-1])
        return any(matches(path[:k], steps[:-1]) for k in range(1, len(path)))

    for _ in range(300):
        html, path, seen = "", [], []
        for number in range(rng.randrange(1, 25)):
            while path and rng.random() < 0.3:
                html += f"</{path.pop()}>"
            path.append(rng.choice(["b", "i", "u"]))
            html += f"<{path[-1]}><s>{number}.</s>"
            seen.append((number, list(path)))
        steps = [(rng.choice("biu"), k > 0 and rng.random() < 0.5) for k in range(rng.randrange(1, 5))]
        selector = " ".join(("> " if child else "") + tag for tag, child in steps)
        first = next((str(number) for number, at in seen if matches(at, steps)), "none")
        found = pages._read_fields(html, {"f": (pages._steps(selector), "none")})[0]
        assert found.split(".")[0] == first, (html, selector)

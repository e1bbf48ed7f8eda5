"""The store, one-pass ingestion, broken and partial pages, calls in flight, and counts from the jobs themselves."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from plenaria.operators import fold, sinks
from plenaria.plans import ingest, pending
from plenaria.sources import html, page_source, pages

from .test_engine import PAGE

MEMBERS = "name string, url string, role string, house string, parliament string, constituency string"


def page_rows(spark, n=3, bad=()):
    return spark.createDataFrame([(f"/s/{k}", "<![foo[x]]>" if k in bad else PAGE.replace("Bad", f"Bad {k}")) for k in range(n)], "url string, html string")


@pytest.fixture
def store(spark, tmp_path):
    out = sinks.Store(spark, str(tmp_path / "store"), 8)
    out.migrate()
    return out


def files(store, name):
    return {f.split("/_part=")[1] for f in store.read(name).inputFiles()}


def test_ingestion_keeps_what_it_does_not_own(spark, store):
    sittings = pages.current_sittings(page_rows(spark))
    assert ingest.ingest_into(store, sittings) == {"ingested": 3, "skipped": 0, "failed": 0}
    members = spark.createDataFrame([("Achieng", "/m/1/", "Whip", "Senate", "13th-parliament", None)], MEMBERS)
    assert ingest.link_into(store, members) == {"speakers": 1, "bills": 1}
    store.write("bills", store.read("bills").withColumn("summary", F.lit("told")))
    store.write("members", fold.upsert(None, members, "members", ["url"]))
    profile = spark.createDataFrame([("/m/1/", "Born", ["Chair"], 7)], "page_url string, biography string, positions array<string>, speeches_total int")
    for c in set(fold.DETAILS) - set(profile.columns):
        profile = profile.withColumn(c, F.lit(None))
    store.write("members", ingest.enrich_members(store.read("members"), profile))
    for name, rows in ingest.tables(sittings).items():
        store.upsert(name, rows, ingest.ORDER)
    store.upsert("members", members.withColumn("name", F.lit("A. Achieng")), ["url"])
    assert {r.member_url for r in store.read("speakers").collect()} == {"/m/1/", None}
    assert {(r.summary, r.sponsor_url) for r in store.read("bills").collect()} == {("told", "/m/1/")}
    m = store.read("members").first()
    assert (m.name, m.biography, m.positions, m.speeches_total, m.role) == ("A. Achieng", "Born", ["Chair"], 7, "Whip")
    assert {n: [f.name for f in store.read(n).schema] for n in fold.SCHEMAS} == {n: [c.strip().split(" ")[0] for c in s.replace(fold.SECTIONS, "x").split(",")] for n, s in fold.SCHEMAS.items()}


def test_second_run_and_broken_run(spark, store):
    first, all_ = (pages.current_sittings(page_rows(spark, n)) for n in (1, 3))
    ingest.ingest_into(store, first)
    broken = ingest.tables(all_)
    store.upsert("sitting_speakers", broken["sitting_speakers"].filter("sitting_url <> '/s/0'"), ingest.ORDER)  # and then it died
    told = Observation()
    assert ingest.ingest_into(store, pages.current_sittings(page_rows(spark, 4, bad=(3,)), told), told) == {"ingested": 2, "skipped": 1, "failed": 1}
    assert {r.speech_count for r in store.read("sitting_speakers").collect()} == {1}
    assert store.read("sittings").count() == 3


def test_a_batch_rewrites_only_its_partitions(spark, store):
    rows = spark.createDataFrame([(f"n{k}", None, k) for k in range(200)], "name string, url string, o int")
    assert store.upsert("speakers", rows, ["o"]) == list(range(8))
    before = files(store, "speakers")
    assert len(store.upsert("speakers", rows.limit(1), ["o"])) == 1
    assert len(before - files(store, "speakers")) == 1 and store.read("speakers").count() == 200
    with pytest.raises(ValueError, match="nonsense"):
        store.upsert("speakers", rows.withColumn("nonsense", F.lit(1)), ["o"])
    again = sinks.Store(spark, store.path, 99)
    again.migrate()
    assert again.parts == 8 and again.read("speakers").count() == 200


def test_each_page_is_parsed_once(spark, store, monkeypatch):
    parsed = spark.sparkContext.accumulator(0)
    plain = html.current_sitting

    def counted(page):
        parsed.add(1)
        return plain(page)

    monkeypatch.setattr(html, "current_sitting", counted)
    ingest.ingest_into(store, pages.current_sittings(page_rows(spark, 5)))
    assert parsed.value == 5 and store.read("topic_speakers").count() > 0


def test_pages_that_cannot_be_parsed(spark):
    rows = pages.parsed(page_rows(spark, 3, bad=(1,)), html.current_sitting, pages.SITTING).select("page_url", "house", "error").orderBy("page_url").collect()
    assert [(r.house, (r.error or "")[:14]) for r in rows] == [("Senate", ""), (None, "AssertionError"), ("Senate", "")]
    with pytest.raises(pages.PageOutOfRange, match="no pager"):
        pages.checked(page_rows(spark, 1), 1)
    part = "<nav class='bills-pagination'><li class='active_number_box'><span>2</span></li></nav>"
    with pytest.raises(pages.PageOutOfRange):
        pages.bills(spark.createDataFrame([("/m/?bills_page=3", part)], "url string, html string"), 3)
    assert pages.bills(page_rows(spark, 1), 3).count() == 0  # a part of a profile may have no pager


def test_refused_parts_are_counted(spark):
    def bill(name, page, last):
        return f"<h1 class='page-heading'>A</h1><div class='bill-item'><h3 class='bill-name'>{name}</h3></div><nav class='bills-pagination'><li class='active_number_box'><span>{page}</span></li><a href='?bills_page={last}'>x</a></nav>"

    first = spark.createDataFrame([("/m/a/", bill("one", 1, 3)), ("/m/b/", bill("solo", 1, 1))], "url string, html string")
    more = spark.createDataFrame([("/m/a/?bills_page=3", bill("three", 3, 3)), ("/m/a/?bills_page=2", bill("two", 2, 3)), ("/m/a/?bills_page=4", bill("beyond", 4, 4)), ("/m/b/?bills_page=2", bill("none", 2, 2))], "url string, html string")
    assert {r.page_url: [b.name for b in r.bills] for r in pages.full_profiles(first, more).collect()} == {"/m/a/": ["one", "two", "three"], "/m/b/": ["solo"]}
    told = Observation()
    wrong = more.limit(1).withColumn("html", F.lit(bill("other", 2, 3)))
    assert {r.page_url: [b.name for b in r.bills] for r in pages.full_profiles(first, wrong, told).collect()} == {"/m/a/": ["one"], "/m/b/": ["solo"]}
    assert sinks.counted(told) == {"refused": 1}


class Slow:
    """Says how many calls were in flight at most; fails on some."""

    lock, now, most = threading.Lock(), 0, 0

    def summarize(self, prompt):
        with Slow.lock:
            Slow.now += 1
            Slow.most = max(Slow.most, Slow.now)
        time.sleep(0.03)
        with Slow.lock:
            Slow.now -= 1
        if prompt.endswith("7"):
            raise ValueError("seven")
        return f"{prompt} of {Slow.most}"


@pytest.mark.parametrize("at_once", [1, 3])
def test_calls_in_flight(spark, at_once):
    told = Observation()
    rows = spark.range(30, numPartitions=1).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    out = pending.answer(rows, "prompt", Slow, "m", at_once, told).collect()
    assert [r.id for r in out] == list(range(30)) and all(r.summary is None or r.summary.startswith(f"p{r.id} of ") for r in out)
    assert [r.id for r in out if r.summary is None] == [7, 17, 27] and all((r.summary is None) == (r.summary_model is None) for r in out)
    assert max(int(r.summary.split(" of ")[1]) for r in out if r.summary) == at_once
    assert told.get["answered"] == 27 and told.get["failed"] == 3
    assert (pending.calls("sittings"), pending.calls("bills"), pending.calls("sittings", 1)) == (2, 4, 1)
    pushed = []
    metrics = sinks.TextMetrics(pushed.append)
    sinks.report(told, metrics, "enrich", target="bills")
    assert 'enrich_failed{target="bills"} 3' in metrics.text()


def test_page_source(spark, tmp_path):
    def page(n, says=None):
        return f"<li class='active active_number_box'><span>{says or n}</span></li><a class='page_label' href='?page=4'>4</a><div class='split-docs'><div class='hansard-document'><h3><a href='/s/{n}'>Monday, {n}th June 2031 - Morning Sitting</a></h3></div></div>"

    spark.createDataFrame([(n, page(n, 9 if n == 2 else None)) for n in (1, 2, 4)], "page int, html string").transform(lambda df: page_source.write_pages(df, str(tmp_path / "list")) or df)
    failed = str(tmp_path / "failed")
    rows = page_source.all_pages(spark, str(tmp_path / "list"), failures=failed)
    assert rows.rdd.getNumPartitions() == 4
    assert sorted((r.page, r.date, r.session_type) for r in rows.collect()) == [(n, dt.date(2031, 6, n), "Morning Sitting") for n in (1, 4)]
    assert {r.page for r in page_source.failures(spark, failed).collect()} == {2, 3}
    one = page_source.all_pages(spark, str(tmp_path / "list")).filter("page = 4 and house = 'National Assembly'")
    assert one.count() == 1 and one.rdd.getNumPartitions() == 1
    assert "PushedFilters: [EqualTo(page,4), EqualTo(house,National Assembly)]" in one._jdf.queryExecution().explainString(one._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    spark.createDataFrame([(1, "<p>no pager</p>")], "page int, html string").transform(lambda df: page_source.write_pages(df, str(tmp_path / "bare")) or df)
    with pytest.raises(Exception, match="no pager"):
        page_source.all_pages(spark, str(tmp_path / "bare")).collect()


def test_frame(spark):
    rows = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "no"}',), ("[{}, {\"a\": 2}, 7]",), ("{",), (None,), ("[]",)], "j string")
    told = Observation()
    assert [tuple(r) for r in sinks.frame(rows, "j", "a int, b string", told).collect()] == [(1, "x"), (None, None), (2, None)]
    assert told.get == {"rejected": 4, "decoded": 3}
    assert sorted(sinks.frame(rows.filter("j like '%1%' or j like '%2%'"), "j").columns) == ["a", "b"]


def test_jdbc_store_merges_by_key(spark):
    """In the bundled database: policies, null keys, and batches that come again."""
    url = "jdbc:derby:memory:plenaria;create=true"
    try:
        spark._jvm.java.sql.DriverManager.getConnection(url).close()
    except Exception:  # noqa: BLE001
        pytest.skip("no Derby")
    store = sinks.JdbcStore(spark, url)
    store.migrate("sitting_speakers", "bills", "speakers")
    store.migrate("bills")
    rows = lambda *r: spark.createDataFrame(r, "sitting_url string, speaker_name string, speaker_url string, speech_count long, at int")
    assert store.upsert("sitting_speakers", rows(("/s", "A", None, 2, 1), ("/s", "A", None, 1, 2), ("/s", "B", "/b", 1, 1)), ["at"], "one")
    again = rows(("/s", "A", None, 4, 1), ("/t", "A", None, 1, 1))
    assert [store.upsert("sitting_speakers", again, ["at"], x) for x in ("two", "two")] == [True, False]
    assert sorted((r.sitting_url, r.speaker_name, r.speech_count) for r in store.read("sitting_speakers").collect()) == [("/s", "A", 7), ("/s", "B", 1), ("/t", "A", 1)]
    bill = lambda **x: spark.createDataFrame([("Roads Bill", x.get("number"), x.get("summary"), 1)], "name string, bill_number string, summary string, at int")
    for k, b in enumerate((bill(number="No. 1"), bill(summary="told"), bill(number=None, summary="later"), bill(number="No. 2"))):
        store.upsert("bills", b, ["at"], f"b{k}")
    assert [(r.name, r.bill_number, r.summary) for r in store.read("bills").collect()] == [("Roads Bill", "No. 2", "told")]
    store.upsert("speakers", spark.createDataFrame([("A", None, 1), ("A", None, 2)], "name string, url string, at int"), ["at"], "s")
    with pytest.raises(Exception):  # noqa: B017  a merge that fails leaves no mark of its batch
        store._run("INSERT INTO batches VALUES ('speakers/x')", "MERGE INTO nowhere")
    assert store.read("speakers").count() == 1 and store.read("batches").filter("name = 'speakers/x'").isEmpty()

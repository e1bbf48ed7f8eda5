import datetime as dt

import pytest
from pyspark.sql import functions as F

from plenaria.functions import text, trigram
from plenaria.operators import extract, fold, listing, sinks
from plenaria.plans import ingest, pending
from plenaria.sources import html, pages
from plenaria.streaming import ingest as stream


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    "title, name",
    [("THE FOREST ROADS (REPEAL) BILL", "Forest Roads (Repeal) Bill"), ("THIRD READING OF THE TEACHERS' HOUSING BILL", "Teachers Housing Bill"), ("PRAYERS", None), ("4. A BILL", None), (None, None)],
)
def test_bill_name(spark, title, name):
    assert one(spark, text.bill_name(F.col("t")), t=title) == name


def test_scalars(spark):
    assert one(spark, text.title_case(F.col("t")), t="NORTH/SOUTH-LINE  (RAIL)") == "North/south-line (Rail)"
    assert one(spark, text.stage_from_text(F.col("t")), t="I ask that it be read a Third Time now") == "Third Reading"
    assert one(spark, text.bill_number(F.col("t")), t="of the Senate  Bill No.7 of 2031") == "Senate Bill No.7 of 2031"
    at = one(spark, text.title_date(F.col("t")), t="Report of Monday, 9th June 2031 - Morning Sitting")
    assert (at.date, at.session_type) == (dt.date(2031, 6, 9), "Morning Sitting")
    assert [one(spark, text.time_12h(F.col("t")), t=t) for t in ("3:15 PM", "12:05 AM", "12:20 PM", "14:10 PM")] == ["15:15:00", "00:05:00", "12:20:00", None]
    assert one(spark, text.clean_name(F.col("t")), t="Margaret Oscar") == "MargaOar"
    assert one(spark, trigram.word_similarity(F.col("a"), F.col("b")), a="word", b="two words") == pytest.approx(0.8)
    assert one(spark, trigram.similarity(F.col("a"), F.col("b")), a="word", b="two words") == pytest.approx(4 / 11)
    entry = lambda url, shown="": one(spark, text.archive_entry(F.col("u"), F.col("s")), u=url, s=shown)
    assert entry("/a/b/senate/1999-02-30") is None and entry("/b/senate/1999-02-03") is None
    assert entry("/a/b/senate/1999-02-03-25-00-00") is None and entry("/a/b/senate/1999-02-03", "9:00 to 24:10") is None
    assert entry("/a/b/senate/1999-02-03-09-30-00/", "to 9:45").start_time == "09:30:00"


PAGE = """<span class=house>The Senate</span><li class="breadcrumb-item current">Thursday, 12th February, 2026 - Afternoon Sitting</li>
<span class="time">Time: 2:30 PM</span><div class="doc-summary">Hansard Summary all well Sentimental Analysis calm</div>
<article class="hansard-document"><p>Prayers</p><h2 class="major-section-header">BILLS</h2><h2 class="header-section">THE WATER SUPPLY BILL</h2>
<div class="contributor-name"><a href="/m/1/">Hon. Achieng</a></div><div class="speech-content"><p>I beg to move that it be read a First Time</p><p>twice</p></div>
<div class="scene-description">(Applause)</div><div class="contributor-name">Hon. Silent</div>
<h2 class="major-section-header">STATEMENTS</h2><h2 class="header-section">STATE OF ROADS</h2><div class="contributor-name">Hon. Brief</div><div class="speech-content"><p>Bad</p></div><ol class="content-list"><li>A</li><li>B</li></ol></article>"""


def test_sitting(spark):
    df = pages.current_sittings(spark.createDataFrame([("/s/x", PAGE), ("/s/empty", " ")], "url string, html string"))
    s = df.first()
    assert (s.house, s.date, s.start_time, s.summary, s.sentiment) == ("Senate", dt.date(2026, 2, 12), "14:30:00", "all well", "calm")
    assert [x.section_type for x in s.sections] == ["", "BILLS", "STATEMENTS"]
    c = s.sections[1].subsections[0].contributions
    assert [(x.speaker_name, x.procedural_notes) for x in c] == [("Hon. Achieng", ["(Applause)"]), ("Hon. Silent", [])]
    assert s.sections[2].subsections[0].contributions[0].content == "Bad A B"
    bill = extract.bills(extract.contributions(df)).first()
    assert (bill.name, bill.stage, bill.sponsor, bill.speech_count) == ("Water Supply Bill", "First Reading", "Hon. Achieng", 2)
    tables = ingest.ingest(df)
    assert tables["topics"].first().title == "State Of Roads"
    again = ingest.ingest(df, tables)
    assert {n: t.count() for n, t in again.items()} == {n: t.count() for n, t in tables.items()}


def test_listing_and_fold(spark):
    assert [listing.route(*x) for x in ((None, None), (None, dt.date(2012, 1, 1)), (dt.date(2014, 1, 1), None), (dt.date(2012, 1, 1), None))] == ["current", "archive", "current", "both"]
    with pytest.raises(ValueError):
        listing.ListOptions(limit=0)
    rows = spark.createDataFrame([(None, 1, 5, "a"), (None, 2, None, None), ("k", 1, 1, "x")], "k string, o int, v int, s string")
    out = {r.k: (r.v, r.s) for r in fold.fold(rows, ["k"], {"v": "coalesce", "s": "new"}, ["o"]).collect()}
    assert out == {None: (5, None), "k": (1, "x")}
    assert html.page_info("<a class='page_label' href='?page=3'>3</a>") is None
    pager = "<ul><li class='active active_number_box'><span>2</span></li><a class='page_label' href='?q=&amp;page=3'>3</a></ul>"
    assert html.page_info(pager) == {"current": 2, "last": 3} and html.page_info(pager, "bills") is None
    with pytest.raises(pages.PageOutOfRange):
        pages.member_page(spark.createDataFrame([("/l", pager)], "url string, html string"), "Senate", 4)


def test_pending_loop_metrics_and_links(spark):
    left = [7]

    def work(rows):
        n = min(rows.count(), 3)
        left[0] -= n
        return n

    assert pending.drain(lambda k: spark.range(min(k, left[0])), work, batch=3) == 7
    left[0] = 5
    assert pending.drain(lambda k: spark.range(5), lambda rows: 0, attempts=2) == 0
    pushed = []
    m = sinks.TextMetrics(pushed.append)
    m.counter("done", 2, target="bills")
    m.counter("done", 1, target="bills")
    m.gauge("rate", 4)
    m.flush()
    assert 'done{target="bills"} 3' in pushed[0] and "# TYPE rate gauge" in pushed[0]
    with pytest.warns(UserWarning):
        sinks.TextMetrics(lambda said: 1 / 0).flush()
    df = pages.current_sittings(spark.createDataFrame([("/s/x", PAGE)], "url string, html string"))
    members = spark.createDataFrame([("Achieng", "/m/1/", None, "Senate", "13th-parliament", None), ("Brief", "/m/2/", None, "Senate", "13th-parliament", None)], "name string, url string, role string, house string, parliament string, constituency string")
    tables, counts = ingest.link_all(ingest.ingest(df), members)
    assert counts == {"speakers": 2, "bills": 1}
    assert {r.name: r.member_url for r in tables["speakers"].collect()} == {"Hon. Achieng": "/m/1/", "Hon. Silent": None, "Hon. Brief": "/m/2/"}
    assert ingest.link_all(tables, members)[1] == {"speakers": 0, "bills": 0}


def test_streamed_batches_fold_once(spark, tmp_path):
    schema = "sitting_url string, speaker_name string, speaker_url string, speech_count long, at int"
    table = stream.VersionedTable(spark, str(tmp_path / "table"))
    for k in range(2):
        spark.createDataFrame([("/s", "A", None, 2, k), ("/s", "B", "/b", 1, k)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        stream.fold_stream(source, "sitting_speakers", ["at"], table.read, table.swap, str(tmp_path / "check")).awaitTermination()
    assert {r.speaker_name: r.speech_count for r in table.read().collect()} == {"A": 4, "B": 2}
    last = table.versions()[-1][1]
    table.swap(table.read().limit(0), last)  # a retried batch is ignored
    assert table.read().count() == 2
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))  # another stream, whose numbers begin anew
    stream.fold_stream(source, "sitting_speakers", ["at"], table.read, table.swap, str(tmp_path / "other")).awaitTermination()
    assert {r.speaker_name: r.speech_count for r in table.read().collect()} == {"A": 8, "B": 4} and len(table.versions()) == 2


def test_title_reads_whole_references_only():
    """html_title is that of its SQL: a reference without its semicolon, as where a title was cut, stays as it stands."""
    assert html.title("<title>a &amp; b &lt;c&gt; &quot;d&quot; e&amp</title>") == {"title": 'a & b <c> "d" e&amp'}
    assert html.title("<title>&amp;amp; &nbsp; &</title>") == {"title": "&amp; &nbsp; &"}


def test_pages_are_spread_over_tasks(spark):
    """Profiles are few rows before their pages are made; a broadcast join once left all pages to one task."""
    from plenaria.plans import page_queries

    t = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    told = page_queries.profile_pages(t).select(F.spark_partition_id().alias("p")).distinct().count()
    assert told == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_kept_elements_are_those_of_the_whole_page():
    """Reading only some elements of a page gives what the whole tree gives, plain tags or not."""
    bill = "<div class='bill-item'><h3 class='bill-name'>A &amp; B</h3><span class=\"bill-year\">2020</span><div class='bill-stage'>Status: Read</div></div>"
    for page in (f"<p>x{bill}</p>", f"<div><section>{bill}<br/>{bill}</div></section>", f"<!-- c -->{bill}<script>a<b</script>{bill}", f"<DIV CLASS=x>{bill}< 3"):
        assert html.bills(page) == html.bills(html.tree(page)) == [{"name": "A & B", "year": "2020", "status": "Read"}] * page.count("bill-item")
        assert [x.tag for x in html.tree(page).walk()] == [x.tag for x in html.Node.walk(html.tree(page))]


def test_listing_pages_stay_small(spark):
    """Pages of a priority are more, not larger, where there are more orders; once there was one."""
    from plenaria.plans import page_queries

    one = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    more = one.unionByName(one.withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000))
    longest = lambda orders: page_queries.listing_pages(lambda name: orders).agg(F.max(F.length("html"))).first()[0]
    assert longest(more) < 1.1 * longest(one) < 500_000


def test_checked_reads_every_row_of_a_page(spark):
    pager = "<li class='active active_number_box'><span>{}</span></li>"
    saved = spark.createDataFrame([("/p/", pager.format(2)), ("/p/", pager.format(3))], "url string, html string").coalesce(1)
    assert pages.checked(saved.limit(1), 2) is not None
    with pytest.raises(pages.PageOutOfRange):
        pages.checked(saved, 2)


@pytest.mark.parametrize("size", [1, 7, 50, 10_000])
def test_a_page_in_pieces_is_the_page(size):
    """Rows and pager of a page that is read piece by piece are those of the whole page, however it is cut, and little of it is held."""
    link = "<div class='hansard-document'><h3><a href='/s/{0}/'>Title &amp; {0}</a></h3></div>\n"
    house = "<div class='split-docs'>" + "".join(link.format(k) for k in range(40)) + "</div>"
    pager = "<nav><li class='active active_number_box'><span> 2 </span></li><a class='page_label' href='?page=7'>7</a><a class='page_label' href='?page=5'>5</a></nav>"
    member = "<a class='members-list--item' href='/m/1'><div class='members-list--name'>A</div></a>"
    for page in (pager + house + house, f"<p>x<!-- a > b -->{house}<script>a<b</script>{house}{pager}", f"x {house[:-6]}{house}</div>{house}< 3", member * 3 + pager, f"{house}<li class='active active_number_box'>none</li>"):
        for kind, rows in (("listing", html.listing_links), ("members", html.members)):
            saved = html.Saved(kind)
            told = list(saved.rows(page[k : k + size] for k in range(0, len(page), size)))
            assert sorted(map(str, told)) == sorted(map(str, rows(page)))
            assert saved.info == html.page_info(page)
    parts = html._Parts(("hansard-document",))
    list(parts.told([house, house]))
    assert not parts.root.children and not parts.within


BILL = "<div class='bill-item'><h3 class='bill-name'>{0}</h3><span class=\"bill-year\">{1}</span><div class='bill-stage'>Status: {2}</div></div>\n"
VOTE = "<div class='voting-patterns-row'><div class='voting-cell voting-date'>{0}</div><div class='voting-cell voting-title'><a href='{1}'>{2}</a></div><div class='voting-cell voting-decision'><span class='decision-badge'>{0}</span></div></div>"
GROUP = "<div class='contribution-group'><span class='topic-badge topic-badge-large'>{0}</span><div class='conversation-subgroup'><a class='conversation-title' href='{1}'>T {2}</a><div class='contribution-item'><a class='contribution-text-link' href=\"{1}\"><p class='contribution-text'>{0}</p></a></div></div></div>"


def test_items_read_apart_are_those_of_the_whole_page():
    """Items of known markups give the rows of the whole tree, whatever stands around or in them, and come into no tree."""
    import random

    around = ["<p>", "</p>", "</div>", "<div>", "<ul><li>", "</ul>", "<br>", "<h2 class='header-three'>Parties</h2><p class='elected-post'>P</p>", "<div class='position-section'>", "<nav class='bills-pagination'><li class='active_number_box'><span>1</span></li><a href='?bills_page=3'>l</a>", "</nav>", "<!-- c -->", "<script>a<b</script>", "< 3", "<div class='bill-item'>", "<li class='bill-item'>no</li>", "\n"]
    inside = ["<b>", "</b>", "</div>", "<p>z</p>", "<li>", BILL, "<h2 class='header-three'>Parties</h2>", "<title>a</title>", "<a href='1' href=\"2\">k</a>", "<i title='x > y' HREF='/z'>k</i>"]
    told = ["a", "b &amp; c", "&lt", "x>y", "", "/s/1#top", "é\xa0 u", "\x010\x01", "\\("]
    some = random.Random(7)

    def item():
        out = some.choice((BILL, VOTE, GROUP)).format(*some.choices(told, k=3))
        at = some.choice([i for i, c in enumerate(out) if c == "<"])
        return out if some.random() < 0.8 else out[:at] + some.choice(inside) + out[at:]

    for _ in range(300):
        html._markups.clear(), html._sought.clear()
        page = "<h1 class='page-heading'>N</h1>" + "".join(item() if some.random() < 0.8 else some.choice(around) for _ in range(some.randint(1, 15)))
        root, whole = html.tree(page), html.profile(page)
        assert whole["bills"] == html.bills(page) == html.bills(root)
        assert whole["voting_patterns"] == html.votes(page) == html.votes(root)
        assert whole["activity"] == html.activity(page) == html.activity(root)
        assert html.page_infos(page, ("bills",)) == [{"kind": "bills", **x} for x in [html.page_info(root, "bills")] if x]
    read = html._Apart(("contribution-group",), {"contribution-group": (html.activity, True)})
    root = read.read("".join((BILL * 3 + VOTE + GROUP).format(k, f"/s/{k}#x", "t") for k in range(50)))
    assert not root.index[None] and [x["url"] for x in read.all("contribution-group")] == [f"/s/{k}#x" for k in range(50)]


def test_pages_are_made_once(spark):
    """A filter on pages once had each made twice. Blank pages still give no rows."""
    made = spark.range(3).select(F.lit("/p").alias("url"), F.concat(F.lit("<b>MARK</b>"), F.col("id").cast("string")).alias("html"))
    plan = pages.parsed(made, html.bills, pages.BILL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MARK") == 1
    blank = spark.createDataFrame([("/a", None), ("/b", ""), ("/c", "  "), ("/d", "\n"), ("/e", "x")], "url string, html string")
    assert sorted(r.page_url for r in pages.parsed(blank, lambda page: {"name": page}, "name string").collect()) == ["/d", "/e"]


def test_profiles_of_some_fields(spark):
    """Profiles are read for the fields asked for: those of the whole profile, without rows of items that none of them needs."""
    page = "<h1 class='page-heading'>N</h1><img class='member-list--image' src='/p.png'>" + (BILL + VOTE + GROUP).format("a", "/s", "b") * 3
    whole = html.profile(page)
    for fields in (("name", "party"), ("activity_pages",), ("bills", "bills_pages"), ("voting_patterns", "activity")):
        assert html.profile(page, frozenset(fields)) == {k: whole[k] for k in fields}
    assert whole["activity_pages"] == whole["bills_pages"] == 1 and len(whole["voting_patterns"]) == 3
    df = spark.createDataFrame([("/mps/7/", page)], "url string, html string")
    full, some = pages.profiles(df).first(), pages.profiles(df, "photo_url", "bills")
    assert some.columns == ["page_url", "name", "photo_url", "bills", "slug"] and all(some.first()[c] == full[c] for c in some.columns)
    with pytest.raises(ValueError):
        pages.profiles(df, "bill")

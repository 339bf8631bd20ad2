import json

import pytest
from postlake.operators import pages, registry
from postlake.sources import discoveries
from postlake.sources.payloads import cached_postings, normalised, postings, unknown_platforms
from postlake.sources.tables import STATE, empty, latest, load_registry, load_state, publish, registry_lines, save_state
from pyspark.sql import functions as F

BRONZE = "company_name string, ats_platform string, token string, api_url string, page_no int, body string, _row bigint"


def bronze(spark, *rows):
    return spark.createDataFrame([(c, p, "t", "https://x.com/a/b/c/site/json", n, body if isinstance(body, (str, type(None))) else json.dumps(body), i) for i, (c, p, n, body) in enumerate(rows)], BRONZE)


def test_bodies_that_hold_nothing(spark):
    rows = bronze(spark, ("a", "lever", 0, "{broken"), ("b", "greenhouse", 0, {"jobs": None}), ("c", "jazzhr", 0, {"jobs": [{"id": 1}]}), ("d", "greenhouse", 0, None), ("e", "odd", 0, []), ("f", "oraclehcm", 0, {"items": []}))
    assert postings(rows, "2026-08-22").count() == 0 and postings(rows.where("false"), "2026-08-22").count() == 0
    assert [r["error"] for r in unknown_platforms(rows, "2026-08-22").collect()] == ["unknown platform odd"]
    assert {r["platform"] for r in normalised(bronze(spark, ("a", " Lever ", 0, []))).collect()} == {"lever"}


def test_ids_repeated_over_pages_count_once(spark):
    job = lambda i, name: {"id": i, "name": name}
    rows = bronze(spark, ("a", "eightfold", 0, {"positions": [job("1", "x"), job("2", "y")]}), ("a", "eightfold", 1, {"positions": [job("1", "later"), job("", "z"), job("", "z")]}), ("b", "phenom", 0, {"positions": [job("1", "w")]}))
    got = sorted((r["company"], r["title"], r["ats_platform"]) for r in postings(rows, "2026-08-22").collect())
    assert got == [("a", "x", "eightfold"), ("a", "y", "eightfold"), ("a", "z", "eightfold"), ("a", "z", "eightfold"), ("b", "w", "eightfold")]
    found = [{"job_id": "1", "title": "t"}, {"job_id": "1", "title": "u"}, {"title": "no id"}, {"title": "by link", "apply_options": [{"link": ""}, {"link": "https://l"}]}]
    google = postings(bronze(spark, ("q", "google_jobs", 0, {"jobs_results": found})), "2026-08-22")
    assert sorted((r["title"], r["url"]) for r in google.where("title <> 'by link'").collect()) == [("t", "")]


def test_order_holds_beyond_a_thousand_pages(spark):
    rows = bronze(spark, *[("a", "lever", n, [{"text": f"p{n}"}]) for n in (1500, 2, 999)])
    rows = rows.withColumn("_row", F.lit(7).cast("bigint"))
    assert [r["title"] for r in postings(rows, "2026-08-22").orderBy("_ord").collect()] == ["p2", "p999", "p1500"]


def test_discovered_posts(spark):
    body = "Analyst<br>Acme<br>Haifa<br>Python, SQL<br>Mid level<br>https://x.com/a?b=1<br>--<br>ad https://ad"
    rows = spark.createDataFrame([("c", 1, body, "2026-08-22T10:00"), ("c", 2, "a<br>b<br>c", "2026-08-22"), ("c", 3, "Jobs posted:<br>b<br>c<br>https://x", "2026-08-22"), ("c", 4, None, None)], "channel string, id bigint, body string, posted string")
    (r,) = discoveries.channel_postings(rows).collect()
    assert (r["title"], r["company"], r["url"], r["description"]) == ("Analyst", "Acme", "https://x.com/a", "Skills: Python, SQL. Seniority: Mid level.")
    dates = spark.createDataFrame([("5 days ago",), ("30+ days",), ("22 days ago",), ("לפני 3 ימים",), ("2026-01-02T00",), ("soon",), (None,)], "d string").coalesce(1)
    assert [r[0] for r in dates.select(discoveries.discovery_date("d", "2026-08-22")).collect()] == ["2026-08-17", None, None, "2026-08-19", "2026-01-02", "", ""]


JOBS = [{"title": "Data Analyst", "office": {"name": "Haifa"}}, {"title": "QA Engineer", "id": "7"}, {"x": 1}]


def nested(value, levels):
    for k in range(levels):
        value = {"n": value} if k % 2 else [value]
    return value


@pytest.mark.parametrize(
    ("tree", "want"),
    [
        ({"a": [{"b": JOBS}]}, ["Data Analyst", "QA Engineer"]),
        (JOBS[:1], []),
        ([*JOBS, *[{"x": 1}] * 3], []),
        (nested(JOBS, 14), ["Data Analyst", "QA Engineer"]),
        (nested(JOBS, 15), []),
        # a list comes before what is in it; a text that looks like JSON is a text; names that can't be titles don't count
        ([{**JOBS[0], "more": [{"name": "Product Lead"}, {"name": "Sales Lead", "url": "u"}], "z": json.dumps(JOBS)}, JOBS[1], {"title": "Home"}], ["Data Analyst", "QA Engineer", "Product Lead", "Sales Lead"]),
        ("Data Analyst", []), (None, []), ([1, None, "x", [[]]], []),
    ],
)
def test_job_lists_in_json(spark, tree, want):
    rows = spark.createDataFrame([(1, json.dumps(tree))], "k int, blob string")
    assert [r["title"] for r in pages.listed_postings(rows, "blob").orderBy("_at").collect()] == want


def test_texts_of_embedded_postings(spark):
    """Names of places in objects and arrays of arrays; the first member in the text's order decides; broken JSON holds nothing."""
    jobs = [{"jobTitle": " Data Analyst ", "name": "QA Engineer", "offices": [{"label": "Haifa"}, ["Lod", [{"text": "Yafo"}]], 3, "far"], "href": "/1", "url": "/2", "datePosted": "2026-08-01"}, {"title": "Data Engineer", "ID": "7", "city": {"x": 1}, "location": "Holon"}, {"title": "Data Lead"}]
    html = f'<script type="application/json">{json.dumps(jobs)}</script><script type="application/json">[{{broken</script>'
    rows = spark.createDataFrame([(1, "https://a.com", html, "A"), (2, "https://a.com", None, "B")], "page_id bigint, url string, html string, company string")
    got = pages.embedded_postings(rows).orderBy("_at").collect()
    assert [(r["title"], r["location"], r["url"], r["date"], r["job_id"], r["_at"]) for r in got] == [("Data Analyst", "Haifa, Lod, Yafo", "/1", "2026-08-01", "", 0), ("Data Engineer", "Holon", "", "", "7", 1)]


def test_a_page_is_read_without_shuffling_it(spark):
    html = "".join(f'<h3 class="t">Team Engineer {k}</h3><i>Lod, Israel</i>' for k in "abc")
    rows = spark.createDataFrame([(1, "https://a.com", html, "A"), (2, "https://a.com", html + '<a href="/jobs/1">Data Analyst</a> Haifa', "A")], "page_id bigint, url string, html string, company string")
    got = pages.scraped_postings(rows, "2026-08-22")
    assert sorted((r["page_id"], r["title"]) for r in got.collect()) == [(1, "Team Engineer a"), (1, "Team Engineer b"), (1, "Team Engineer c"), (2, "Data Analyst")]
    assert "Python" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "MapInArrow" not in plan


def test_pages_without_anything(spark):
    rows = spark.createDataFrame([(1, "https://a.com", None, "A"), (2, "https://a.com", "", "A"), (3, "https://a.com", "<script type='application/json'>[", None)], "page_id bigint, url string, html string, company string")
    assert pages.scraped_postings(rows, "2026-08-22").count() == 0 == pages.link_groups(rows).count()
    assert {r[0] for r in rows.select(pages.page_mode(F.lit(200), "html")).collect()} == {"page-empty"}
    assert [r[0] for r in rows.select(pages.board_signature("html")).collect()] == [None] * 3
    text = "About the role. " + "You will analyze data. " * 20 + "Requirements: SQL"
    got = spark.createDataFrame([(f"<p>{text}</p>",), ("<p>short requirements experience</p>",), (None,)], "h string").coalesce(1).select(pages.role_text("h")).collect()
    assert got[0][0].startswith("About the role") and got[1][0] == got[2][0] == ""


def test_what_wants_a_description(spark):
    rows = spark.createDataFrame([("", "https://x", "Data Analyst", None), ("text", "https://x", "Data Analyst", None), ("", "ftp", "Data Analyst", None), ("", "https://x", "Office Manager", None), ("", "https://x", "Data Analyst", "2026-08-20")], "description string, url string, title string, _jd_attempted string")
    assert pages.wants_description(rows, "2026-08-22").count() == 1


def test_caches_fall_back_to_the_token(spark):
    rows = spark.createDataFrame([("a", "t1"), ("b", "t2"), ("c", "t3")], "company_name string, token string")
    cache = spark.createDataFrame([("a", [("own",)]), ("t1", [("other",)]), ("b", []), ("t2", [("token",)])], "company string, jobs array<struct<id:string>>")
    assert sorted(r["id"] for r in cached_postings(rows, cache).collect()) == ["own", "token"]


def test_states_are_versions(spark, tmp_path):
    root = str(tmp_path)
    assert load_state(spark, root, "baseline").count() == 0
    one = spark.createDataFrame([("a", 1)], STATE["baseline"])
    assert [save_state(one, root, "baseline"), save_state(one.union(one), root, "baseline")] == [1, 2]
    assert load_state(spark, root, "baseline").count() == 2
    # another writer has claimed version 3 and not finished: nobody writes it, nobody reads it
    (tmp_path / "baseline" / "claim=3").touch()
    assert save_state(one, root, "baseline") == 4 and load_state(spark, root, "baseline").count() == 1
    assert save_state(one, root, "baseline", batch=5) == 5 == save_state(one, root, "baseline", batch=5)


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_published_tables(spark, tmp_path, kind):
    """A writer that dies between data and pointer is not read; old versions go, with what dead writers left; odd texts come back."""
    folder, schema = str(tmp_path / kind), "company string, n bigint"
    rows = [("a \"quoted\", text", 1), ("two\nlines", 2), ("", 3), (None, None)]
    assert latest(spark, folder, schema, kind).collect() == []
    assert publish(spark.createDataFrame(rows, schema), folder, kind) == 1
    assert sorted(map(tuple, latest(spark, folder, schema, kind).collect()), key=str) == sorted(rows, key=str)
    one = spark.createDataFrame([("later", 1)], schema)
    (tmp_path / kind / "claim=2").touch()
    one.write.format(kind).save(f"{folder}/v=2")  # whole data without a pointer
    assert latest(spark, folder, schema, kind).count() == 4
    assert [publish(one, folder, kind, keep=2) for _ in range(3)] == [3, 4, 5]
    assert sorted(f.name for f in (tmp_path / kind).iterdir() if not f.name.startswith(".")) == ["claim=4", "claim=5", "current=4", "current=5", "v=4", "v=5"]
    assert [tuple(r) for r in latest(spark, folder, schema, kind).collect()] == [("later", 1)]
    # a slower writer of an earlier version doesn't take the pointer back
    (tmp_path / kind / "current=3").touch()
    assert latest(spark, folder, schema, kind).count() == 1


def test_two_writers_publish_two_versions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    folder, one = str(tmp_path / "t"), spark.createDataFrame([("a", 1)], "company string, n bigint")
    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(lambda _: publish(one, folder, keep=9), range(4))) == [1, 2, 3, 4]
    assert latest(spark, folder, "company string, n bigint").count() == 1


def test_registry_from_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text('company_name,ats_platform,token,api_url,active,notes\nA,lever,t,u,True,"two\nlines"\nB,lever,t,u,false,""\n')
    assert [r["notes"] for r in load_registry(spark, str(tmp_path / "r.csv")).collect()] == ["two\nlines"]
    assert load_registry(spark, str(tmp_path / "r.csv"), active_only=False).count() == 2
    assert empty(spark, STATE["sent"]).count() == 0


def test_rows_of_the_wrong_width_are_found(spark, tmp_path):
    """Too few and too many fields; a line break within quotes is none."""
    (tmp_path / "r.csv").write_text('company_name,ats_platform,token,api_url,active,notes\nA,lever,t,u,True,"two\nlines"\nB,lever,t,u,True\nC,lever,t,u,True,n,more\nD,lever,t,u,True,\n')
    rows = registry_lines(spark, str(tmp_path / "r.csv"))
    found = registry.violations(rows.cache(), least_pool=0).where("rule = 'width'").collect()
    assert sorted((r["key"], r["detail"]) for r in found) == [("B", "B,lever,t,u,True"), ("C", "C,lever,t,u,True,n,more")]
    assert registry.violations(rows.drop("_broken"), least_pool=0).count() == 0


@pytest.mark.parametrize(("link", "want"), [("/j/1", "https://a.com/j/1"), ("j/1", "https://a.com/b/j/1"), ("//c.com/x", "https://c.com/x"), ("https://d.com", "https://d.com"), ("mailto:x", "mailto:x")])
def test_links_seen_from_their_page(spark, link, want):
    assert spark.range(1).select(pages.absolute(F.lit("https://a.com/b/c?d"), F.lit(link))).first()[0] == want


def test_tasks_grow_in_number_not_in_rows(spark):
    """Rows are dealt by their number, and a page's rows meet where the page is, without another shuffle of its texts."""
    from postlake.samples import dealt

    rows = dealt(spark.range(100_000).withColumnRenamed("id", "page_id"), "page_id", 5_000)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 6_000
    few = dealt(spark.range(10).withColumnRenamed("id", "page_id"), "page_id")
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_repeated_texts_are_read_once(spark):
    """Of 1,000 rows with two texts and none, what is made of a text is made three times."""
    from postlake.functions.profile import once_per_text

    read = spark.sparkContext.accumulator(0)

    def length(t):
        read.add(1)
        return len(t)

    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "bb").alias("d"))
    got = once_per_text(rows, "d", {"n": F.udf(length, "int")(F.col("d"))}).collect()
    assert len(got) == 1000 and all(r["n"] == (1, 2, 0)[r["id"] % 3] for r in got) and read.value == 3


def test_a_column_is_computed_once_though_filters_use_it(spark):
    """The filter on a computed column isn't pushed below it, where its expression would run a second time; one of the same name is replaced."""
    from postlake.functions.text import computed
    from postlake.sources.discoveries import channel_messages, channel_postings

    rows = spark.createDataFrame([("a b",), ("c",)], "t string")
    made = computed(rows, t=F.regexp_replace("t", " ", "-"), n=F.length("t")).where("t <> 'c' and n > 1")
    assert made.columns == ["t", "n"] and [tuple(r) for r in made.collect()] == [("a-b", 3)]
    pages = spark.createDataFrame([("<p/>",)], "html string")
    plan = channel_postings(channel_messages(pages))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<[^>]+>") == 1, "a message's markup is taken out once"


def test_repeats_meet_in_as_many_tasks_as_asked_for(spark):
    """Postings of one key meet in one of `parts` tasks, which Spark doesn't join to fewer because their texts compress well."""
    from postlake.sources.payloads import postings

    body = '{"positions":[{"name":"A","ats_job_id":"%s","positionUrl":"u","description":"d"}]}'
    rows = [(f"c{k % 40}", "eightfold", "t", "u", 0, body % (k % 10), k) for k in range(200)]
    bronze = spark.createDataFrame(rows, "company_name string, ats_platform string, token string, api_url string, page_no int, body string, _row bigint")
    plain, dealt = postings(bronze, "2026-08-22"), postings(bronze, "2026-08-22", 24)
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect())) and plain.count() == 40
    assert dealt.rdd.getNumPartitions() == 24


def test_postings_of_pages_meet_in_as_many_tasks_as_asked_for(spark):
    html = "".join(f'<h3 class="t">Team Engineer {n}</h3><a href="/p/{n}">go</a><i>| Lod, Israel</i>' for n in "abc")
    rows = spark.createDataFrame([(k, "https://a.com/x", html, "Acme") for k in range(30)], "page_id bigint, url string, html string, company string")
    plain, dealt = pages.scraped_postings(rows, "2026-08-22"), pages.scraped_postings(rows, "2026-08-22", 12)
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect())) and plain.count() == 90
    assert dealt.rdd.getNumPartitions() == 12

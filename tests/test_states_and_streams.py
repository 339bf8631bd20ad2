import datetime
import time

import pytest
from postlake.functions.sections import clean_bullet, duties, is_mangled, looks_like_header, requirements, sectioned, sections
from postlake.operators import enrich, outputs, registry, state
from postlake.sources.tables import load_state
from postlake.streaming import incremental
from pyspark.sql import functions as F

from test_functions import job, one

DAY = "2026-08-22"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- sections ---
@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Requirements: • 4 + years of SQL – a must • Python experience (big advantage) • Nice people", [("4+ years of SQL", "must"), ("Python experience", "plus")]),
        ("Qualifications: Strong SQL skills in a team. Degree in Economics. Nice to have: Tableau knowledge. Benefits: lunch", [("Strong SQL skills in a team", None), ("Degree in Economics", None), ("Tableau knowledge", "plus")]),
        ("Ad-hoc requirements Develop dashboards for all. Requirements: • Proven SQL experience", [("Proven SQL experience", None)]),
        ("דרישות: • ניסיון של שנתיים • אנגלית ברמה גבוהה - חובה", [("ניסיון של שנתיים", None), ("אנגלית ברמה גבוהה", "must")]),
        ("Nothing of the kind", []), ("", []), (None, []),
    ],
)
def test_requirements(spark, text, want):
    (got,) = one(spark.createDataFrame([(text,)], "d string"), requirements("d"))
    assert [tuple(x) for x in got] == want


def test_a_list_without_markers_is_cut_where_items_begin(spark):
    """A long piece is cut by its pattern; the pattern isn't taken for the piece's place in the list."""
    rows = spark.createDataFrame([("Requirements: 30 months of experience with SQL and reporting in large companies Strong knowledge of Python and of statistics Ability to present results",)], "d string")
    (got,) = one(rows, requirements("d"))
    assert [r["text"] for r in got] == ["30 months of experience with SQL and reporting in large companies", "Strong knowledge of Python and of statistics", "Ability to present results"]


def test_parts_in_columns_equal_parts_in_one_expression(spark):
    texts = (
        None, "", "plain", "Show more Description: We sell tea.", "Experience level: Senior. Requirements: • SQL – a must • Python  (big advantage Nice to have: • dbt\u200b\u00a0and  Airflow • Bonus points: • Jira",
        "About you: lead the team. Qualifications: Attention to detail. ATTENTION to detail. 5 + years with use of AI to automate work Benefits: lunch", "Responsibilities: • # no • Build dashboards\twith ChatGPT • Our AI platform is https://x.com",
        "What you'll do: Analyze funnels and present them to stakeholders. Advantage: MBA", "דרישות: ניסיון של שנתיים – חובה • אנגלית – יתרון", "Responsibilities: Requirements: • About the role, is a plus, and",
    )
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, d string")
    got = {r["i"]: r for r in sectioned(rows, "d").collect()}
    parts = ("requirements", "duties", "tasks", "soft", "ai_asked", "ai_daily")
    for r in rows.select("i", sections("d").alias("s")).collect():
        assert [got[r["i"]][p] for p in parts] == [r["s"][p] for p in parts], texts[r["i"]]


def test_duties_and_bullets(spark):
    (got,) = one(spark.createDataFrame([("Responsibilities: • Build reports daily • build REPORTS daily • Lead a team of four Requirements: • SQL",)], "d string"), duties("d"))
    assert got == ["Build reports daily", "Lead a team of four"]
    texts = spark.createDataFrame([("• Requirements: SQL , Python ( ",), ("x " * 200,), ("is highly skilled with",), ("Open (bracket of words",)], "d string").coalesce(1)
    got = one(texts, clean_bullet(F.col("d")))
    assert got[0] == "SQL, Python" and len(got[1]) <= 211 and got[1].endswith("…") and got[2] == "highly skilled" and got[3] == "Open (bracket of words)"
    assert one(spark.createDataFrame([("Your Chain of Strengths",), ("5 Years Here",), ("one",)], "d string").coalesce(1), looks_like_header(F.col("d"))) == [True, False, False]
    assert one(spark.createDataFrame([("Data ScientistTel Aviv",), ("Data Scientist",), ("x" * 101,), (None,)], "d string").coalesce(1), is_mangled("d")) == [True, False, True, False]


# --- state ---
def test_runs_that_count_against_names(spark):
    make = lambda *results: spark.createDataFrame([(f"c{i}", i, r) for i, r in enumerate(results)], "company string, _ord int, result string")
    judged = lambda *results: state.outcomes_count(make(*results)).first()["counts"]
    assert judged("ok", "failed") and judged("failed", "failed") and judged("error", "ok", "error", "error", "ok")
    assert not judged("error", "error", "error", "ok") and not judged(*["failed"] * 5) and judged(*["failed"] * 5, "ok")
    known = spark.createDataFrame([("c0", 1, "2026-01-01")], "company string, attempts int, last string")
    assert rows(state.record_research_failures(known, make("failed", "ok"), DAY)) == [("c0", 2, DAY)]
    assert rows(state.record_research_failures(known, make(*["failed"] * 6), DAY)) == [("c0", 1, "2026-01-01")]


def test_counts_that_cannot_be_confirmed_go(spark):
    schema = "company string, employees_global int, size_band string, employees_source string, employees_as_of string, employees_range string, band_before string, employees_miss string"
    known = spark.createDataFrame([("a", 50, "S", "linkedin-weakmatch", "x", "11-50", "L", None), ("b", 50, "S", "linkedin", "x", "11-50", None, None), ("c", 9, "S", "linkedin", "x", None, None, None), ("d", 7, "S", "web: y", "x", None, None, None)], schema)
    outcomes = spark.createDataFrame([("a", 1, "failed", None, None), ("b", 2, "failed", None, None), ("c", 3, "ok", 4000, "site"), ("e", 4, "error", None, None)], "company string, _ord int, result string, employees int, source string")
    got = {r["company"]: r for r in state.verify_employees(known, outcomes, DAY).collect()}
    assert (got["a"]["employees_global"], got["a"]["size_band"], got["a"]["employees_source"], got["a"]["employees_miss"]) == (None, "L", "linkedin-weakmatch-quarantined", DAY)
    assert (got["b"]["employees_global"], got["b"]["employees_miss"]) == (50, DAY) and got["d"]["employees_miss"] is None
    assert (got["c"]["employees_global"], got["c"]["size_band"], got["c"]["employees_source"]) == (4000, "L", "web: site")


def test_small_state_steps(spark):
    seen = spark.createDataFrame([("a", 1, 5), ("b", 0, 3), ("c", 9, 9)], "company string, sig bigint, il bigint")
    before = spark.createDataFrame([("a", 0, 5), ("b", 0, 3)], "company string, sig bigint, il bigint")
    assert [r["wake"] for r in state.probe(seen, before).orderBy("company").collect()] == [True, False, False]
    tries = spark.createDataFrame([("a", 4, "2026-08-01"), ("b", 1, "2026-08-20")], "company string, fails int, last string")
    out = spark.createDataFrame([("a", False), ("b", True), ("c", False)], "company string, ok boolean")
    assert rows(state.attempts_after(tries, out, DAY)) == [("a", 5, DAY), ("c", 1, DAY)]
    names = spark.createDataFrame([("a",), ("b",), ("z",)], "company string")
    assert rows(state.due_attempts(names, tries, DAY)) == [("a",), ("z",)]
    whys = spark.createDataFrame([("error", 1), ("error", 8), ("error", 20), ("empty", 50), ("empty", 2)], "w string, d int").coalesce(1)
    assert one(whys, state.rot_action(F.col("w"), F.col("d"))) == ["carry", "carry+park", "park", "flag", "none"]
    few = names.where("company <> 'z'")
    assert state.refresh_is_sound(few, names, 0.6).first()["sound"] and not state.refresh_is_sound(few, names).first()["sound"]
    one_a, two = spark.createDataFrame([("A", "unknown", 1)], "name string, ats string, _ord int"), spark.createDataFrame([("a ", "lever", 2)], "name string, ats string, _ord int")
    assert [r["ats"] for r in enrich.merge_research(one_a, two).collect()] == ["lever"]
    assert rows(enrich.archive(job(spark, {"company": "a", "title": "x"}, {"company": "b", "title": "x"}), job(spark, {"company": "a", "title": "x"})).select("company")) == [("b",)]
    fresh = spark.createDataFrame([("a", "new", "", 40, "")], "company string, sector string, stage string, employees_global int, size_band string")
    old = spark.createDataFrame([("a", "old", "public", 5000, "XL")], fresh.schema)
    assert rows(enrich.refreshed(fresh, old, ["sector", "stage", "size_band", "employees_global"])) == [("a", "new", "public", 40, "S")]
    board = spark.createDataFrame([("Acme Ltd",), ("Acme",), ("Globex",), ("Initech Inc",)], "company string")
    known = spark.createDataFrame([("Globex Ltd",)], "company string")
    failed = spark.createDataFrame([("Initech", "2026-08-20")], "company string, last string")
    assert rows(enrich.missing_firms(board, known, failed, DAY)) == [("Acme",)]


def test_registry_steps(spark):
    schema = "company_name string, ats_platform string, token string, api_url string, active string, notes string, _row int"
    reg = spark.createDataFrame([(f"c{i}", "scrape", "", "https://jobs.lever.co/x" if i == 3 else "u", "false", n, i) for i, n in enumerate(["no listing found", "dark-triage 2026-08-01: js-shell", "dark-triage 2026-08-01: page-empty", "defunct", "listing-hunt 2026-08-20: none | no IL listing"])], schema)
    assert [r[0] for r in registry.selected(reg, [" C1 ", "c4"]).collect()] == ["c1", "c4"] and [r[0] for r in registry.selected(reg, n=2).collect()] == ["c0", "c1"]
    assert sorted(r["_row"] for i in range(2) for r in registry.shard(reg, i, 2).collect()) == list(range(5)) and sorted(r["_row"] for r in registry.shard(reg, 1, 2).collect()) == [1, 3]
    assert sorted(r[0] for r in registry.pool_of(reg, "listing-hunt", DAY).collect()) == ["c0", "c1"]
    stale = spark.createDataFrame([("s", "https://a.wd5.myworkdayjobs.com/wday/cxs/a/Site/jobs"), ("t", "")], "company string, careers_url string")
    assert rows(registry.to_resolve(stale, reg)) == [("s", "https://a.wd5.myworkdayjobs.com/Site")]
    assert rows(registry.to_resolve(stale.where("false"), reg)) == [("c3", "https://jobs.lever.co/x")]
    assert rows(registry.outcome_tally(spark.createDataFrame([("x",), ("x",), ("y",)], "mode string"))) == [("x", 2), ("y", 1)]
    (after,) = one(spark.createDataFrame([("a | hunt 2026-01-01: old",)], "n string"), registry.stamp("n", "hunt", DAY, "new"))
    assert after == f"a | hunt {DAY}: new"
    (awake,) = one(spark.createDataFrame([("keep | dark-triage 2026-01-01: page-empty",)], "n string"), registry.woken("n", DAY))
    assert awake.startswith("keep | probe-woken")
    out = spark.createDataFrame([("c0", "lever", "t", "u2", "true", "found")], "company_name string, platform string, token string, api_url string, active string, finding string")
    changed = registry.apply_outcomes(reg, out, "hunt", DAY)
    assert changed.where("company_name = 'c0' and active = 'true' and ats_platform = 'lever'").count() == 1 and changed.count() == 5
    assert registry.replace_changed(reg, changed.where("company_name = 'c0'")).where("active = 'true'").count() == 1
    wrong = spark.createDataFrame([("Acme Foods", "https://x.com/jobs/view/data-analyst-at-globex-1234567"), ("Globex", "https://x.com/jobs/view/data-analyst-at-globex-1234567")], "company string, url string")
    assert [r["key"] for r in registry.misattributed(wrong).collect()] == ["Acme Foods"]


# --- outputs ---
def test_outputs_escape_what_they_are_given(spark):
    jobs = spark.createDataFrame([("<b>", "k", "T [x](javascript:1)", "H", "javascript:alert(1)", "", ["lever"], "keyword", "", None)], "company string, mkey string, title string, location string, url string, posted_date string, sources array<string>, path string, description string, first_seen string")
    (h,) = outputs.html_digest(jobs).collect()
    assert "<b>" not in h["block"] and "javascript" not in h["block"].replace("](javascript:1)", "") and "&lt;b&gt;" in h["block"]
    (m,) = outputs.markdown_digest(jobs, DAY).collect()
    assert "\\[x\\]\\(javascript:1\\)" in m["block"] and "alert" not in m["block"]
    axes = spark.createDataFrame([("size", "S", 2, 9, None, 0.5, 0.1, 0.0, [("SQL", 3)])], "axis string, value string, companies bigint, jobs bigint, median_years int, degree_required_rate double, lead_share double, ai_mention_rate double, top_skills array<struct<skill:string,n:bigint>>")
    assert outputs.axes_markdown(axes).first()["line"] == "| S | 2 | 9 | — | 0.5 | 0.1 | 0.0 | SQL |"
    assert '"jobs_analyzed":9' in outputs.axes_json(axes, 9).first()["value"]
    assert outputs.subject(1, DAY).startswith("1 new senior analytics opening —")


# --- streams ---
def test_a_stream_of_postings_keeps_the_matched_table(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "state")
    posts = job(spark, {"company": "a", "title": "x", "ats_platform": "lever", "job_id": "1", "_ord": 1}, {"company": "A ltd", "title": "X", "ats_platform": "ashby", "job_id": "2", "_ord": 2})
    posts.write.parquet(source)
    sink = incremental.matched_sink(root, DAY)
    run = lambda: incremental.start(incremental.read_folder(spark, source, posts.schema), sink, str(tmp_path / "c")).awaitTermination()
    run()
    assert [r["seen_ids"] for r in load_state(spark, root, "matched").collect()] == [["ashby:2", "lever:1"]]
    job(spark, {"company": "b", "title": "y", "ats_platform": "lever", "job_id": "3", "_ord": 3}).write.mode("append").parquet(source)
    run()
    assert load_state(spark, root, "matched").count() == 2
    sink(posts, 0)  # the first batch again
    assert len(list((tmp_path / "state" / "matched").glob("v=*"))) == 2


def _streamed(spark, tmp_path, frame, make, mode="append"):
    frame.write.parquet(str(tmp_path / "in"))
    stream = make(spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in")))
    name = f"t{abs(hash(str(tmp_path))) % 10**9}"
    stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


def _events(spark):
    at = lambda d, h: datetime.datetime(2026, 8, d, h)
    return spark.createDataFrame([("a", at(1, 1), 1.0), ("a", at(1, 2), 2.0), ("a", at(1, 2), 2.0), ("b", at(1, 9), 5.0), ("z", at(9, 1), 0.0)], "k string, ts timestamp, value double")


def test_windows_on_a_stream(spark, tmp_path):
    got = _streamed(spark, tmp_path, _events(spark), lambda s: incremental.windowed_counts(s, "ts", ["k"], "1 day"))
    assert {(r["k"], r["n"], r["total"]) for r in got.collect()} >= {("a", 3, 5.0), ("b", 1, 5.0)}


def test_sessions_on_a_stream(spark, tmp_path):
    got = _streamed(spark, tmp_path, _events(spark), lambda s: incremental.sessions(s, "ts", "k", "3 hours"))
    assert {(r["k"], r["n"]) for r in got.collect()} >= {("a", 3), ("b", 1)}


def test_first_rows_on_a_stream(spark, tmp_path):
    got = _streamed(spark, tmp_path, _events(spark), lambda s: incremental.unseen(s, ["k", "ts"], "ts", "1 day"))
    assert got.count() == 4


def test_first_seen_on_a_stream(spark, tmp_path):
    got = _streamed(spark, tmp_path, _events(spark), lambda s: incremental.first_seen_stream(s.withColumn("d", F.to_date("ts")), "k", "d"), "update")
    assert {(r["k"], str(r["first_seen"])) for r in got.collect()} == {("a", "2026-08-01"), ("b", "2026-08-01"), ("z", "2026-08-09")}


def _batches(spark, folder, *days):
    """A stream of one batch for each list of (key, day)."""
    for i, rows in enumerate(days):
        spark.createDataFrame([(k, f"2026-08-{d:02d} 00:00:00") for k, d in rows], "k string, t string").select("k", F.to_timestamp("t").alias("ts")).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
        for f in (folder / str(i)).glob("part-*"):
            f.rename(folder / f"{i}-{f.name}")
        time.sleep(1.1)  # files are read by age
    return incremental.read_folder(spark, str(folder), "k string, ts timestamp", files_per_batch=1)


def test_state_of_idle_keys_expires(spark, tmp_path):
    """A key not seen for longer than the gap leaves the state; its next sighting is a new one."""
    (tmp_path / "in").mkdir()
    stream = _batches(spark, tmp_path / "in", [("a", 1)], [("b", 20), ("a", 2)], [("c", 21)], [("c", 22)], [("a", 22)])
    seen, out = [], incremental.first_seen_stream(stream.withColumn("d", F.to_date("ts")), "k", "d")
    run = out.writeStream.foreachBatch(lambda df, i: seen.extend(map(tuple, df.collect()))).outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination()
    assert [(k, f.day, d.day) for k, f, d in seen if k == "a"] == [("a", 1, 1), ("a", 1, 2), ("a", 22, 22)]
    assert sum(p["stateOperators"][0]["numRowsRemoved"] for p in run.recentProgress if p["stateOperators"]) >= 1
    assert run.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 3


def test_late_rows_go_to_their_own_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = _batches(spark, tmp_path / "in", [("a", 1), ("x", 9)], [("b", 8), ("late", 6), (None, 12)], [("late", 1), ("c", 11)])
    kept, late = [], []
    write = incremental.with_late(lambda df, i: kept.extend(r["k"] for r in df.collect()), lambda df, i: late.extend((i, r["k"]) for r in df.collect()), str(tmp_path), "ts", "2 days")
    incremental.start(stream, write, str(tmp_path / "c")).awaitTermination()
    assert sorted(map(str, kept)) == ["None", "a", "b", "c", "x"] and late == [(1, "late"), (2, "late")]


def test_shards_and_unresolved_of_many_rows(spark):
    """Over 100,000 rows in many partitions, so that ranges are sampled and tasks coalesced; keys have gaps and names repeat."""
    rows = spark.range(0, 900_000, 3, 24).select(F.col("id").alias("_row"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("notes"))
    for i in range(3):
        assert registry.shard(rows, i, 3).agg(F.count(F.lit(1)), F.min("_row"), F.max("_row"), F.count_if(F.col("_row") % 9 != 3 * i)).first()[:] == (100_000, 3 * i, 899_991 + 3 * i, 0)
    companies = rows.select(F.col("_row").cast("string").alias("company"))
    assert registry.unresolved(companies, companies.limit(0), None).count() == 300_000


def test_resolved_rows_with_gaps_and_repeated_names(spark, tmp_path):
    import duckdb

    from postlake import queries

    names = spark.range(5, 3000, 7).select(F.col("id").alias("c_custkey"), F.concat(F.lit("n"), F.col("id") % 50).alias("c_name"))
    names.write.parquet(f"{tmp_path}/customer.parquet")
    got = queries.queries()["resolved_rows"](spark, str(tmp_path))
    sql = queries.oracle_sql()["resolved_rows"].replace("FROM customer", f"FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(duckdb.sql(sql).fetchall())

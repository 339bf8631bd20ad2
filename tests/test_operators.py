from postlake.operators.dedup import cap_per, merge_duplicates, most_common
from postlake.operators.registry import append_absent, merge_notes, three_way_merge, work_queue
from postlake.operators.state import first_seen_from_history, record_failures, revoke_failures, save_latest, streaks, unsent
from postlake.plans import daily
from postlake.sources.tables import STATE
from pyspark.sql import functions as F

from test_functions import job

ROW = "company_name string, ats_platform string, token string, api_url string, active string, notes string"


def registry(spark, *rows):
    return spark.createDataFrame([(n, "scrape", "", u, "true", notes) for n, u, notes in rows], ROW)


def notes(df):
    return {r["company_name"]: r["notes"] for r in df.collect()}


def test_one_posting_per_opening(spark):
    rows = [
        {"company": "Acme", "title": "Analyst", "ats_platform": "lever", "job_id": "1", "posted_date": "3 days ago", "url": "u1", "_ord": 1},
        {"company": "Acme Ltd", "title": "analyst", "ats_platform": "ashby", "job_id": "2", "posted_date": "2026-08-01", "url": "", "_ord": 2},
        {"company": "Other", "title": "Analyst", "ats_platform": "lever", "job_id": "3", "_ord": 3},
    ]
    got = {r["company"]: r for r in merge_duplicates(job(spark, *rows)).collect()}
    assert set(got) == {"Acme Ltd", "Other"}
    best = got["Acme Ltd"]
    assert best["posted_date"] == "2026-08-01" and best["seen_ids"] == ["ashby:2", "lever:1"] and best["sources"] == ["ashby", "lever"]
    sent = spark.createDataFrame([("lever:1",)], "seen_id string")
    assert [r["company"] for r in unsent(merge_duplicates(job(spark, *rows)), sent).collect()] == ["Other"]
    assert merge_duplicates(job(spark, *rows).where("false")).count() == 0


def test_a_gap_of_three_days_keeps_and_of_four_resets(spark):
    rows = [("a", "2026-08-01"), ("a", "2026-08-04"), ("b", "2026-08-01"), ("b", "2026-08-05"), ("b", "2026-08-05"), ("c", None)]
    got = first_seen_from_history(spark.createDataFrame(rows, "k string, d string"), "k", "d").collect()
    assert {(r["k"], str(r["first_seen"]), str(r["last_seen"])) for r in got} == {("a", "2026-08-01", "2026-08-04"), ("b", "2026-08-05", "2026-08-05")}


def test_failures_and_streaks(spark):
    known = spark.createDataFrame([("a", 1, "2026-08-01"), ("b", 2, "2026-08-01")], "company string, attempts int, last string")
    failed = spark.createDataFrame([("a",), ("a",), ("c",)], "company string")
    after = record_failures(known, failed, "2026-08-09")
    assert {tuple(r) for r in after.collect()} == {("a", 2, "2026-08-09"), ("b", 2, "2026-08-01"), ("c", 1, "2026-08-09")}
    back = revoke_failures(after, failed, "2026-08-09")
    assert {tuple(r) for r in back.collect()} == {("a", 1, "2026-08-01"), ("b", 2, "2026-08-01")}
    log = spark.createDataFrame([("x", 1, True), ("x", 2, False), ("x", 3, True), ("x", 4, True), ("y", 1, True), ("y", 2, False)], "k string, d int, bad boolean")
    assert [tuple(r) for r in streaks(log, "k", "d", F.col("bad")).collect()] == [("x", 3, 4, 2)]
    new = spark.createDataFrame([("a", 9, "z")], known.schema)
    assert {tuple(r) for r in save_latest(known, new, "company").collect()} == {("a", 9, "z"), ("b", 2, "2026-08-01")}


def test_three_way_merge(spark):
    base = registry(spark, ("A", "u", "old"), ("B", "u", "old"))
    ours = registry(spark, ("A", "u", "MINE"), ("B", "u", "old"))
    theirs = registry(spark, ("A", "u", "old"), ("B", "u", "THEIRS"))
    got = notes(three_way_merge(base, ours, theirs))
    assert "MINE" in got["A"] and got["B"] == "THEIRS"
    ours = registry(spark, ("A", "u", "old | hunt 2026-08-22: nothing"), ("B", "u", "old"))
    theirs = registry(spark, ("A", "https://repaired", "old | url-repaired 2026-08-22: moved"), ("B", "u", "old"))
    merged = three_way_merge(base, ours, theirs)
    assert {"hunt 2026-08-22: nothing", "url-repaired 2026-08-22: moved"} <= set(notes(merged)["A"].split(" | "))
    assert {r["company_name"]: r["api_url"] for r in merged.collect()}["A"] == "https://repaired"
    fresh = "dark-triage 2026-08-22: url-dead (http 404 on careers page)"
    (capped,) = spark.createDataFrame([("x " * 130, fresh)], "t string, o string").select(merge_notes("t", "o")).first()
    assert len(capped) <= 220 and fresh in capped


def test_new_companies_and_the_queue(spark):
    rows = registry(spark, ("A", "u", "no careers page found"), ("B", "u", "x"))
    assert append_absent(rows, registry(spark, (" a ", "u", ""), ("C", "u", ""), ("c", "v", ""))).count() == 3
    assert work_queue(rows.where("false").withColumn("_row", F.lit(1)), "hunt", "2026-08-22", 10, 5).count() == 0


def test_caps_and_counts(spark):
    df = spark.createDataFrame([("g", "a", 1), ("g", "a", 2), ("g", "b", 3), ("h", "c", 4)], "k string, x string, n int")
    assert sorted(tuple(r) for r in cap_per(df, ["k"], [F.desc("n")], 1).collect()) == [("g", "b", 3), ("h", "c", 4)]
    assert [tuple(r) for r in most_common(df, ["k"], "x", 1).orderBy("k").collect()] == [("g", "a", 2), ("h", "c", 1)]


def test_a_board_row(spark):
    """All that a board shows of an opening, and what it is found by."""
    text = "Experience level: Mid-Senior. Responsibilities: • Build dashboards for the team • Use AI tools to automate reports Requirements: • 4 years of SQL experience – a must • MSc degree of statistics required • Team player with curiosity"
    row = ("m", "Acme Ltd", "Senior Data Analyst, contract", "Haifa, Israel", "https://x", "2026-06-01", "senior", ["lever"], ["lever:1"], text, "2026-06-01", "2026-08-22")
    bare = ("n", "B", "Analyst", "", "", "", "", [], [], None, "2026-08-22", "2026-08-22")
    a, b = daily.board_view(spark.createDataFrame([row, bare], STATE["matched"]), "2026-08-22").orderBy("mkey").collect()
    assert (a["level"], a["level_rank"], a["employment"], a["age_note"], a["flag"], a["degree_rank"], a["city"]) == ("Senior", 4, "Contract", "posted ~2mo ago", "60+ days", 2, "Haifa")
    assert [(r["text"], r["badge"]) for r in a["requirements"]] == [("4 years of SQL experience", "must"), ("MSc degree of statistics", "must"), ("Team player with curiosity", None)]
    assert a["duties"] == ["Build dashboards for the team", "Use AI tools to automate reports"] and [t["token"] for t in a["ai_daily"]] == ["ai-automation"]
    for word in ("acme", "haifa", "sql", "reporting", "teamwork", "curiosity", "ai-automation", "msc"):
        assert word in a["blob"].split() or word in a["blob"], word
    assert (b["level"], b["degree_rank"], b["requirements"], b["flag"], b["age_note"]) == ("—", 0, [], "new", "")


def test_a_counted_run_computes_its_postings_once(spark):
    """Email and board come from one computation of what leads to them, and the counters count it once."""
    from postlake.operators.stats import Counters
    from postlake.samples import jobs
    from postlake.sources.tables import empty

    rows, read = jobs(spark, "/root/testdata/sf0.001").limit(400), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    sent, failed = (spark.createDataFrame([("x",)], f"{c} string") for c in ("seen_id", "company"))
    counters = Counters()
    day = daily.run(rows.mapInArrow(seen, rows.schema), empty(spark, STATE["matched"]), sent, failed, "1998-08-01", counters=counters)
    kinds = {r["kind"]: r["count"] for r in daily.outputs(day).groupBy("kind").count().collect()}
    day.matched.unpersist()
    assert read.value == 400 == counters.read()["fetched"]
    assert kinds.get("board", 0) == counters.read()["board"] > 0 and kinds.get("email", 0) == counters.read()["new"]


def test_a_counted_run_is_stored_before_it_is_read(spark):
    """Readers of an unfilled store start together, and on a cluster two executors then compute and count the same part."""
    from postlake.operators.stats import Counters
    from postlake.samples import jobs
    from postlake.sources.tables import empty

    sent, failed = (spark.createDataFrame([("x",)], f"{c} string") for c in ("seen_id", "company"))
    stored = lambda: {i.id(): (i.numCachedPartitions(), i.numPartitions()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    before, counters = stored(), Counters()
    day = daily.run(jobs(spark, "/root/testdata/sf0.001"), empty(spark, STATE["matched"]), sent, failed, "1998-08-01", counters=counters)
    kept = [whole for i, whole in stored().items() if i not in before]
    merged = day.merged.count()
    daily.outputs(day).write.format("noop").mode("overwrite").save()
    day.matched.unpersist()
    assert len(kept) == 1 and kept[0][0] == kept[0][1] > 0
    assert counters.read()["merged"] == merged > 0

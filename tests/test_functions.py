import pytest
from pyspark.sql import functions as F

from postlake.functions.dates import iso_date, relative_date
from postlake.functions.identity import is_listing_site, merge_key, page_mentions, seen_id, site_verdict
from postlake.functions.places import is_israel
from postlake.functions.profile import profiled
from postlake.functions.relevance import classify
from postlake.functions.text import shorten, strip_html

JOB = "company string, title string, location string, country_code string, url string, posted_date string, ats_platform string, job_id string, description string, _ord long"


def job(spark, *rows):
    blank = dict(company="", title="", location="", country_code="", url="", posted_date="", ats_platform="", job_id="", description="", _ord=0)
    return spark.createDataFrame([tuple((blank | r).values()) for r in rows], JOB)


def one(df, *columns):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*columns).collect()]


def test_listing_sites(spark):
    yes = ["https://www.linkedin.com/jobs/view/1", "https://builtin.com/jobs?allLocations=true", "https://t.me/s/jobs", "www.getclera.com/co/x"]
    no = ["https://supplant.me/careers/", "https://www.supersmart.me/careers", "https://boards-api.greenhouse.io/v1/boards/x/jobs", "https://careers.example.com/", ""]
    assert one(spark.createDataFrame([(u,) for u in yes + no], "u string").coalesce(1), is_listing_site("u")) == [True] * 4 + [False] * 5


def test_the_country_by_code_and_by_text(spark):
    rows = [{"country_code": c} for c in (" il ", "ISR", "IS", "ISL")] + [{"location": x} for x in ("Nes Ziona", "New York")]
    assert one(job(spark, *rows).coalesce(1), is_israel()) == [True, True, False, False, True, False]


@pytest.mark.parametrize("wanted", ["accept", "reject"])
def test_titles_without_a_model(spark, wanted):
    titles = {
        "accept": ["Senior Data Analyst", "Analytics Team Lead", "Data Scientist, Product Analytics"],
        "reject": ["Junior Data Analyst", "Senior Software Engineer", "Senior Machine Learning Engineer", "Senior Security Analyst", "Senior Financial Analyst"],
    }[wanted]
    assert set(one(job(spark, *({"title": t} for t in titles)), classify()["decision"])) == {wanted}


def test_a_bare_data_scientist_needs_evidence(spark):
    models = {"title": "Senior Data Scientist", "description": "Requirements: train deep learning models in PyTorch, deploy neural networks, feature engineering."}
    analysis = {"title": "Senior Data Scientist", "description": "Requirements: A/B tests, dashboards, SQL, stakeholders, business metrics, analytics."}
    assert one(job(spark, models, analysis).coalesce(1), classify()["decision"]) == ["reject", "accept"]


def test_sites_of_companies(spark):
    good = [
        ("Texas Instruments", "https://careers.ti.com/"), ("General Motors", "https://search-careers.gm.com/"), ("Central Bottling Company Israel", "https://www.cbccom.com/"),
        ("Quantum Source", "https://www.qs-labs.com/"), ("AWS", "https://www.amazon.jobs/"), ("Nebius", "https://careers.nebius.com/"), ("Wix", "https://boards.greenhouse.io/wix"),
        ("Teva Pharmaceutical", "https://www.tevapharm.com/x"), ("Sproutt", "https://sprout.careers/"), ("Pliops", "https://pliops.com/careers"),
    ]
    foreign = [
        ("FairFly", "https://fireflyspace.com/careers"), ("Ironblocks", "https://www.fireblocks.com/careers"), ("COTI", "https://jobs.citi.com/"), ("1MRobotics", "https://careers.micron.com/"),
        ("L7 Defense", "https://search-careers.gm.com/"), ("factify", "https://duckduckgo.com/?q=x"), ("Tamar Robotics", "https://arberobotics.com/career/"), ("RADLogics", "https://www.rad.com/career/"), ("Noogata", "https://www.nooga.net/career"),
    ]
    got = one(spark.createDataFrame(good + foreign, "c string, u string").coalesce(1), "c", site_verdict("c", "u"))
    assert [c for c, v in got if v == "mismatch"] == [c for c, _ in foreign]


def test_pages_that_name_a_company(spark):
    rows = [("Tamar Robotics", "<p>Tamar Robotics is hiring</p>"), ("Tamar Robotics", "<p>Arbe Robotics careers</p>"), ("RADLogics", "<h1>RAD Data Communications</h1>")]
    assert one(spark.createDataFrame(rows, "c string, p string").coalesce(1), page_mentions("c", "p")) == [True, False, False]


def test_keys(spark):
    rows = [{"company": "Acme Ltd.", "title": "Data  Analyst!", "ats_platform": "lever", "job_id": "7", "url": "u"}, {"company": "ACME", "title": "data analyst", "ats_platform": "scrape", "url": "https://x"}]
    df = job(spark, *rows).coalesce(1)
    assert len(set(one(df, merge_key()))) == 1
    assert one(df, seen_id()) == ["lever:7", "scrape:https://x"]


def test_dates(spark):
    rows = spark.createDataFrame([("2026-08-03T10:00:00Z",), ("August 3, 2026",), ("soon",), ("",), (None,)], "d string").coalesce(1)
    assert one(rows, iso_date("d")) == ["2026-08-03", "2026-08-03", "", "", ""]
    rows = spark.createDataFrame([("Posted Today",), ("yesterday",), ("3 days ago",), ("nonsense",), (None,)], "d string").coalesce(1)
    assert one(rows, relative_date("d", F.lit("2026-08-10"))) == ["2026-08-10", "2026-08-09", "2026-08-07", "", ""]


def test_texts(spark):
    rows = spark.createDataFrame([("<p>One &amp; two</p><ul><li>three</li></ul>",), (None,)], "t string").coalesce(1)
    first, second = one(rows, strip_html("t"))
    assert first.startswith("One & two") and "• three" in first and not second
    assert one(spark.createDataFrame([("a fairly long line of words",)], "t string"), F.length(shorten("t", 12)) <= 12) == [True]


def test_profiles(spark):
    text = "Requirements: 5+ years of experience with SQL, Python and Tableau. BSc in Computer Science required."
    (p,) = one(profiled(job(spark, {"title": "Senior Data Analyst", "description": text})), F.col("profile"))
    assert {s["name"] for s in p["skills"]} >= {"SQL", "Python", "Tableau"} and p["years"] == 5 and p["family"] == "Data Analyst" and p["track"] == "IC"
    assert (p["degree"]["level"], p["degree"]["status"], p["degree"]["fields"]) == ("BSc", "required", ["CS"])
    (empty,) = one(profiled(job(spark, {})), F.col("profile"))
    assert empty["skills"] == [] and empty["years"] is None and empty["degree"] is None and empty["family"] == "Other"


def test_patterns_run_once_a_text_and_only_where_they_can_match(spark):
    """Plain searches look into groups; of a bullet each task group is counted once; parts equal but for case stay once, the first."""
    from postlake.functions import lexicons as L
    from postlake.functions import sections as S
    from postlake.functions.profile import task_of
    from postlake.functions.text import hints, matches

    assert hints(r"(?i)(?:defin|own)\w*x?(?:kpis?)|(z)?(ab|cd+)\s*:?") == ("defin", "own", "ab", "cd")
    assert hints(r"(?:ab)?(c|d)") == hints(r"(?=ab)c") == ()
    assert str(task_of(F.col("b"))).count("regexp_count") == len(L.TASK_GROUPS)
    rows = spark.createDataFrame([("What we offer: REQUIREMENTS",), ("nothing",), ("",), (None,)], "d string")
    for pattern in (L.REQUIREMENTS, L.SECTION_END, L.PLUS_SECTION, L.DUTIES, L.AI_MENTION):
        assert all(a == b for a, b in rows.select(matches(F.col("d"), pattern), matches(F.col("d"), pattern, F.lower("d"))).collect() if b is not None)
    parts = F.array(*map(F.lit, ("Ab", "c", "aB", "C", "é", "É")))
    assert spark.range(1).select(S._once(parts)).first()[0] == ["Ab", "c", "é"]


def test_a_level_is_read_once(spark):
    """A chip's number and a company's words are found once, however many rules look at them."""
    from postlake.functions import sections as S

    for made in (S.level(F.col("c"), "t"), S.level_rank(F.col("c"))):
        assert str(made).count("regexp_extract") == 1
    assert str(S.company_blurb("d", F.col("n"))).count("regexp_extract") == 2
    rows = spark.createDataFrame([("8+ yrs", ""), ("3+ yrs", "Senior"), ("Senior", ""), ("", "x"), (None, None)], "c string, t string")
    assert [tuple(r) for r in rows.select(S.level(F.col("c"), "t"), S.level_rank(F.col("c"))).collect()] == [("Lead+", 6), ("Senior", 5), ("Senior", 5), ("—", 99), ("—", 99)]

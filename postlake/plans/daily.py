"""The daily run: from raw responses to state, windows and outputs, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.dates import is_iso
from ..functions.identity import is_agency, is_listing_site
from ..functions.places import city, is_israel
from ..functions.profile import profiled, soft_skills
from ..functions.relevance import classify
from ..functions.sections import age_note, employment, experience_chip, level, level_rank, sections
from ..functions.text import shorten, text
from ..operators.dedup import freshest, merge_duplicates
from ..operators.state import unsent, upsert_matched
from ..operators.stats import Counters
from ..sources.payloads import lost


@dataclass(frozen=True)
class Run:
    """Lazy results of a day; write `matched` before reading others repeatedly."""

    accepted: DataFrame
    merged: DataFrame
    matched: DataFrame
    email: DataFrame
    board: DataFrame


def scannable(registry: DataFrame) -> DataFrame:
    """Registry rows worth a scan: no agencies, no listing sites posing as a company's page."""
    posing = (F.lower(F.trim("ats_platform")) == "scrape") & is_listing_site("api_url")
    return registry.where(~is_agency("company_name") & ~F.coalesce(posing, F.lit(False)))


def classified(jobs: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """Postings in the country with their decision under `class`. Verdicts (title_key, verdict) settle ambiguous ones.

    Cheap tests come first: the place by code, then by text, and only then the title and description.
    """
    here = jobs.where(is_israel())
    if verdicts is None:
        return here.withColumn("class", classify())
    key = F.concat_ws("|", F.lower(F.trim(text("company"))), F.lower(F.trim(text("title"))))
    cached = verdicts.groupBy("title_key").agg(F.max_by("verdict", "updated").alias("_v"))
    return here.withColumn("title_key", key).join(cached, "title_key", "left").withColumn("class", classify(cached=F.col("_v"))).drop("_v", "title_key")


def posted_since(cut: Column) -> Column:
    """Whether a posting's date, or else the day it was first seen, is in the window."""
    return F.when(is_iso(F.substring(text("posted_date"), 1, 10)), F.substring("posted_date", 1, 10) >= cut).otherwise(F.coalesce(F.col("first_seen") >= cut, F.lit(False)))


def days_before(run_date: str, n: int) -> Column:
    return F.date_format(F.date_sub(F.to_date(F.lit(run_date)), n), "yyyy-MM-dd")


def board_rows(matched: DataFrame, failed: DataFrame, run_date: str, days: int = 14, cap: int = 8) -> DataFrame:
    """Openings of the window that are still alive (seen since yesterday, or of a company that failed today), capped per company."""
    down = failed.select("company").distinct().withColumn("_down", F.lit(True))
    alive = (F.col("last_seen") >= days_before(run_date, 1)) | F.col("_down")
    rows = matched.where(posted_since(days_before(run_date, days))).join(down, "company", "left").where(F.coalesce(alive, F.lit(False))).drop("_down")
    return freshest(rows, cap)


#: How a decision can have come about.
PATHS = ("keyword", "keyword_nollm", "llm_cache", "llm", "llm_failed_fallback")


def run(jobs: DataFrame, matched: DataFrame, sent: DataFrame, failed: DataFrame, run_date: str, verdicts: DataFrame | None = None, counters: Counters | None = None) -> Run:
    """The day's results. With `counters`, an action on `outputs` counts fetched, matched, paths, accepted, merged, new and board.

    Email and board read different columns of `matched`, so Spark would compute all before them twice. With `counters` it is
    computed here and kept on the executors' disks; unpersist it afterwards. One job of its own fills that store: the readers
    of an empty one start together, and executors that each compute the same part would count it each.
    """
    count = (counters.on if counters is not None else lambda df, **_: df)
    every = F.count(F.lit(1))
    here = count(classified(count(jobs, fetched=every), verdicts), matched=every, **{f"path_{p}": F.count_if(F.col("class.path") == p) for p in PATHS})
    accepted = count(here.where("class.decision = 'accept'").withColumn("seniority", F.col("class.seniority")), accepted=every)
    merged = count(merge_duplicates(accepted.drop("class")), merged=every)
    after = upsert_matched(matched, merged, run_date)
    if counters is not None:
        after = after.persist(StorageLevel.DISK_ONLY)
        after.count()
    today = after.where((F.col("last_seen") == run_date) & posted_since(days_before(run_date, 1)))
    email, board = count(freshest(unsent(today, sent), 3), new=every), count(board_rows(after, failed, run_date), board=every)
    return Run(accepted, merged, after, email, board)


def outputs(day: Run) -> DataFrame:
    """Email and board in one table (`kind`), so that one execution writes both."""
    return day.email.withColumn("kind", F.lit("email")).unionByName(day.board.withColumn("kind", F.lit("board")))


def counted_responses(found: DataFrame, counters: Counters) -> DataFrame:
    """`responses` that count companies scanned and failed on their first pages."""
    first = F.col("page_no") == 0
    return counters.on(found, scanned=F.count_if(first), failed=F.count_if(first & lost()))


def board_view(board: DataFrame, run_date: str) -> DataFrame:
    """The data behind a board, a row for each opening: place, profile, level, flags, parts of the description, search text.

    `level_rank` and `degree_rank` sort by level and degree, unknown ones last and first. The search text `blob` holds, in
    lower case, names and place, family, skills, and the tokens of tasks, soft skills, AI and degree.
    """
    posted = F.col("posted_date").try_cast("date")
    age = F.datediff(F.to_date(F.lit(run_date)), F.coalesce(posted, F.col("first_seen").try_cast("date")))
    reposted = F.coalesce(F.datediff(posted, F.col("first_seen").try_cast("date")) >= 3, F.lit(False))
    flag = F.when(reposted, "reposted").when(age <= 1, "new").when(age >= 60, "60+ days").when(age >= 45, "45+ days").otherwise("")
    rows = profiled(board).withColumn("city", city("location")).withColumn("soft", soft_skills(F.col("description"))).withColumn("_s", sections("description")).withColumn("chip", experience_chip("description"))
    degrees = F.array(*(F.lit(name) for name, _ in reversed(L.DEGREE_LEVELS)))
    tokens = lambda c: F.array_join(F.transform(c, lambda t: t["token"]), " ")
    words = ("company", "title", "city", "profile.family", F.array_join("profile.skills.name", " "), tokens("_s.tasks"), tokens("soft"), tokens("_s.ai_asked"), tokens("_s.ai_daily"), "profile.degree.level")
    return rows.select(
        "mkey", "company", "title", "city", "url", "posted_date", "first_seen", flag.alias("flag"), "profile", "soft", shorten("description", 280).alias("summary"), F.lower(F.concat_ws(" ", *words)).alias("blob"),
        "chip", level(F.col("chip"), "title").alias("level"), level_rank(F.col("chip")).alias("level_rank"), employment("title").alias("employment"), age_note("posted_date", run_date).alias("age_note"),
        F.coalesce(F.array_position(degrees, F.col("profile.degree.level")), F.lit(0).cast("bigint")).alias("degree_rank"), *(F.col(f"_s.{c}").alias(c) for c in ("requirements", "duties", "tasks", "ai_asked", "ai_daily")),
    )

"""What a run hands over: ordered listings, digests as text, and the payload for whoever sends them.

Listings are DataFrames; a digest's lines are aggregated per company on Spark and joined in order, one company per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.places import city
from ..functions.sections import about, age_note, experience_chip
from ..functions.text import html_escape, markdown_escape, safe_url, text

PAYLOAD = ("company", "title", "location", "url", "posted_date", "sources", "seen_ids", "first_seen")
#: How decision paths are named to readers.
PATHS = (("keyword", "keyword"), ("keyword_nollm", "keyword(no-llm)"), ("llm", "LLM"), ("llm_cache", "LLM(cached)"), ("llm_failed_fallback", "LLM-failed→fallback"))


def matched_since(matched: DataFrame, cutoff: str) -> DataFrame:
    """Openings first seen on or after a day, newest first, then by posted date; ties by key."""
    return matched.where(F.col("first_seen") >= cutoff).orderBy(F.desc("first_seen"), F.desc("posted_date"), "mkey")


def for_mail(jobs: DataFrame) -> DataFrame:
    """Companies by their freshest posting, and within them the freshest first; ties by name and key."""
    posted = text("posted_date")
    fresh = F.max(posted).over(Window.partitionBy("company"))
    return jobs.withColumn("_fresh", fresh).orderBy(F.desc("_fresh"), "company", F.desc(posted), "mkey").drop("_fresh")


def for_digest(jobs: DataFrame) -> DataFrame:
    """Companies by name, within them the freshest first."""
    return jobs.orderBy("company", F.desc(text("posted_date")), "mkey")


def for_board(jobs: DataFrame) -> DataFrame:
    """The freshest first, undated ones last."""
    return jobs.orderBy(F.desc(text("posted_date")), "mkey")


def by_size(groups: DataFrame) -> DataFrame:
    """Groups of an axis, those with most jobs first."""
    return groups.orderBy("axis", F.desc("jobs"), "value")


def payload(jobs: DataFrame, run_date: str, subject: str, summary: dict[str, int]) -> DataFrame:
    """One row of JSON text per opening, each with the run it belongs to: run_date, subject, summary and the opening's fields."""
    totals = F.struct(*(F.lit(v).alias(k) for k, v in summary.items()))
    return jobs.select(F.to_json(F.struct(F.lit(run_date).alias("run_date"), F.lit(subject).alias("subject"), totals.alias("summary"), F.struct(*PAYLOAD).alias("job"))).alias("value"))


def subject(n: int, run_date: str) -> str:
    return f"{n} new senior analytics opening{'' if n == 1 else 's'} — {run_date}"


def path_label(path: Column) -> Column:
    return F.coalesce(*(F.when(path == k, F.lit(v)) for k, v in PATHS), path, F.lit("?"))


def _grouped(jobs: DataFrame, line: Column, head: Column, *keep: Column) -> DataFrame:
    """company, fresh, block: a heading and the lines of each company, the freshest posting first."""
    posted = text("posted_date")
    lines = F.transform(F.array_sort(F.collect_list(F.struct(posted.alias("p"), F.col("mkey").alias("k"), line.alias("line"))), lambda a, b: F.when(a["p"] > b["p"], -1).when(a["p"] < b["p"], 1).when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)), lambda x: x["line"])
    rows = jobs.groupBy("company").agg(F.max(posted).alias("fresh"), lines.alias("lines"), *keep)
    return rows.select("company", "fresh", F.concat_ws("\n", head, F.array_join("lines", "\n")).alias("block"))


def _dash(c: str) -> Column:
    return F.coalesce(F.nullif(text(c), F.lit("")), F.lit("—"))


def text_digest(jobs: DataFrame) -> DataFrame:
    """company, block of plain text, in order of company names."""
    sources = F.array_join("sources", "+")
    line = F.concat(F.lit("  • "), text("title"), F.lit("\n      "), _dash("location"), F.lit(" | posted "), _dash("posted_date"), F.lit(" | via "), sources, F.lit(" | match:"), path_label(F.col("path")), F.lit("\n      "), text("url"))
    head = F.concat(F.col("company"), F.lit("\n"), F.repeat(F.lit("-"), F.length("company")))
    return _grouped(jobs, line, head).select("company", "block").orderBy("company")


def html_digest(jobs: DataFrame) -> DataFrame:
    """company, block of HTML, in order of company names; every text is escaped and only web addresses become links."""
    url = html_escape(safe_url("url"))
    title = F.when(url != "", F.concat(F.lit('<a href="'), url, F.lit('">'), html_escape("title"), F.lit("</a>"))).otherwise(html_escape("title"))
    rest = F.concat(html_escape(_dash("location")), F.lit(" · posted "), html_escape(_dash("posted_date")), F.lit(" · via "), html_escape(F.array_join("sources", "+")), F.lit(" · match: "), html_escape(path_label(F.col("path"))))
    line = F.concat(F.lit("<li>"), title, F.lit("<br>"), rest, F.lit("</li>"))
    return _grouped(jobs, line, F.concat(F.lit("<h3>"), html_escape("company"), F.lit("</h3>"))).select("company", "block").orderBy("company")


def markdown_digest(jobs: DataFrame, run_date: str) -> DataFrame:
    """company, block of Markdown, companies with the freshest posting first. Jobs may bring `about_static` and `about_cached`."""
    given = lambda c: F.first(c, ignorenulls=True) if c in jobs.columns else F.lit(None).cast("string")
    url, chip = safe_url("url"), experience_chip("description")
    named = F.concat(F.lit("**"), markdown_escape(F.concat(text("title"), F.when(text("title").rlike("[֐-׿]"), " (Hebrew)").otherwise(""))), F.lit("**"))
    head = F.when(url != "", F.concat(named, F.lit(" — "), url)).otherwise(named)
    note = age_note("posted_date", run_date)
    dated = F.concat(_dash("posted_date"), F.when(note != "", F.concat(F.lit(" · "), note)).otherwise(""))
    line = F.concat(F.lit("- "), head, F.lit(" · "), F.concat_ws(" · ", city("location"), dated, F.nullif(chip, F.lit(""))))
    said = F.min_by(text("description"), F.col("mkey"))
    # the heading needs what the group says of itself, so it is put before the lines afterwards
    rows = _grouped(jobs, line, F.lit(None).cast("string"))
    heads = jobs.groupBy("company").agg(said.alias("d"), given("about_static").alias("s"), given("about_cached").alias("c"))
    blurb = about(F.col("s"), F.col("c"), "d", F.col("company"))
    opening = F.concat(F.lit("### "), markdown_escape("company"), F.when(blurb != "", F.concat(F.lit("\n_"), blurb, F.lit("_"))).otherwise(""), F.lit("\n\n"))
    out = rows.join(heads, "company").select("company", "fresh", F.concat(opening, F.col("block")).alias("block"))
    return out.orderBy(F.desc("fresh"), "company").select("company", "block")


def axes_json(axes: DataFrame, jobs: int) -> DataFrame:
    """One row of JSON text per value of an axis, with the number of jobs analysed."""
    return axes.select(F.to_json(F.struct(F.lit(jobs).alias("jobs_analyzed"), *axes.columns)).alias("value"))


def axes_markdown(axes: DataFrame) -> DataFrame:
    """axis, jobs, line: one row of a Markdown table per value, those with most jobs first; needs `top_skills`."""
    top = F.array_join(F.transform(F.slice(F.coalesce("top_skills", F.array().cast("array<struct<skill:string,n:bigint>>")), 1, 5), lambda s: s["skill"]), ", ")
    cells = ["value", "companies", "jobs", F.coalesce(F.col("median_years").cast("string"), F.lit("—")), "degree_required_rate", "lead_share", "ai_mention_rate", top]
    return by_size(axes.select("axis", "value", "jobs", F.concat(F.lit("| "), F.concat_ws(" | ", *(c if isinstance(c, Column) else F.col(c).cast("string") for c in cells)), F.lit(" |")).alias("line")))

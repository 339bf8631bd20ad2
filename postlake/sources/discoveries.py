"""Postings found outside company boards: records of job searches, and posts of channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.dates import day, iso
from ..functions.text import computed, first_filled, let, text, unescape
from .tables import order

_LINK = r"""https?://[^\s"'<>]+"""
_MESSAGE = r'(?s)data-post="([^"/]+)/(\d+)".*?tgme_widget_message_text[^>]*>(.*?)</div>.*?<time datetime="([^"]+)"'


def discovery_date(c: Column | str, run_date: Column | str, most_days: int = 21) -> Column:
    """ISO text of a date or of days ago; empty if unknown, null for what is too old or only said to be older ('30+ days')."""
    s = text(c)
    n = F.regexp_extract(s, r"(?i)(\d+)\+?\s*(?:days?|ימים|ימי)", 1).try_cast("int")
    return (
        F.when((F.length(s) >= 10) & (F.substring(s, 5, 1) == "-"), F.substring(s, 1, 10)).when(n.isNull(), "")
        .when(s.contains("+") | (n > most_days), F.lit(None)).otherwise(iso(F.date_sub(day(run_date), n)))
    )


def searched_postings(records: DataFrame, source: str, run_date: Column | str) -> DataFrame:
    """Search records (JSON text in `record`, order in `_ord`) as postings; stale, untitled, nameless and junior ones go.

    Sources name their fields differently; the first filled name counts. A record that doesn't parse is none.
    """
    names = "job_title title company_name company job_location location apply_link url job_url job_posted_date date_posted posted_date job_summary job_description description".split()
    r = lambda *options: first_filled(*(F.col(f"r.{n}") for n in options))
    rows = records.select("_ord", F.from_json("record", "struct<" + ",".join(f"{n}:string" for n in names) + ">").alias("r")).where("r is not null")
    title, company, url, body = r("job_title", "title"), r("company_name", "company"), r("apply_link", "url", "job_url"), r("job_summary", "job_description", "description")
    location = F.coalesce(F.nullif(r("job_location", "location"), F.lit("")), F.lit("Israel"))
    posted = discovery_date(r("job_posted_date", "date_posted", "posted_date"), run_date)
    head = F.lower(F.substring(F.concat(title, F.lit(" "), text("r.job_summary")), 1, 400))
    junior = F.exists(F.array(*map(F.lit, L.JUNIOR_POSTS)), lambda w: head.contains(w))
    return rows.where((title != "") & (company != "") & posted.isNotNull() & ~junior).select(
        F.substring(company, 1, 80).alias("company"), F.substring(title, 1, 140).alias("title"), F.substring(location, 1, 80).alias("location"), F.lit("IL").alias("country_code"), url.alias("url"),
        posted.alias("posted_date"), F.lit(f"discovery-{source}").alias("ats_platform"), F.when(url != "", url).otherwise(F.concat_ws("|", company, title)).alias("job_id"),
        F.regexp_replace(F.substring(body, 1, 6000), "<[^>]+>", " ").alias("description"), order("_ord").alias("_ord"),
    )


def post_lines(body: Column | str) -> Column:
    """array<string> of a post's HTML: its lines, without invisible signs and blank ones."""
    plain = unescape(F.regexp_replace(F.regexp_replace(text(body), r"<br\s*/?>", "\n"), "<[^>]+>", ""))
    bare = lambda x: F.trim(F.regexp_replace(F.trim(x), "^[ㅤ​﻿]+|[ㅤ​﻿]+$", ""))
    return F.filter(F.transform(F.split(plain, "\n"), bare), lambda x: x != "")


def channel_messages(pages: DataFrame) -> DataFrame:
    """channel, id, body, posted of the messages in channel pages (`html`)."""
    rows = pages.select(F.explode(F.regexp_extract_all(text("html"), F.lit(_MESSAGE), F.lit(0))).alias("m"))
    part = lambda k: F.regexp_extract("m", _MESSAGE, k)
    return computed(rows, channel=part(1), id=part(2).cast("bigint"), body=part(3), posted=part(4)).drop("m")


def channel_postings(messages: DataFrame) -> DataFrame:
    """Postings in messages (channel, id, body, posted): title, company and city on the first lines, a link below.

    A line `--` ends the message; a date may follow the city. What has no link, is too long, or is the channel's own
    summary is no posting.
    """
    before = lambda lines: let(F.array_position(lines, "--"), lambda end: F.when(end > 0, F.slice(lines, F.lit(1), end.cast("int") - 1)).otherwise(lines))
    rows = computed(messages, l=let(post_lines("body"), before)).where(F.size("l") >= 4)
    rest = F.slice("l", F.when(F.get("l", F.lit(3)).rlike(r"^\d{1,2}/\d{1,2}/\d{2}"), 5).otherwise(4), F.size("l"))
    first = lambda a: F.coalesce(F.try_element_at(a, F.lit(1)), F.lit(""))
    rows = computed(rows, rest=rest)
    rows = computed(rows, url=first(F.filter(F.transform("rest", lambda x: F.regexp_extract(x, _LINK, 0)), lambda x: x != "")))
    # the line that gave the link is neither skills nor level
    linked = F.array_position(F.transform("rest", lambda x: x.rlike(_LINK)), True)
    others = F.filter(F.transform("rest", lambda x, i: F.when(i + 1 != linked, x)), lambda x: x.isNotNull())
    rows = computed(computed(rows, others=others), skills=first(F.filter("others", lambda x: x.contains(","))))
    short = F.filter("others", lambda x: (~x.contains(",") | (x != F.col("skills")) & x.contains(",")) & (F.size(F.split(x, r"\s+")) <= 3) & ~x.rlike(_LINK))
    title, company, city = F.get("l", F.lit(0)), F.trim(F.replace(F.get("l", F.lit(1)), F.lit("(.)"), F.lit("."))), F.get("l", F.lit(2))
    rows = computed(rows, title=title, company=company)
    title, company = F.col("title"), F.col("company")
    own = F.rtrim(title).endswith(":") | title.rlike("(?i)jobs posted|weekly digest")
    kept = rows.where((F.col("url") != "") & (F.length(title) <= 120) & (F.length(company) <= 60) & ~own)
    link = F.substring_index("url", "?", 1)
    return kept.select(
        "channel", "id", F.substring(company, 1, 80).alias("company"), F.substring(title, 1, 140).alias("title"), F.substring(F.concat(city, F.lit(", Israel")), 1, 80).alias("location"),
        F.lit("IL").alias("country_code"), link.alias("url"), F.substring("posted", 1, 10).alias("posted_date"), F.lit("discovery-telegram").alias("ats_platform"), link.alias("job_id"),
        F.concat(F.lit("Skills: "), F.col("skills"), F.lit(". Seniority: "), first(short), F.lit(".")).alias("description"), order("id", F.crc32("channel")).alias("_ord"),
    )

"""Dates as ISO text, as postings carry them; the empty string is unknown. `run_date` is a Column or ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import text

_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy")


def day(run_date: Column | str) -> Column:
    return F.to_date(F.lit(run_date)) if isinstance(run_date, str) else run_date.cast("date")


def iso(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit(""))


def iso_date(c: Column | str) -> Column:
    """Date of ISO-like or English date text; otherwise its first ten characters if the fifth is a dash."""
    s = F.trim(F.replace(F.replace(F.replace(F.trim(text(c)), F.lit("Z"), F.lit("")), F.lit(" UTC"), F.lit("")), F.lit("T"), F.lit(" ")))
    s = F.trim(F.split(s, r"\.")[0])
    fixed = F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$|^[A-Za-z]+ \d{1,2}, \d{4}$|^\d{1,2} [A-Za-z]+ \d{4}$|^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?$"), s)
    parsed = F.coalesce(*(F.to_date(F.try_to_timestamp(fixed, F.lit(f))) for f in _FORMATS))
    rough = F.when((F.length(s) >= 10) & (F.substring(s, 5, 1) == "-"), F.substring(s, 1, 10)).otherwise("")
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), rough)


def epoch_date(c: Column, per_second: int = 1000) -> Column:
    """UTC date of epoch milliseconds (or seconds, with 1); the empty string if it is no number."""
    return iso(F.to_date(F.timestamp_millis((c.try_cast("bigint") * F.lit(1000 // per_second)).cast("bigint"))))


def guessed_epoch_date(c: Column) -> Column:
    """As epoch_date; numbers above 1e11 are milliseconds, others seconds."""
    n = c.try_cast("bigint")
    return iso(F.to_date(F.timestamp_seconds(F.when(n > 100_000_000_000, F.floor(n / 1000)).otherwise(n))))


def relative_date(c: Column | str, run_date: Column | str, most_days: int | None = None) -> Column:
    """Today, yesterday, N days or N months (of 30 days) ago as ISO text, ISO prefixes as they are; else the empty string.

    "Just posted" and "just now" are today; "posted N", cut off before its unit, counts days up to 365.

    With `most_days`, null for text with a plus sign or for more days ago: such rows are to be dropped.
    """
    s, today = F.lower(F.trim(text(c))), day(run_date)
    n = F.regexp_extract(s, r"(\d+)\s*\+?\s*(?:day|month|ימים|יום|חודש)", 1).try_cast("int")
    ago = F.when(s.rlike(r"\d+\s*\+?\s*(?:month|חודש)"), n * 30).otherwise(n)
    bare = F.regexp_extract(s, r"^posted\s+(\d+)", 1).try_cast("int")
    plain = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(s, 1, 10)).when(s.rlike("today|just posted|just now|היום"), iso(today)).when(s.rlike("yesterday|אתמול"), iso(F.date_sub(today, 1))).when(ago.isNotNull(), iso(F.date_sub(today, ago))).when(bare <= 365, iso(F.date_sub(today, bare))).otherwise("")
    if most_days is None:
        return plain
    return F.when(s.contains("+") | F.coalesce(ago > most_days, F.lit(False)), F.lit(None)).otherwise(plain)


def is_iso(c: Column | str) -> Column:
    return text(c).rlike(r"^\d{4}-\d{2}-\d{2}$")

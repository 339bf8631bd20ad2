"""Joins of postings with what is known about companies, and merges of caches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import bucket_bounds, identity_key, is_agency, looks_like_junk, size_band
from ..functions.text import squeeze, text
from ..sources.tables import FIRMOGRAPHICS

STAGES = ("public", "acquired-by-bigtech", "growth-private", "early-private", "private-enterprise")


def firmographics(stored: DataFrame, run_date: str) -> DataFrame:
    """company and a checked record: unreadable ones are skipped, those without a sector dropped, bad values emptied.

    The size band always follows from the number of employees where there is one.
    """
    r = F.from_json("record", FIRMOGRAPHICS)
    rows = stored.withColumn("r", r).where("r is not null")
    plain = lambda c: F.substring(squeeze(F.col(f"r.{c}")), 1, 300)
    number = lambda c, low, high: F.when(F.col(f"r.{c}").try_cast("double").cast("int").between(low, high), F.col(f"r.{c}").try_cast("double").cast("int"))
    count = number("employees_global", 1, 5_000_000)
    band = F.coalesce(size_band(count), F.when(F.upper(plain("size_band")).isin("S", "M", "L", "XL"), F.upper(plain("size_band"))), F.lit(""))
    stage = F.when(plain("stage").isin(*STAGES), plain("stage")).otherwise("")
    out = rows.select(
        "company", "updated", plain("sector").alias("sector"), plain("sub_sector").alias("sub_sector"), stage.alias("stage"), band.alias("size_band"), count.alias("employees_global"),
        number("founded", 1600, int(run_date[:4])).alias("founded"), plain("business_model").alias("business_model"), plain("customer_type").alias("customer_type"), plain("as_of").alias("as_of"),
    )
    return out.where("sector <> ''")


def with_companies(jobs: DataFrame, companies: DataFrame, order: str = "updated") -> DataFrame:
    """Postings with their company's record under `firm`: by exact name, else by identity (the latest of equal ones).

    Left joins; which side is broadcast is left to the optimizer's size estimates.
    """
    fields = [c for c in companies.columns if c != "company"]
    exact = companies.groupBy("company").agg(F.max_by(F.struct(*fields), order).alias("_exact"))
    alike = companies.groupBy(identity_key("company").alias("_id")).agg(F.max_by(F.struct(*fields), F.struct(order, "company")).alias("_alike"))
    # names without an identity match by name alone; each gets a key of its own, so that they make no hot one
    blank = F.concat(F.lit("\u0000"), F.xxhash64(*jobs.columns).cast("string"))
    keyed = jobs.withColumn("_id", F.coalesce(F.nullif(identity_key("company"), F.lit("")), blank)).join(exact, "company", "left").join(alike, "_id", "left")
    return keyed.withColumn("firm", F.coalesce("_exact", "_alike")).drop("_id", "_exact", "_alike")


def research_targets(names: DataFrame, known: DataFrame, failed: DataFrame, run_date: str, n: int = 20, refresh_days: int = 180, wait_days: int = 7, strikes: int = 4) -> DataFrame:
    """company, why (`new` or `refresh`): names to look up, one per identity, new ones first, then the stalest, at most n.

    Junk names are left out, as are names that failed lately or too often.
    """
    key = identity_key("company").alias("_id")
    day = F.to_date(F.lit(run_date))
    gated = failed.where((F.datediff(day, F.col("last").try_cast("date")) < wait_days) | (F.col("attempts") >= strikes)).select(key).distinct()
    wanted = names.select("company").distinct().where(~looks_like_junk("company")).withColumn("_id", identity_key("company")).join(gated, "_id", "left_anti")
    have = known.groupBy(key).agg(F.min(F.col("as_of").try_cast("date")).alias("as_of"), F.lit(True).alias("_have"))
    first = wanted.groupBy("_id").agg(F.min("company").alias("company")).join(have, "_id", "left")
    age = F.coalesce(F.datediff(day, "as_of"), F.lit(2**31 - 1))
    due = first.withColumn("why", F.when(F.col("_have").isNull(), "new").when(age > refresh_days, "refresh")).where("why is not null")
    return due.orderBy(F.col("why") != "new", F.desc(age), "company").limit(n).select("company", "why")


def missing_firms(board: DataFrame, known: DataFrame, failed: DataFrame, run_date: str, n: int = 5, wait_days: int = 7) -> DataFrame:
    """company: the board's companies without a record by name or identity, no junk names, none whose identity failed within
    `wait_days`; of spellings of one identity the first; the first n by name."""
    since = F.date_format(F.date_sub(F.to_date(F.lit(run_date)), wait_days), "yyyy-MM-dd")
    key = identity_key("company").alias("_id")
    gated = known.select(key).unionByName(failed.where(F.col("last") > since).select(key)).distinct()
    names = board.select("company").distinct().where(~looks_like_junk("company")).join(known.select("company").distinct(), "company", "left_anti")
    return names.withColumn("_id", key).join(gated, "_id", "left_anti").groupBy("_id").agg(F.min("company").alias("company")).orderBy("company").limit(n).select("company")


def company_texts(static: DataFrame, cached: DataFrame, generated: DataFrame) -> DataFrame:
    """company, summary: the curated text if it says anything, else the cached, else the generated one."""
    rows = [df.select("company", F.lit(i).alias("rank"), "summary") for i, df in enumerate((static, cached, generated))]
    both = reduce(DataFrame.unionByName, rows).where(text("summary") != "")
    return both.groupBy("company").agg(F.min_by("summary", F.struct("rank", "summary")).alias("summary"))


def refreshed(fresh: DataFrame, old: DataFrame, fields: list[str]) -> DataFrame:
    """Records field by field: what is newly found wins, the rest is kept; the band follows the count."""
    joined = fresh.alias("f").join(old.alias("o"), "company", "left")
    filled = [F.coalesce(F.nullif(F.col(f"f.{c}").cast("string"), F.lit("")), F.col(f"o.{c}").cast("string")).alias(c) for c in fields if c not in ("size_band", "employees_global")]
    count = F.coalesce("f.employees_global", "o.employees_global")
    return joined.select("company", *filled, count.alias("employees_global"), F.coalesce(size_band(count), "f.size_band", "o.size_band", F.lit("")).alias("size_band"))


def is_suspect(employees: Column, source: Column, bucket: Column, weak: Column) -> Column:
    """Whether an employee count from a profile page should be looked up again."""
    b = bucket_bounds(bucket)
    return (source == "linkedin") & (F.coalesce(weak, F.lit(False)) | (employees < 10) | F.coalesce((employees < b["lo"]) | (employees > 2 * b["hi"]), F.lit(False)))


def new_companies(found: DataFrame, *known: DataFrame) -> DataFrame:
    """Companies of `found` (company, _ord, …) that no known list has, agencies left out, the first row of each.

    known: one-column lists of names, compared without case and outer spaces.
    """
    key = F.lower(F.trim("company"))
    rows = found.where((F.trim(text("company")) != "") & ~is_agency("company")).withColumn("_k", key)
    for names in known:
        rows = rows.join(names.select(F.lower(F.trim(names.columns[0])).alias("_k")).distinct(), "_k", "left_anti")
    return rows.groupBy("_k").agg(F.min_by(F.struct(*found.columns), "_ord").alias("_r")).select("_r.*")


def merge_discovered(fresh: DataFrame, cache: DataFrame, run_date: str, days: int = 21) -> DataFrame:
    """This run's discoveries and those of the cache by company and title, this run's first; dated ones over `days` days old go.

    Old rows go before they are compared, so an expired fresh row hides no cached one.
    """
    cut = F.date_format(F.date_sub(F.to_date(F.lit(run_date)), days), "yyyy-MM-dd")
    young = (text("posted_date") == "") | (text("posted_date") >= cut)
    columns = [c for c in fresh.columns if c in cache.columns]
    both = fresh.select(*columns, F.lit(0).alias("_prev")).unionByName(cache.select(*columns, F.lit(1).alias("_prev"))).where(young)
    first = both.groupBy(F.lower("company").alias("_c"), F.lower("title").alias("_t")).agg(F.min_by(F.struct(*columns), F.struct("_prev", "_ord")).alias("_r"))
    return first.select("_r.*")


def append_new(cache: DataFrame, posts: DataFrame) -> DataFrame:
    """The cache and posts whose company and title it lacks; repeats among the posts stay."""
    keys = cache.select(F.lower("company").alias("_c"), F.lower("title").alias("_t")).distinct()
    fresh = posts.withColumn("_c", F.lower("company")).withColumn("_t", F.lower("title")).join(keys, ["_c", "_t"], "left_anti").drop("_c", "_t")
    return cache.unionByName(fresh.select(*cache.columns))


def merge_research(*files: DataFrame) -> DataFrame:
    """Research results of several files by name; one with a known platform beats an unknown one, then the first."""
    rows = reduce(DataFrame.unionByName, files)
    unknown = F.lower(text("ats")).isin("", "unknown")
    return rows.groupBy(F.lower(F.trim("name")).alias("_k")).agg(F.min_by(F.struct(*rows.columns), F.struct(unknown, F.col("_ord"))).alias("_r")).select("_r.*")


def archive(matched: DataFrame, board: DataFrame) -> DataFrame:
    """Openings matched at some time that the board no longer shows."""
    return matched.join(board.select("company", "title").distinct(), ["company", "title"], "left_anti")

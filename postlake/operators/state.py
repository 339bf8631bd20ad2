"""State that each run derives from the last: pure transforms of the old table and the day's rows into the new table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import is_iso
from ..functions.identity import is_division, size_band
from ..functions.lexicons import HIRING_HOSTS
from ..functions.text import text
from .enrich import is_suspect


def gap_days(now: Column | str, before: Column | str) -> Column:
    """Days between two ISO dates; 0 where either can't be read."""
    day = lambda c: F.expr(f"try_to_date({c})") if isinstance(c, str) else c.try_cast("date")
    return F.coalesce(F.datediff(day(now), day(before)), F.lit(0))


def unsent(merged: DataFrame, sent: DataFrame) -> DataFrame:
    """Openings none of whose postings was sent. Ids are joined, not gathered: no list grows with the table."""
    ids = merged.select("mkey", F.explode("seen_ids").alias("seen_id"))
    hit = ids.join(sent.select("seen_id"), "seen_id", "left_semi").select("mkey").distinct()
    return merged.join(hit, "mkey", "left_anti")


def mark_sent(sent: DataFrame, merged: DataFrame, run_date: str) -> DataFrame:
    """`sent` with every posting of `merged`: new ids are added, known ones only get a new last day."""
    fresh = merged.select(F.explode("seen_ids").alias("seen_id"), *(F.struct("company", "title", "location", "url").alias("n"),))
    fresh = fresh.groupBy("seen_id").agg(F.min("n").alias("n"))
    both = sent.join(fresh, "seen_id", "full_outer")
    keep = [F.coalesce(F.col(c), F.col(f"n.{c}")).alias(c) for c in ("company", "title", "location", "url")]
    return both.select("seen_id", *keep, F.coalesce("first_sent", F.lit(run_date)).alias("first_sent"), F.when(F.col("n").isNotNull(), F.lit(run_date)).otherwise(F.col("last_seen")).alias("last_seen"))


def upsert_matched(matched: DataFrame, merged: DataFrame, run_date: str, days: int = 3) -> DataFrame:
    """`matched` after a day's openings: one full outer join on `mkey`.

    A known opening keeps its company, title and, if it was seen at most `days` days ago, its first day; after a longer
    gap it counts as new. A date that is no ISO date never replaces one. Sources and ids are united.
    """
    old, new = matched.alias("o"), merged.alias("n")
    both = old.join(new, F.col("o.mkey") == F.col("n.mkey"), "full_outer")
    known, seen = F.col("o.mkey").isNotNull(), F.col("n.mkey").isNotNull()
    united = lambda c: F.array_sort(F.array_remove(F.array_union(F.coalesce(f"o.{c}", F.array().cast("array<string>")), F.coalesce(f"n.{c}", F.array().cast("array<string>"))), ""))
    dated = F.when(is_iso(F.col("o.posted_date")) & ~is_iso(F.col("n.posted_date")), F.col("o.posted_date")).otherwise(text(F.col("n.posted_date")))
    stays = known & (gap_days(F.lit(run_date), F.col("o.last_seen")) <= days)
    level = F.coalesce("n.seniority", F.lit("")) if "seniority" in merged.columns else F.lit("")
    latest = lambda c, fresh: F.when(seen, fresh).otherwise(F.col(f"o.{c}")).alias(c)
    return both.select(
        F.coalesce("o.mkey", "n.mkey").alias("mkey"), F.coalesce("o.company", "n.company").alias("company"), F.coalesce("o.title", "n.title").alias("title"),
        latest("location", F.col("n.location")), latest("url", F.col("n.url")), latest("posted_date", dated), latest("seniority", level),
        latest("sources", united("sources")), latest("seen_ids", united("seen_ids")), latest("description", F.substring(text(F.col("n.description")), 1, 6000)),
        latest("first_seen", F.when(stays, F.col("o.first_seen")).otherwise(F.lit(run_date))), latest("last_seen", F.lit(run_date)),
    )


def first_seen_from_history(sightings: DataFrame, key: str, day: str, days: int = 3) -> DataFrame:
    """Per key: first_seen of its last island of sightings (a gap over `days` days starts a new one) and last_seen.

    The same rule as upsert_matched, from all days at once. A key's days are distinct first, so the window sorts days,
    not rows.
    """
    daily = sightings.select(key, F.col(day).cast("date").alias("d")).where("d is not null").distinct()
    w = Window.partitionBy(key).orderBy("d")
    starts = F.coalesce(F.datediff("d", F.lag("d").over(w)) > days, F.lit(True))
    marked = daily.withColumn("start", F.when(starts, F.col("d")))
    return marked.groupBy(key).agg(F.max("start").alias("first_seen"), F.max("d").alias("last_seen"))


def save_latest(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Last write wins by key."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def record_failures(failures: DataFrame, failed: DataFrame, run_date: str) -> DataFrame:
    """One more attempt for each failed company."""
    both = failures.join(failed.select("company").distinct().withColumn("_f", F.lit(1)), "company", "full_outer")
    return both.select("company", (F.coalesce("attempts", F.lit(0)) + F.coalesce("_f", F.lit(0))).alias("attempts"), F.when(F.col("_f") == 1, F.lit(run_date)).otherwise(F.col("last")).alias("last"))


def revoke_failures(failures: DataFrame, revoked: DataFrame, run_date: str) -> DataFrame:
    """Undo today's attempt: a single one goes, of several one is taken back and retried after the usual wait."""
    flagged = failures.join(revoked.select("company").distinct().withColumn("_r", F.lit(1)), "company", "left")
    kept = flagged.where((F.col("_r").isNull()) | (F.col("attempts") > 1))
    back = F.date_format(F.date_sub(F.to_date(F.lit(run_date)), 8), "yyyy-MM-dd")
    return kept.select("company", F.when(F.col("_r") == 1, F.col("attempts") - 1).otherwise(F.col("attempts")).alias("attempts"), F.when(F.col("_r") == 1, back).otherwise(F.col("last")).alias("last"))


def stale_reason(platform: Column, api_url: Column, n: Column, status: Column, best: Column) -> Column:
    """Why a board looks broken, null if it doesn't; the first reason that applies."""
    plain = F.trim(text(platform))
    return (
        F.when((plain == "scrape") & text(api_url).rlike(HIRING_HOSTS), "misconfig-scrape-on-ats").when(status == "error", "fetch-error")
        .when((status == "empty") & (best > 0), "regressed-to-zero").when((n == 0) & ~plain.isin("scrape", "discovery", "custom_json", "jazzhr"), "empty-board")
    )


def health(results: DataFrame, baseline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(baseline, stale) after a run: best counts only grow and companies not in the run keep theirs; stale lists broken boards.

    results: company, platform, api_url, n, status.
    """
    best = F.coalesce("best_n", F.lit(0).cast("bigint"))
    both = results.groupBy("company").agg(F.max("n").alias("n")).join(baseline, "company", "full_outer")
    grown = both.select("company", F.greatest(best, F.coalesce("n", F.lit(0).cast("bigint"))).alias("best_n"))
    judged = results.join(baseline, "company", "left").select("company", F.col("api_url").alias("careers_url"), "platform", stale_reason(F.col("platform"), F.col("api_url"), F.col("n"), F.col("status"), best).alias("reason"))
    return grown, judged.where("reason is not null")


def streaks(log: DataFrame, key: str, day: str, bad: Column) -> DataFrame:
    """Per key with a bad last day: `since` (first day of the current run of bad days), `last`, and `n` days in it."""
    good = log.where(~bad).groupBy(key).agg(F.max(day).alias("_good"))
    runs = log.where(bad).join(good, key, "left").where(F.col("_good").isNull() | (F.col(day) > F.col("_good")))
    return runs.groupBy(key).agg(F.min(day).alias("since"), F.max(day).alias("last"), F.count_distinct(day).alias("n"))


def rot_action(why: Column, days: Column) -> Column:
    """What a failing source gets: its old postings carried, or it is parked or flagged, by kind and days of failure."""
    return F.when((why == "error") & (days >= 7) & (days < 14), "carry+park").when((why == "error") & (days < 14), "carry").when(why == "error", "park").when((why == "empty") & (days >= 45), "flag").otherwise("none")


def carry_forward(fresh: DataFrame, previous: DataFrame) -> DataFrame:
    """Fresh postings with an earlier description where they have none, and whether one was ever looked for.

    Postings are the same if company and url (else id) are; of repeated earlier ones the last counts.
    """
    key = F.coalesce(F.nullif("url", F.lit("")), "job_id")
    old = previous.groupBy("company", key.alias("_key")).agg(F.max_by(F.struct(F.col("description").alias("d"), F.col("_jd_attempted").alias("a")), "_ord").alias("_old"))
    joined = fresh.withColumn("_key", key).join(old, ["company", "_key"], "left")
    return joined.withColumn("description", F.coalesce(F.nullif("description", F.lit("")), "_old.d", F.lit(""))).withColumn("_jd_attempted", F.col("_old.a")).drop("_old", "_key")


def refresh_is_sound(new: DataFrame, old: DataFrame, least: float = 0.8) -> DataFrame:
    """One row (sound): whether enough companies are left, the guard before a cache is replaced."""
    both = new.select("company", F.lit(True).alias("n"), F.lit(False).alias("o")).unionByName(old.select("company", F.lit(False).alias("n"), F.lit(True).alias("o")))
    per = both.groupBy("company").agg(F.bool_or("n").alias("n"), F.bool_or("o").alias("o"))
    return per.agg((F.count_if("n") >= least * F.count_if("o")).alias("sound"))


def longest_run(log: DataFrame, order: str, bad: Column, *more: Column) -> DataFrame:
    """One row: `streak`, the most bad rows in a row in the order of a column, and the sums `more` (named) of all rows.

    Ranges of the order are counted apart, each with the bad rows it begins and ends with; one row a range is put together.
    """
    ranged = log.repartitionByRange(order).select(order, F.coalesce(bad, F.lit(False)).alias("_bad"), *more, F.spark_partition_id().alias("_range"))
    names = [c for c in ranged.columns if c not in (order, "_bad", "_range")]
    before = F.sum((~F.col("_bad")).cast("bigint")).over(Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    runs = ranged.withColumn("_run", before).groupBy("_range", "_run").agg(F.count_if("_bad").alias("n"), F.min(order).alias("at"), *(F.sum(n).alias(n) for n in names))
    ranges = runs.groupBy("_range").agg(
        F.min("at").alias("at"), F.max("_run").alias("good"), F.sum(F.when(F.col("_run") == 0, F.col("n")).otherwise(0)).alias("first"), F.max_by("n", "_run").alias("last"), F.max("n").alias("best"), *(F.sum(n).alias(n) for n in names)
    )
    start = F.struct(F.lit(0).cast("bigint").alias("open"), F.lit(0).cast("bigint").alias("best"))
    joined = lambda a, r: F.struct(F.when(r["good"] == 0, a["open"] + r["first"]).otherwise(r["last"]).alias("open"), F.greatest(a["best"], r["best"], a["open"] + r["first"]).alias("best"))
    listed = F.array_sort(F.collect_list(F.struct("at", "good", "first", "last", "best")))
    return ranges.agg(F.aggregate(listed, start, joined, lambda a: a["best"]).alias("streak"), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))


def outcomes_count(outcomes: DataFrame) -> DataFrame:
    """One row: ok, failed, and whether the run may count against names: not if it was aborted by three errors of the
    service in a row, nor if at least five failed and none succeeded.

    outcomes: company, _ord (order of the attempts), result (`ok`, `failed` or `error`).
    """
    said = lambda result: (F.col("result") == result).cast("bigint").alias(result)
    counts = ~((F.col("streak") >= 3) | ((F.col("failed") >= 5) & (F.col("ok") == 0)))
    return longest_run(outcomes, "_ord", F.col("result") == "error", said("ok"), said("failed")).select("ok", "failed", counts.alias("counts"))


def record_research_failures(failures: DataFrame, outcomes: DataFrame, run_date: str) -> DataFrame:
    """`failures` after a run (see `outcomes_count`): nothing is recorded of a run that was broken itself."""
    failed = outcomes.where("result = 'failed'").join(F.broadcast(outcomes_count(outcomes).where("counts").select(F.lit(1).alias("_c"))))
    return record_failures(failures, failed.select("company"), run_date)


def fill_employees(records: DataFrame, found: DataFrame, run_date: str) -> DataFrame:
    """Records after looking up head counts on profile pages.

    records: company, employees_global, size_band, employees_source, employees_as_of, employees_range, band_before (the band
    a weak count may have replaced), employees_miss. found: company, count, bucket, strong; null count and bucket: a miss.
    A weak match keeps the old band aside, a count sets the band, a bucket alone only fills an empty one.
    """
    f = found.select("company", F.col("count").cast("int").alias("_n"), F.col("bucket").alias("_b"), (F.coalesce("strong", F.lit(False)) & ~is_division("company")).alias("_s"), F.lit(True).alias("_f"))
    j = records.join(f, "company", "left")
    hit, miss = F.col("_n").isNotNull() | F.col("_b").isNotNull(), F.col("_f") & F.col("_n").isNull() & F.col("_b").isNull()
    hit = F.coalesce(hit, F.lit(False))
    floor = F.regexp_extract(text("_b"), r"^(\d+)", 1).try_cast("int")
    band = F.when(F.col("_n").isNotNull(), size_band(F.col("_n"))).when(hit & (text("size_band") == ""), size_band(F.greatest(floor, F.lit(1)))).otherwise(F.col("size_band"))
    return j.select(
        "company", F.coalesce("_n", "employees_global").alias("employees_global"), band.alias("size_band"),
        F.when(hit, F.when(F.col("_s"), "linkedin").otherwise("linkedin-weakmatch")).otherwise(F.col("employees_source")).alias("employees_source"), F.when(hit, F.lit(run_date)).otherwise(F.col("employees_as_of")).alias("employees_as_of"),
        F.coalesce("_b", "employees_range").alias("employees_range"), F.when(hit & ~F.col("_s") & F.col("band_before").isNull(), text("size_band")).otherwise(F.col("band_before")).alias("band_before"),
        F.when(F.coalesce(miss, F.lit(False)), F.lit(run_date)).otherwise(F.col("employees_miss")).alias("employees_miss"),
    )


def verify_employees(records: DataFrame, outcomes: DataFrame, run_date: str) -> DataFrame:
    """Records (see `fill_employees`) after a second look: confirmed counts replace, suspect ones that stay unconfirmed are
    emptied and the band before them returns; a run in which all of five or more missed, or that was aborted, changes no miss.

    outcomes: company, _ord, result (`ok`, `failed`, `error`), employees, source.
    """
    sound = F.broadcast(outcomes_count(outcomes).select(F.col("counts").alias("_sound")))
    o = outcomes.where("result <> 'error'").select("company", "result", F.col("employees").cast("int").alias("_n"), F.col("source").alias("_src"))
    j = records.join(o, "company", "left").join(sound)
    ok, miss = F.coalesce(F.col("result") == "ok", F.lit(False)), F.coalesce((F.col("result") == "failed") & F.col("_sound"), F.lit(False))
    weak = F.col("employees_source") == "linkedin-weakmatch"
    suspect = F.coalesce(weak | is_suspect(F.col("employees_global"), F.col("employees_source"), F.col("employees_range"), weak), F.lit(False))
    out = miss & suspect
    gone = lambda c, kind="string": F.when(ok | out, F.lit(None).cast(kind)).otherwise(F.col(c)).alias(c)
    return j.select(
        "company", F.when(ok, F.col("_n")).when(out, F.lit(None)).otherwise(F.col("employees_global")).cast("int").alias("employees_global"),
        F.when(ok, size_band(F.col("_n"))).when(out, text("band_before")).otherwise(F.col("size_band")).alias("size_band"),
        F.when(ok, F.concat(F.lit("web: "), "_src")).when(out, F.concat("employees_source", F.lit("-quarantined"))).otherwise(F.col("employees_source")).alias("employees_source"),
        F.when(ok, F.lit(run_date)).otherwise(F.col("employees_as_of")).alias("employees_as_of"), gone("employees_range"), gone("band_before"),
        F.when(ok, F.lit(None)).when(miss, F.lit(run_date)).otherwise(F.col("employees_miss")).alias("employees_miss"),
    )


def probe(observed: DataFrame, previous: DataFrame) -> DataFrame:
    """company, sig, il, wake: the first observation is a baseline; later ones wake if places rose or signals appeared."""
    old = previous.select("company", F.col("sig").alias("_s"), F.col("il").alias("_i"))
    wake = (F.col("il") > F.col("_i")) | ((F.col("sig") > 0) & (F.col("_s") == 0))
    return observed.join(old, "company", "left").select("company", "sig", "il", F.coalesce(wake, F.lit(False)).alias("wake"))


def attempts_after(attempts: DataFrame, outcomes: DataFrame, run_date: str) -> DataFrame:
    """Self-healing attempts: success clears a company, failure counts up. outcomes: company, ok."""
    out = outcomes.groupBy("company").agg(F.bool_or("ok").alias("ok"))
    both = attempts.join(out, "company", "full_outer").where(~F.coalesce("ok", F.lit(False)))
    failed = F.col("ok").isNotNull()
    return both.select("company", (F.coalesce("fails", F.lit(0)) + failed.cast("int")).alias("fails"), F.when(failed, F.lit(run_date)).otherwise(F.col("last")).alias("last"))


def due_attempts(candidates: DataFrame, attempts: DataFrame, run_date: str, strikes: int = 5, days: int = 7) -> DataFrame:
    """Candidates that are under the strike limit and were not tried lately."""
    tired = attempts.where((F.col("fails") >= strikes) | (gap_days(F.lit(run_date), F.col("last")) < days))
    return candidates.join(tired.select("company"), "company", "left_anti")


def advance_watermarks(watermarks: DataFrame, parsed: DataFrame) -> DataFrame:
    """Per channel the greatest id among parsed posts, never below the old mark."""
    new = parsed.groupBy("channel").agg(F.max("id").alias("_m"))
    return watermarks.join(new, "channel", "full_outer").select("channel", F.greatest("last_id", "_m").alias("last_id"))


def past_watermark(posts: DataFrame, watermarks: DataFrame) -> DataFrame:
    return posts.join(watermarks, "channel", "left").where(F.col("id") > F.coalesce("last_id", F.lit(0))).drop("last_id")

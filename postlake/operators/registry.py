"""The company registry: notes as a log of segments, verdicts, three-way merge, invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lexicons import HIRING_HOSTS, NOTE_FINAL, NOTE_TOKENS
from ..functions.text import any_of, text
from .pages import is_misattributed

SEPARATOR = " | "
_STAMP = r"^([A-Za-z][A-Za-z0-9 _-]*?) (\d{4}-\d{2}-\d{2})(?::|$)"
COLUMNS = ("company_name", "ats_platform", "token", "api_url", "active", "notes")


def segments(notes: Column | str) -> Column:
    return F.filter(F.transform(F.split(text(notes), r"\s*\|\s*"), lambda s: F.trim(s)), lambda s: s != "")


def parsed(notes: Column | str) -> Column:
    """array<struct<tool, day, body>>; segments without a stamp have an empty tool."""
    return F.transform(
        segments(notes),
        lambda s: F.struct(F.regexp_extract(s, _STAMP, 1).alias("tool"), F.regexp_extract(s, _STAMP, 2).try_cast("date").alias("day"), F.trim(F.regexp_replace(s, _STAMP + r"?\s*", "")).alias("body")),
    )


def segment_key(s: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(s, _STAMP, 1), F.lit("")), F.substring(s, 1, 28))


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda n, s: n + F.length(s)) + len(SEPARATOR) * F.greatest(F.size(parts) - 1, F.lit(0))


def within(parts: Column, cap: int) -> Column:
    """The longest head of the list that fits the cap when joined; at least its first part."""
    empty = F.array().cast("array<string>")
    return F.aggregate(parts, F.struct(empty.alias("kept"), F.lit(True).alias("open")), lambda a, s: F.struct(
        F.when(a["open"] & ((F.size(a["kept"]) == 0) | (_total(F.array_append(a["kept"], s)) <= cap)), F.array_append(a["kept"], s)).otherwise(a["kept"]).alias("kept"),
        (a["open"] & ((F.size(a["kept"]) == 0) | (_total(F.array_append(a["kept"], s)) <= cap))).alias("open"),
    ), lambda a: a["kept"])


def merge_notes(theirs: Column | str, ours: Column | str, cap: int = 220) -> Column:
    """Our segments, then theirs that no segment of the same tool (or opening) precedes; too long, the last ones go."""
    empty = F.array().cast("array<string>")
    both = F.concat(segments(ours), segments(theirs))
    once = F.aggregate(both, empty, lambda kept, s: F.when(F.exists(kept, lambda k: segment_key(k) == segment_key(s)), kept).otherwise(F.array_append(kept, s)))
    return F.array_join(within(once, cap), SEPARATOR)


def stamp(notes: Column | str, tool: str, run_date: str, finding: Column | str, cap: int = 220) -> Column:
    """Notes with the tool's segment replaced by a new one at the end; what stood before is cut to fit, never the new one."""
    new = F.concat(F.lit(f"{tool} {run_date}: "), finding if isinstance(finding, Column) else F.lit(finding))
    base = F.array_join(F.filter(segments(notes), lambda s: ~s.startswith(f"{tool} ")), SEPARATOR)
    room = F.greatest(F.lit(cap - len(SEPARATOR)) - F.length(new), F.lit(0))
    return F.when((base == "") | (room == 0), new).otherwise(F.concat(F.rtrim(F.substring(base, F.lit(1), room)), F.lit(SEPARATOR), new))


def woken(notes: Column | str, run_date: str, cap: int = 220) -> Column:
    """Notes without what put the company to rest, stamped awake."""
    kept = F.array_join(F.filter(segments(notes), lambda s: ~s.rlike(r"(?i)^(listing-hunt|crack-walled|dark-triage)\b")), SEPARATOR)
    return stamp(kept, "probe-woken", run_date, "openings seen", cap)


def in_pool(notes: Column | str) -> Column:
    n = text(notes)
    return n.rlike(rf"(?i){any_of(NOTE_TOKENS)}") & ~is_final(n)


def is_final(notes: Column | str) -> Column:
    return text(notes).rlike(rf"(?i){any_of(NOTE_FINAL)}")


def stamped_on(notes: Column | str, tool: str) -> Column:
    return F.nullif(F.regexp_extract(text(notes), rf"{tool} (\d{{4}}-\d{{2}}-\d{{2}})", 1), F.lit("")).try_cast("date")


def is_due(notes: Column | str, tool: str, run_date: str, days: int) -> Column:
    """Whether the tool never stamped the row, or that many days ago."""
    return F.coalesce(F.datediff(F.to_date(F.lit(run_date)), stamped_on(notes, tool)) >= days, F.lit(True))


def triage_mode(notes: Column | str) -> Column:
    return F.regexp_extract(text(notes), r"dark-triage \d{4}-\d{2}-\d{2}: ([a-z-]+)", 1)


def work_queue(rows: DataFrame, tool: str, run_date: str, days: int, n: int, order: str = "_row") -> DataFrame:
    """The n rows of the pool that the tool has left longest, never stamped ones first."""
    age = F.coalesce(F.datediff(F.to_date(F.lit(run_date)), stamped_on("notes", tool)), F.lit(2**31 - 1))
    return rows.where(in_pool("notes") & is_due("notes", tool, run_date, days)).withColumn("_age", age).orderBy(F.desc("_age"), order).limit(n).drop("_age")


def apply_outcomes(rows: DataFrame, outcomes: DataFrame, tool: str, run_date: str) -> DataFrame:
    """Rows after a tool's outcomes (company_name, platform, token, api_url, active, finding; null: unchanged), joined by name."""
    out = outcomes.select("company_name", *(F.col(c).alias(f"_{c}") for c in ("platform", "token", "api_url", "active", "finding")))
    joined = rows.join(out, "company_name", "left")
    changed = F.col("_finding").isNotNull()
    return joined.select(
        "company_name", F.coalesce("_platform", "ats_platform").alias("ats_platform"), F.coalesce("_token", "token").alias("token"), F.coalesce("_api_url", "api_url").alias("api_url"),
        F.coalesce("_active", "active").alias("active"), F.when(changed, stamp("notes", tool, run_date, F.col("_finding"))).otherwise(F.col("notes")).alias("notes"),
        *(c for c in rows.columns if c not in COLUMNS),
    )


def three_way_merge(base: DataFrame, ours: DataFrame, target: DataFrame, cap: int = 220) -> DataFrame:
    """The target with the rows that ours changed against base. Rows missing in ours are no deletions.

    A changed row takes our fields and the notes of both; a repaired url of the target stays unless ours was repaired too.
    Two joins by name; rows of equal name within a table should have been reported by `violations`.
    """
    fields = list(COLUMNS)
    same = F.struct(*(F.coalesce(f"b.{c}", F.lit("")) for c in fields)) == F.struct(*(F.coalesce(f"o.{c}", F.lit("")) for c in fields))
    changed = ours.alias("o").join(base.alias("b"), F.col("o.company_name") == F.col("b.company_name"), "left").where(F.col("b.company_name").isNull() | ~same).select("o.*")
    c, t = F.col("c.company_name").isNotNull(), F.col("t.company_name").isNotNull()
    both = target.alias("t").join(changed.alias("c"), F.col("t.company_name") == F.col("c.company_name"), "full_outer")
    keeps = t & text(F.col("t.notes")).contains("url-repaired") & ~text(F.col("c.notes")).contains("url-repaired")
    pick = lambda name: F.when(c, F.col(f"c.{name}")).otherwise(F.col(f"t.{name}")).alias(name)
    notes = F.when(c & t, merge_notes(F.col("t.notes"), F.col("c.notes"), cap)).when(c, F.col("c.notes")).otherwise(F.col("t.notes"))
    url = F.when(c & ~keeps, F.col("c.api_url")).otherwise(F.col("t.api_url"))
    return both.select(pick("company_name"), pick("ats_platform"), pick("token"), url.alias("api_url"), pick("active"), notes.alias("notes"))


def append_absent(rows: DataFrame, new: DataFrame) -> DataFrame:
    """rows and the companies of `new` it lacks, each once (names compared without case and outer spaces)."""
    key = F.lower(F.trim("company_name"))
    fresh = new.withColumn("_k", key).join(rows.select(key.alias("_k")).distinct(), "_k", "left_anti")
    first = fresh.groupBy("_k").agg(F.min(F.struct(*COLUMNS)).alias("r")).select("r.*")
    return rows.select(*COLUMNS).unionByName(first)


def replace_changed(rows: DataFrame, changed: DataFrame) -> DataFrame:
    """rows with those of `changed` in the place of rows of the same name; nothing else is written back."""
    return rows.join(changed.select("company_name"), "company_name", "left_anti").select(*COLUMNS).unionByName(changed.select(*COLUMNS))


def selected(rows: DataFrame, only: list[str] | None = None, n: int | None = None, order: str = "_row") -> DataFrame:
    """Rows of the named companies (without case and outer spaces), the first n in the registry's order."""
    if only:
        rows = rows.where(F.lower(F.trim("company_name")).isin([name.strip().lower() for name in only]))
    return rows.orderBy(order).limit(n) if n else rows


def shard(rows: DataFrame, i: int, n: int, order: str = "_row", ranges: int = 64) -> DataFrame:
    """Every n-th row from the i-th on, in the registry's order. Places come from counts by range, so no task sorts all rows.

    The ranges' bounds are read first: a repartitioning by range samples anew wherever the plan repeats it, and rows and
    counts would disagree about which range a row is in.
    """
    cuts = F.percentile_approx(order, F.array(*(F.lit(k / ranges) for k in range(1, ranges))))
    bounds = sorted(set(rows.agg(cuts).first()[0] or ()))
    below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(order))) if bounds else F.lit(0)
    local = rows.withColumn("_part", below)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = local.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1).join(F.broadcast(sizes), "_part")
    return placed.where((F.col("_place") + F.col("_before")) % n == i).drop("_part", "_place", "_before")


def unresolved(stale: DataFrame, resolved: DataFrame, n: int | None = 20) -> DataFrame:
    """Stale companies that no resolved configuration covers, the first n by name, or all of them."""
    left = stale.join(resolved.select("company").distinct(), "company", "left_anti")
    return left if n is None else left.orderBy("company").limit(n)


def to_resolve(stale: DataFrame, rows: DataFrame) -> DataFrame:
    """company, careers_url of boards to resolve again: stale ones with an address; if none is stale, scraped rows on a platform's host.

    An interface address becomes the public page it belongs to.
    """
    public = F.regexp_replace("careers_url", r"^(https://[^/]+\.myworkdayjobs\.com)/wday/cxs/[^/]+/([^/]+)/.*$", "$1/$2")
    listed = stale.where(text("careers_url") != "").select("company", "careers_url", F.lit(True).alias("_stale"))
    hosted = rows.where((F.trim("ats_platform") == "scrape") & text("api_url").rlike(HIRING_HOSTS)).select(F.col("company_name").alias("company"), F.col("api_url").alias("careers_url"), F.lit(False).alias("_stale"))
    both = listed.unionByName(hosted)
    any_ = F.broadcast(stale.agg((F.count(F.lit(1)) > 0).alias("_any")))
    return both.join(any_, F.col("_stale") == F.col("_any")).select("company", public.alias("careers_url"))


def apply_resolved(rows: DataFrame, resolved: DataFrame, mark: str = "[self-heal: re-resolved]") -> DataFrame:
    """Rows with newly found configurations (company, platform, token, api_url); notes of those that differ get the mark."""
    r = resolved.select(F.col("company").alias("company_name"), *(F.col(c).alias(f"_{c}") for c in ("platform", "token", "api_url")))
    j = rows.join(r, "company_name", "left")
    same = (text("ats_platform") == text("_platform")) & (text("token") == text("_token")) & (text("api_url") == text("_api_url"))
    new = F.col("_platform").isNotNull() & ~same
    pick = lambda c, n: F.when(new, F.col(n)).otherwise(F.col(c)).alias(c)
    notes = F.when(new, F.concat_ws(" ", F.nullif("notes", F.lit("")), F.lit(mark))).otherwise(F.col("notes"))
    return j.select("company_name", pick("ats_platform", "_platform"), pick("token", "_token"), pick("api_url", "_api_url"), "active", notes.alias("notes"), *(c for c in rows.columns if c not in COLUMNS))


def outcome_tally(outcomes: DataFrame, by: str = "mode") -> DataFrame:
    """by, n: how often each outcome came up, the commonest first."""
    return outcomes.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by)


def pool_of(rows: DataFrame, tool: str, run_date: str) -> DataFrame:
    """Rows a tool should look at now, by its own tokens, its own waiting time and what triage said of them."""
    tokens, days, modes = POOLS[tool]
    n = text("notes")
    wanted = n.rlike(rf"(?i){any_of(tokens)}") & ~is_final("notes") & is_due("notes", tool, run_date, days)
    return rows.where(wanted & (triage_mode("notes").isin("", *modes) if modes else F.lit(True)))


#: By tool, the tokens of its pool, days between looks, and the triage modes it acts on (none: all).
POOLS = {
    "listing-hunt": (("no listing found", "no IL listing", "monitored candidate", "host documented", "probe-woken", "dark-triage"), 14, ("extract-gap", "js-shell", "wrong-page")),
    "dark-triage": (("no listing found", "no IL listing", "no ATS detected", "dark-triage"), 10, ()),
    "audit": (("scanned; no open", "no ATS detected", "empty-but-suspect"), 30, ()),
    "deep-validate": (("roles-text present", "empty-but-suspect", "no listing found"), 30, ()),
    "crack-walled": (("unreachable", "scanned via brightdata"), 30, ()),
}


def violations(rows: DataFrame, allowed_orphans: tuple[str, ...] = (), least_pool: int = 50, cap: int = 220) -> DataFrame:
    """(rule, key, detail) for each broken rule of the registry; empty if it is sound. Rows with `_broken`, see
    `tables.registry_lines`, are also tested for their number of fields.

    One pass over the rows for the rules of single rows; repeated names and the size of the pool are counted beside it.
    """
    active = F.lower(F.trim(text("active"))) == "true"
    name = F.coalesce("company_name", F.lit(""))
    idle = ~active & ~in_pool("notes") & ~is_final("notes")
    idle = idle & ~name.isin(*allowed_orphans) if allowed_orphans else idle
    broken = lambda rule, where, detail: F.when(where, F.struct(F.lit(rule).alias("rule"), name.alias("key"), detail.cast("string").alias("detail")))
    width = [broken("width", F.col("_broken").isNotNull(), F.col("_broken"))] if "_broken" in rows.columns else []
    single = F.array_compact(
        F.array(
            *width,
            broken("shape", (F.trim(name) == "") | ~F.coalesce(F.lower(F.trim("active")).isin("true", "false"), F.lit(False)), F.coalesce("active", F.lit(""))),
            broken("unscannable", active & ((F.trim(text("api_url")) == "") | (F.trim(text("ats_platform")) == "")), text("ats_platform")),
            broken("orphan", idle, text("notes")),
            broken("truncated", F.length("notes") > cap, F.length("notes")),
            broken("misconfigured", active & (F.lower(F.trim("ats_platform")) == "scrape") & text("api_url").rlike(HIRING_HOSTS), F.col("api_url")),
        )
    )
    repeated = rows.groupBy(F.lower(F.trim(name)).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate").alias("rule"), "key", F.col("n").cast("string").alias("detail"))
    pool = rows.agg(F.count_if(~active & in_pool("notes")).alias("n")).where(F.col("n") < least_pool).select(F.lit("pool").alias("rule"), F.lit("pool").alias("key"), F.col("n").cast("string").alias("detail"))
    return rows.select(F.explode(single).alias("v")).select("v.*").unionByName(repeated).unionByName(pool)


def misattributed(matched: DataFrame) -> DataFrame:
    """(rule, key, detail) of openings whose address names another company."""
    return matched.where(is_misattributed("company", "url")).select(F.lit("attribution").alias("rule"), F.col("company").alias("key"), F.col("url").alias("detail"))

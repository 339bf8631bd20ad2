"""Registered queries of the posting operators over the test tables, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import samples
from .functions import lexicons as L
from .functions.dates import iso_date, relative_date
from .functions.identity import display_company, host, identity_key, is_agency, is_listing_site, merge_key, norm_company, primary_sector, registrable, seen_id, size_band
from .functions.places import city, is_israel
from .functions.profile import profiled
from .functions.relevance import classify
from .functions.text import any_of, shorten, strip_html
from .operators import dedup, enrich, registry, state, stats
from .plans import daily
from .samples import JOBS_SQL, dealt, jobs, parts
from .streaming.incremental import sessions, windowed_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def has(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {q(pattern)})"


# --- keys and names ---
_NORM = "trim(regexp_replace(lower({}), '[^0-9a-z֐-׿]+', ' ', 'g'))"
_COMPANY = _NORM.format(f"regexp_replace(trim(company), {q(L.MERGE_SUFFIX)}, '')")
_MKEY = f"concat_ws('|', {_COMPANY}, {_NORM.format('title')})"
_SEEN = "concat(ats_platform, ':', CASE WHEN trim(job_id) <> '' THEN trim(job_id) ELSE url END)"
_IDENTITY = f"regexp_replace({_NORM.format('company')}, '(?:\\s+(?:{'|'.join(L.IDENTITY_SUFFIXES)}))+$', '')"
_ISO = "regexp_matches(posted_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')"


@query(f"SELECT _ord, {_SEEN} AS seen_id, {_MKEY} AS mkey, {_COMPANY} AS company_key, {_IDENTITY} AS identity FROM {JOBS_SQL}")
def posting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).select("_ord", seen_id().alias("seen_id"), merge_key().alias("mkey"), norm_company("company").alias("company_key"), identity_key("company").alias("identity"))


_PLACE = f"(^|[^a-z])({any_of(L.PLACES)})([^a-z]|$)".replace("\\-", "-").replace("\\ ", " ")
_HERE = f"CASE WHEN upper(trim(country_code)) IN ('IL', 'ISR') THEN true WHEN trim(country_code) <> '' THEN false ELSE {has('lower(location)', _PLACE)} OR {has('lower(url)', _PLACE)} END"


@query(f"SELECT _ord, {_HERE} AS here FROM {JOBS_SQL}")
def location_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).select("_ord", is_israel().alias("here"))


_CITY = "CASE " + " ".join(f"WHEN location = {q(a)} THEN {q(b)}" for a, b in (("Tel Aviv-Yafo, Israel", "Tel Aviv"), ("New York, US", "New York"), ("Israel - Petah Tikva", "Petah Tikva"), ("Center District, Israel", "Center District"), ("Berlin, Germany", "Berlin"))) + " ELSE location END"


@query(f"SELECT {_CITY} AS city, count(*) AS n FROM {JOBS_SQL} GROUP BY 1")
def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).groupBy(city("location").alias("city")).agg(F.count(F.lit(1)).alias("n"))


_LISTING = "(//|^)([^/]*\\.)?(" + "|".join(h.rstrip("/").replace(".", "\\.") for h in L.LISTING_HOSTS) + ")"
_AGENCY = f"(trim(lower(company)) IN ({', '.join(map(q, L.AGENCIES))}) OR {has('lower(company)', L.AGENCY_WORDS)})"


@query(f"SELECT ats_platform, {has('url', _LISTING)} AS listing, {_AGENCY} AS agency, count(*) AS n FROM {JOBS_SQL} GROUP BY ALL")
def listing_sites_and_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).groupBy("ats_platform", is_listing_site("url").alias("listing"), is_agency("company").alias("agency")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, lower(replace(s_name, '#', '-')) || '.co.uk' AS host, lower(replace(s_name, '#', '-')) AS label, CASE WHEN s_acctbal < 200 THEN 'S' WHEN s_acctbal < 1000 THEN 'M' WHEN s_acctbal < 5000 THEN 'L' ELSE 'XL' END AS band FROM supplier")
def supplier_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = host(F.concat(F.lit("https://www."), F.replace("s_name", F.lit("#"), F.lit("-")), F.lit(".co.uk/x")))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.regexp_replace(h, r"^www\.", "").alias("host"), registrable(h).alias("label"), size_band(F.col("s_acctbal")).alias("band"))


@query("SELECT p_type, CASE WHEN p_type = 'ECONOMY' THEN 'fintech' ELSE p_type END AS sector, count(*) AS n FROM part GROUP BY ALL")
def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("p_type") == "ECONOMY", "Payments / lending").otherwise(F.concat(F.col("p_type"), F.lit(" / other")))
    return read(spark, sf_dir, "part").groupBy("p_type", primary_sector(named).alias("sector")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y-%m-%d') AS long_form, strftime(DATE '2026-08-22' - CAST(o_orderkey % 30 AS INTEGER), '%Y-%m-%d') AS relative, CASE o_orderkey % 4 WHEN 0 THEN '2026-08-22' WHEN 1 THEN '2026-08-22' WHEN 2 THEN CASE WHEN o_orderkey % 700 <= 365 THEN strftime(DATE '2026-08-22' - CAST(o_orderkey % 700 AS INTEGER), '%Y-%m-%d') ELSE '' END ELSE strftime(DATE '2026-08-22' - CAST(30 * (o_orderkey % 5) AS INTEGER), '%Y-%m-%d') END AS loose FROM orders")
def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", iso_date(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("iso"), iso_date(F.date_format("o_orderdate", "MMMM d, yyyy")).alias("long_form"),
        relative_date(F.concat(F.lit("Posted "), (F.col("o_orderkey") % 30).cast("string"), F.lit(" Days Ago")), "2026-08-22").alias("relative"),
        relative_date(
            F.when(F.col("o_orderkey") % 4 == 0, "Just posted").when(F.col("o_orderkey") % 4 == 1, " just now").when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("Posted "), (F.col("o_orderkey") % 700).cast("string")))
            .otherwise(F.concat((F.col("o_orderkey") % 5).cast("string"), F.lit("+ months ago"))), "2026-08-22",
        ).alias("loose"),
    )


_TEXT = "html"
for _pattern, _new in ((r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " "), (r"(?is)<li[^>]*>", " • "), (r"(?is)<br\s*/?>|</(p|div|h[1-6]|tr|ul|ol)\s*>", " • "), (r"<[^>]+>", " "), (r"\s*•(?:\s*•)+\s*", " • "), (r"\s+", " ")):
    _TEXT = f"regexp_replace({_TEXT}, {q(_pattern)}, {q(_new)}, 'g')"


@query(f"SELECT page_id, md5(trim({_TEXT})) AS digest, length(trim({_TEXT})) AS n FROM (SELECT page_id, replace(html, '&', ' ') AS html FROM pages)")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = read(spark, sf_dir, "pages").select("page_id", strip_html(F.replace("html", F.lit("&"), F.lit(" "))).alias("t"))
    return plain.select("page_id", F.md5(F.col("t").cast("binary")).alias("digest"), F.length("t").cast("long").alias("n"))


_SQUEEZED = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"


@query(
    rf"""SELECT doc_id, CASE WHEN length(t) <= 210 THEN t ELSE CASE WHEN contains(left(t, 210), ' ') THEN regexp_extract(left(t, 210), '^(.*) ', 1) ELSE left(t, 210) END || '…' END AS summary, source
    FROM (SELECT doc_id, {_SQUEEZED.replace(chr(92) * 2, chr(92))} AS t, coalesce(source, '') AS source FROM documents)"""
)
def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", shorten("text", 210).alias("summary"), display_company("source").alias("source"))


# --- rules ---
_REL = f"CASE WHEN {has('t', L.TITLE_EXCLUDED)} THEN CASE WHEN {has('t', L.TITLE_STRONG)} THEN 'signal' ELSE 'excluded' END WHEN {has('t', L.TITLE_STRONG)} THEN 'strong' WHEN {has('t', L.TITLE_SIGNAL)} THEN 'signal' ELSE 'none' END"
_SEN = f"CASE WHEN {has('t', L.TITLE_SENIOR)} THEN 'senior' WHEN {has('t', L.TITLE_JUNIOR)} THEN 'junior' ELSE 'unknown' END"
_COUNT = lambda p: f"len(regexp_extract_all(role, {q(p)}))"
_CLASSES = f"""(
    SELECT *, CASE WHEN rel IN ('excluded', 'none') OR sen = 'junior' THEN 'reject' WHEN rel = 'strong' THEN 'accept'
        WHEN sen = 'senior' AND NOT (models >= 2 AND models > analysis)
            AND CASE WHEN {has('t', L.BARE_SCIENTIST)} AND NOT {has('t', L.SCIENTIST_QUALIFIER)} THEN {has('description', L.TEXT_ANALYTICS)} ELSE {has('t', L.TITLE_ANCHOR)} OR {has('description', L.TEXT_ANALYTICS)} END
        THEN 'accept' ELSE 'reject' END AS decision,
        CASE WHEN rel IN ('excluded', 'none') OR sen = 'junior' OR (rel = 'strong' AND sen = 'senior') THEN 'keyword' ELSE 'keyword_nollm' END AS path
    FROM (SELECT *, {_COUNT(L.TEXT_MODELLING)} AS models, {_COUNT(L.TEXT_ANALYTICS)} AS analysis
    FROM (SELECT *, {_REL} AS rel, {_SEN} AS sen, coalesce(nullif(regexp_extract(description, {q(L.ROLE_START + '.*')}), ''), description) AS role FROM (SELECT *, lower(title) AS t FROM {JOBS_SQL}) WHERE {_HERE}))
)"""


@query(f"SELECT _ord, decision, path, rel AS relevance, sen AS seniority FROM {_CLASSES}")
def title_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.classified(jobs(spark, sf_dir)).select("_ord", "class.decision", "class.path", "class.relevance", "class.seniority")


@query(f"SELECT path, decision, count(*) AS n FROM {_CLASSES} GROUP BY ALL")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_counters(daily.classified(jobs(spark, sf_dir)))


@query(
    f"""WITH v AS (SELECT lower(company) || '|' || lower(title) AS k, max_by(o % 2 = 0, o) AS verdict FROM (SELECT company, title, _ord AS o FROM {JOBS_SQL}) WHERE o % 5 = 0 GROUP BY 1)
    SELECT c.path2 AS path, c.d AS decision, count(*) AS n FROM (SELECT CASE WHEN x.path = 'keyword' THEN 'keyword' WHEN v.k IS NOT NULL THEN 'llm_cache' ELSE 'llm_failed_fallback' END AS path2,
    CASE WHEN x.path <> 'keyword' AND v.k IS NOT NULL THEN CASE WHEN v.verdict THEN 'accept' ELSE 'reject' END ELSE x.decision END AS d
    FROM {_CLASSES} x LEFT JOIN v ON v.k = lower(x.company) || '|' || lower(x.title)) c GROUP BY ALL"""
)
def cached_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = jobs(spark, sf_dir).where("_ord % 5 = 0").select(F.concat_ws("|", F.lower("company"), F.lower("title")).alias("title_key"), (F.col("_ord") % 2 == 0).alias("verdict"), F.col("_ord").alias("updated"))
    return stats.run_counters(daily.classified(jobs(spark, sf_dir), known))


# --- duplicates and windows ---
_MERGED = f"""(
    SELECT mkey, arg_min(company, rank) AS company, arg_min(title, rank) AS title, arg_min(location, rank) AS location, arg_min(url, rank) AS url, arg_min(posted_date, rank) AS posted_date, arg_min(description, rank) AS description,
        array_to_string(list_sort(list(DISTINCT seen)), ' ') AS seen_ids, array_to_string(list_sort(list(DISTINCT ats_platform)), ' ') AS sources, min(_ord) AS _ord, list(DISTINCT seen) AS ids
    FROM (SELECT *, {_MKEY} AS mkey, {_SEEN} AS seen, (CASE WHEN {_ISO} THEN 0 ELSE 4000000000 END) + (CASE WHEN url <> '' THEN 0 ELSE 2000000000 END) + _ord AS rank FROM {JOBS_SQL} WHERE @WHERE@) GROUP BY mkey
)"""


def _merged_sql(where: str) -> str:
    return _MERGED.replace("@WHERE@", where)


def _merged(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    return dedup.merge_duplicates(jobs(spark, sf_dir).where(where))


def _flat() -> list[Column]:
    return [F.array_join("seen_ids", " ").alias("seen_ids"), F.array_join("sources", " ").alias("sources")]


@query(f"SELECT mkey, company, title, location, url, posted_date, seen_ids, sources, _ord FROM {_merged_sql('true')}")
def merge_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("mkey", "company", "title", "location", "url", "posted_date", *_flat(), "_ord")


@query(f"SELECT mkey FROM {_merged_sql('true')} m WHERE NOT EXISTS (SELECT 1 FROM (SELECT {_SEEN} AS s FROM {JOBS_SQL} WHERE _ord % 50 = 0) x WHERE list_contains(m.ids, x.s))")
def unsent(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = jobs(spark, sf_dir).where("_ord % 50 = 0").select(seen_id().alias("seen_id"))
    return state.unsent(_merged(spark, sf_dir), sent).select("mkey")


@query(f"SELECT mkey, company, posted_date FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY posted_date DESC, mkey) AS p FROM {_merged_sql('true')}) WHERE p <= 3")
def capped_per_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _merged(spark, sf_dir).withColumn("first_seen", F.lit(None).cast("string"))
    return dedup.freshest(rows, 3).select("mkey", "company", "posted_date")


_DAY1, _DAY2 = "_ord % 3 <> 0", "_ord % 4 <> 1"


@query(
    f"""SELECT coalesce(o.mkey, n.mkey) AS mkey, coalesce(o.company, n.company) AS company,
        CASE WHEN n.mkey IS NULL THEN o.posted_date WHEN o.posted_date <> '' AND n.posted_date = '' THEN o.posted_date ELSE n.posted_date END AS posted_date,
        CASE WHEN o.mkey IS NULL THEN '2026-08-22' WHEN n.mkey IS NULL THEN '2026-08-19' ELSE '2026-08-19' END AS first_seen,
        CASE WHEN n.mkey IS NULL THEN '2026-08-19' ELSE '2026-08-22' END AS last_seen,
        len(list_distinct(list_concat(coalesce(o.ids, []), coalesce(n.ids, [])))) AS n_ids
    FROM {_merged_sql(_DAY1)} o FULL JOIN {_merged_sql(_DAY2)} n ON o.mkey = n.mkey"""
)
def upsert_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.tables import STATE, empty

    day1 = state.upsert_matched(empty(spark, STATE["matched"]), _merged(spark, sf_dir, _DAY1), "2026-08-19")
    day2 = state.upsert_matched(day1, _merged(spark, sf_dir, _DAY2), "2026-08-22")
    return day2.select("mkey", "company", "posted_date", "first_seen", "last_seen", F.size("seen_ids").cast("long").alias("n_ids"))


@query(
    """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
    s AS (SELECT user_id, d, CASE WHEN coalesce(d - lag(d) OVER w > 3, true) THEN d END AS start FROM d WINDOW w AS (PARTITION BY user_id ORDER BY d))
    SELECT user_id, max(start) AS first_seen, max(d) AS last_seen FROM s GROUP BY 1"""
)
def first_seen_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.first_seen_from_history(read(spark, sf_dir, "events"), "user_id", "ts")


@query(
    """SELECT e.user_id, min(CAST(ts AS DATE)) AS since, max(CAST(ts AS DATE)) AS last, count(DISTINCT CAST(ts AS DATE)) AS n FROM events e
    LEFT JOIN (SELECT user_id, max(CAST(ts AS DATE)) AS good FROM events WHERE event_type = 'purchase' GROUP BY 1) g USING (user_id)
    WHERE event_type <> 'purchase' AND (good IS NULL OR CAST(ts AS DATE) > good) GROUP BY 1"""
)
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return state.streaks(log, "user_id", "day", F.col("event_type") != "purchase")


@query("SELECT event_type AS channel, greatest(max(event_id), 10) AS last_id FROM events GROUP BY 1")
def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select(F.col("event_type").alias("channel"), F.col("event_id").alias("id"))
    marks = events.select("channel").distinct().withColumn("last_id", F.lit(10).cast("long"))
    return state.advance_watermarks(marks, state.past_watermark(events, marks))


_RESULTS = "SELECT c_name AS company, CASE WHEN c_custkey % 4 = 0 THEN 'scrape' ELSE 'lever' END AS platform, CASE WHEN c_custkey % 8 = 0 THEN 'https://jobs.lever.co/x' ELSE 'https://x.com' END AS api_url, {n} AS n, CASE WHEN c_custkey % 7 = 0 THEN 'error' WHEN {n} = 0 THEN 'empty' ELSE 'ok' END AS status FROM customer"


@query(
    f"""WITH r AS ({_RESULTS.format(n='c_custkey % 5')}), b AS (SELECT c_name AS company, c_custkey % 3 AS best_n FROM customer WHERE c_custkey % 2 = 0)
    SELECT * FROM (SELECT r.company, r.api_url AS careers_url, r.platform, CASE WHEN r.platform = 'scrape' AND contains(api_url, 'lever.co') THEN 'misconfig-scrape-on-ats' WHEN status = 'error' THEN 'fetch-error'
    WHEN status = 'empty' AND coalesce(best_n, 0) > 0 THEN 'regressed-to-zero' WHEN n = 0 AND platform <> 'scrape' THEN 'empty-board' END AS reason FROM r LEFT JOIN b USING (company)) WHERE reason IS NOT NULL"""
)
def stale_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _health(spark, sf_dir)[1]


@query(
    f"WITH r AS ({_RESULTS.format(n='c_custkey % 5')}), b AS (SELECT c_name AS company, c_custkey % 3 AS best_n FROM customer WHERE c_custkey % 2 = 0) SELECT r.company, greatest(coalesce(best_n, 0), n) AS best_n FROM r LEFT JOIN b USING (company)"
)
def health_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _health(spark, sf_dir)[0]


def _health(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = read(spark, sf_dir, "customer")
    results = customer.select(
        F.col("c_name").alias("company"), F.when(F.col("c_custkey") % 4 == 0, "scrape").otherwise("lever").alias("platform"),
        F.when(F.col("c_custkey") % 8 == 0, "https://jobs.lever.co/x").otherwise("https://x.com").alias("api_url"), (F.col("c_custkey") % 5).alias("n"),
        F.when(F.col("c_custkey") % 7 == 0, "error").when(F.col("c_custkey") % 5 == 0, "empty").otherwise("ok").alias("status"),
    )
    baseline = customer.where("c_custkey % 2 = 0").select(F.col("c_name").alias("company"), (F.col("c_custkey") % 3).alias("best_n"))
    return state.health(results, baseline)


# --- companies, caches and targets ---
_FIRMS = "SELECT c_name AS company, CASE c_custkey % 3 WHEN 0 THEN 'fintech' WHEN 1 THEN 'gaming' ELSE '' END AS sector, CASE WHEN c_acctbal BETWEEN 1 AND 5000000 THEN CAST(trunc(c_acctbal) AS INTEGER) END AS employees FROM customer"


def _firms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firmographic records as stored: JSON text, some unreadable."""
    c = read(spark, sf_dir, "customer")
    record = F.to_json(F.struct(F.element_at(F.array(F.lit("fintech"), F.lit("gaming"), F.lit("")), (F.col("c_custkey") % 3 + 1).cast("int")).alias("sector"), F.lit("Public?").alias("stage"), F.lit("s").alias("size_band"), F.col("c_acctbal").alias("employees_global"), F.lit(1500).alias("founded")))
    return c.select(F.col("c_name").alias("company"), F.when(F.col("c_custkey") % 10 == 9, "{broken").otherwise(record).alias("record"), F.col("c_custkey").cast("string").alias("updated"))


@query(
    f"""SELECT company, sector, '' AS stage, CASE WHEN employees < 200 THEN 'S' WHEN employees < 1000 THEN 'M' WHEN employees < 5000 THEN 'L' WHEN employees IS NOT NULL THEN 'XL' ELSE 'S' END AS size_band, CAST(employees AS BIGINT) AS employees
    FROM ({_FIRMS}) JOIN (SELECT c_name AS company, c_custkey FROM customer WHERE c_custkey % 10 <> 9) USING (company) WHERE sector <> ''"""
)
def firmographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.firmographics(_firms(spark, sf_dir), "2026-08-22").select("company", "sector", "stage", "size_band", F.col("employees_global").cast("long").alias("employees"))


_NAMES = f"SELECT DISTINCT company, {_IDENTITY} AS id FROM {JOBS_SQL} WHERE _ord % 3 = 0"


@query(
    f"""WITH f AS ({_NAMES}), j AS (SELECT _ord, company, {_IDENTITY} AS id FROM {JOBS_SQL}), latest AS (SELECT id, max(company) AS company FROM f GROUP BY 1)
    SELECT CASE WHEN f.company IS NOT NULL THEN 'exact' WHEN l.company IS NOT NULL THEN 'alike' ELSE 'none' END AS how, count(*) AS n, count(DISTINCT coalesce(f.company, l.company)) AS records
    FROM j LEFT JOIN f ON f.company = j.company LEFT JOIN latest l ON l.id = j.id GROUP BY 1"""
)
def company_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = jobs(spark, sf_dir).where("_ord % 3 = 0").select("company").distinct()
    records = names.select("company", F.col("company").alias("record"), F.lit("2026-01-01").alias("updated"))
    joined = enrich.with_companies(jobs(spark, sf_dir), records)
    how = F.when(F.col("firm.record") == F.col("company"), "exact").when(F.col("firm").isNotNull(), "alike").otherwise("none")
    return joined.groupBy(how.alias("how")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("firm.record").alias("records"))


_OLD_DAY, _CUT = "1998-03-01", "1998-02-08"


@query(
    f"""WITH both_ AS (SELECT *, 0 AS prev FROM {JOBS_SQL} WHERE _ord % 2 = 0 UNION ALL SELECT *, 1 FROM {JOBS_SQL} WHERE _ord % 2 = 1)
    SELECT company, title, posted_date, _ord FROM (SELECT *, row_number() OVER (PARTITION BY lower(company), lower(title) ORDER BY prev, _ord) AS p FROM both_ WHERE posted_date = '' OR posted_date >= '{_CUT}') WHERE p = 1"""
)
def merged_discoveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs(spark, sf_dir)
    return enrich.merge_discovered(rows.where("_ord % 2 = 0"), rows.where("_ord % 2 = 1"), _OLD_DAY).select("company", "title", "posted_date", "_ord")


@query(f"SELECT n.company, n.title, n._ord FROM {JOBS_SQL} n WHERE _ord % 2 = 0 AND NOT EXISTS (SELECT 1 FROM {JOBS_SQL} c WHERE c._ord % 2 = 1 AND lower(c.company) = lower(n.company) AND lower(c.title) = lower(n.title)) UNION ALL SELECT company, title, _ord FROM {JOBS_SQL} WHERE _ord % 2 = 1")
def appended_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs(spark, sf_dir).select("company", "title", "_ord")
    return enrich.append_new(rows.where("_ord % 2 = 1"), rows.where("_ord % 2 = 0"))


@query(f"SELECT arg_min(company, _ord) AS company, min(_ord) AS _ord FROM {JOBS_SQL} j WHERE NOT {_AGENCY} AND NOT EXISTS (SELECT 1 FROM {JOBS_SQL} k WHERE k._ord % 9 = 0 AND lower(trim(k.company)) = lower(trim(j.company))) GROUP BY lower(trim(company))")
def new_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs(spark, sf_dir).select("company", "_ord")
    return enrich.new_companies(rows, rows.where("_ord % 9 = 0").select("company"))


@query(
    f"""WITH old AS (SELECT company, CASE WHEN url <> '' THEN url ELSE job_id END AS k, arg_max(description, _ord) AS d FROM {JOBS_SQL} GROUP BY 1, 2)
    SELECT j._ord, CASE WHEN j._ord % 2 = 0 OR j.description = '' THEN coalesce(old.d, '') ELSE j.description END AS description FROM {JOBS_SQL} j LEFT JOIN old ON old.company = j.company AND old.k = CASE WHEN url <> '' THEN url ELSE job_id END"""
)
def carried_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs(spark, sf_dir)
    fresh = rows.withColumn("description", F.when(F.col("_ord") % 2 == 0, "").otherwise(F.col("description")))
    return state.carry_forward(fresh, rows.withColumn("_jd_attempted", F.lit("2026-08-01"))).select("_ord", "description")


@query(
    """WITH k AS (SELECT c_name AS company, DATE '2026-08-22' - CAST(c_custkey % 400 AS INTEGER) AS as_of FROM customer WHERE c_custkey % 5 <> 0), n AS (SELECT c_name AS company FROM customer WHERE c_custkey % 2 = 0 AND NOT (c_custkey % 11 = 0))
    SELECT company, why FROM (SELECT n.company, CASE WHEN k.company IS NULL THEN 'new' ELSE 'refresh' END AS why, row_number() OVER (ORDER BY k.company IS NOT NULL, k.as_of, n.company) AS p FROM n LEFT JOIN k USING (company) WHERE k.as_of IS NULL OR DATE '2026-08-22' - k.as_of > 180) WHERE p <= 20"""
)
def research_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").withColumn("company", F.col("c_name"))
    known = c.where("c_custkey % 5 <> 0").select("company", F.date_format(F.date_sub(F.lit("2026-08-22").cast("date"), (F.col("c_custkey") % 400).cast("int")), "yyyy-MM-dd").alias("as_of"))
    failed = c.where("c_custkey % 11 = 0").select("company", F.lit(5).alias("attempts"), F.lit("2026-01-01").alias("last"))
    return enrich.research_targets(c.where("c_custkey % 2 = 0"), known, failed, "2026-08-22")


@query("SELECT count(*) AS total, count(*) FILTER (c_custkey % 2 = 0) AS registered, count(*) FILTER (c_custkey % 6 = 0) AS active, count(*) FILTER (c_custkey % 2 = 1) AS missing FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    registered = c.where("c_custkey % 2 = 0").select(F.upper("c_name").alias("company_name"), F.when(F.col("c_custkey") % 3 == 0, " True").otherwise("false").alias("active"))
    return stats.coverage(c.where("c_custkey % 3 = 0").select(F.col("c_name").alias("company")), registered)


# --- registry ---
_FINDINGS = ("scanned; no open roles", "no ATS detected", "defunct since 2024", "active board", "dark-triage pending")


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    finding = F.element_at(F.array(*map(F.lit, _FINDINGS)), (k % 5 + 1).cast("int"))
    day = F.date_format(F.date_sub(F.lit("2026-08-22").cast("date"), (k % 40).cast("int")), "yyyy-MM-dd")
    return c.select(
        F.col("c_name").alias("company_name"), F.when(k % 2 == 0, "scrape").otherwise("lever").alias("ats_platform"), k.cast("string").alias("token"), F.when(k % 6 == 0, "https://boards.greenhouse.io/x").when(k % 7 == 0, "").otherwise("https://x.com").alias("api_url"),
        F.when(k % 3 == 0, "true").otherwise("false").alias("active"), F.concat(F.lit("auto-expand "), day, F.lit(": "), finding).alias("notes"), k.alias("_row"),
    )


_REGISTRY = f"""(SELECT c_name AS company_name, CASE WHEN c_custkey % 2 = 0 THEN 'scrape' ELSE 'lever' END AS ats_platform, CAST(c_custkey AS VARCHAR) AS token,
    CASE WHEN c_custkey % 6 = 0 THEN 'https://boards.greenhouse.io/x' WHEN c_custkey % 7 = 0 THEN '' ELSE 'https://x.com' END AS api_url, c_custkey % 3 = 0 AS active, (['{"', '".join(_FINDINGS)}'])[1 + c_custkey % 5] AS finding,
    DATE '2026-08-22' - CAST(c_custkey % 40 AS INTEGER) AS day, c_custkey AS _row FROM customer)"""
_POOL = "(finding IN ('scanned; no open roles', 'no ATS detected', 'dark-triage pending'))"


@query(
    f"""SELECT 'unscannable' AS rule, company_name AS key, ats_platform AS detail FROM {_REGISTRY} WHERE active AND api_url = ''
    UNION ALL SELECT 'orphan', company_name, concat('auto-expand ', strftime(day, '%Y-%m-%d'), ': ', finding) FROM {_REGISTRY} WHERE NOT active AND finding = 'active board'
    UNION ALL SELECT 'misconfigured', company_name, api_url FROM {_REGISTRY} WHERE active AND ats_platform = 'scrape' AND contains(api_url, 'greenhouse')
    UNION ALL SELECT 'pool', 'pool', CAST(count(*) AS VARCHAR) FROM {_REGISTRY} WHERE NOT active AND {_POOL} HAVING count(*) < 50"""
)
def registry_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.violations(_registry(spark, sf_dir))


@query(f"SELECT company_name, DATE '2026-08-22' - day AS age FROM {_REGISTRY} WHERE {_POOL} AND DATE '2026-08-22' - day >= 14 ORDER BY age DESC, _row LIMIT 25")
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = registry.work_queue(_registry(spark, sf_dir), "auto-expand", "2026-08-22", 14, 25)
    return due.select("company_name", F.datediff(F.lit("2026-08-22").cast("date"), registry.stamped_on("notes", "auto-expand")).cast("long").alias("age"))


@query(
    f"""SELECT company_name, CASE WHEN _row % 4 = 1 THEN 'ashby' ELSE ats_platform END AS ats_platform,
    CASE WHEN _row % 4 = 1 AND _row % 5 = 0 THEN concat('hunt 2026-08-21: ours | hunt2 2026-08-22: theirs | auto-expand ', strftime(day, '%Y-%m-%d'), ': ', finding)
         WHEN _row % 4 = 1 THEN concat('hunt 2026-08-21: ours | auto-expand ', strftime(day, '%Y-%m-%d'), ': ', finding)
         WHEN _row % 5 = 0 THEN concat('hunt2 2026-08-22: theirs | auto-expand ', strftime(day, '%Y-%m-%d'), ': ', finding)
         ELSE concat('auto-expand ', strftime(day, '%Y-%m-%d'), ': ', finding) END AS notes FROM {_REGISTRY}"""
)
def three_way_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _registry(spark, sf_dir)
    mine, theirs = F.col("_row") % 4 == 1, F.col("_row") % 5 == 0
    ours = base.withColumn("ats_platform", F.when(mine, "ashby").otherwise(F.col("ats_platform"))).withColumn("notes", F.when(mine, F.lit("hunt 2026-08-21: ours")).otherwise(F.col("notes")))
    target = base.withColumn("notes", F.when(theirs, F.concat(F.lit("hunt2 2026-08-22: theirs | "), "notes")).otherwise(F.col("notes")))
    return registry.three_way_merge(base, ours.where("_row % 4 <> 3"), target).select("company_name", "ats_platform", "notes")


# --- profiles ---
def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiled(jobs(spark, sf_dir))


#: The oracle's engine knows no look-around; over the sample texts these say the same.
_PLAIN = {"R": r"\b[rR]\b,", "Java": r"\bjava\b", "Excel": r"\bexcel\b", "Tableau": r"\btableau\b", "Looker": r"\blooker\b [^s]", "SAP ERP": r"\bsap\b", "Hex/Mode": r"\bhex\b"}
_SKILLS = "list_filter([" + ", ".join(f"CASE WHEN {has('both_', '(?i)' + _PLAIN.get(name, p))} THEN {q(name)} END" for rules in L.SKILLS.values() for name, p in rules) + "], lambda x: x IS NOT NULL)"
_FAMILY = "CASE " + " ".join(f"WHEN {has('title', '(?i)' + p.replace('(?! ?o)', ''))} THEN {q(name)}" for name, p in L.FAMILIES) + " " + " ".join(f"WHEN {has('left(description, 400)', '(?i)' + p.replace('(?! ?o)', ''))} THEN {q(name)}" for name, p in L.FAMILIES) + " ELSE 'Other' END"
_PROFILES = f"(SELECT *, {_SKILLS} AS skills, {_FAMILY} AS family, CASE WHEN {has('title', L.LEAD_TITLE)} THEN 'Lead' ELSE 'IC' END AS track FROM (SELECT *, concat(title, ' ', description) AS both_ FROM {JOBS_SQL}))"
_YEARS = "CASE _ord % 12 WHEN 0 THEN 5 WHEN 2 THEN 3 WHEN 4 THEN 2 WHEN 5 THEN 4 WHEN 6 THEN 7 END"


@query(f"SELECT _ord, array_to_string(skills, '|') AS skills, family, track, CAST({_YEARS} AS BIGINT) AS years FROM {_PROFILES}")
def role_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir).select("_ord", F.array_join("profile.skills.name", "|").alias("skills"), "profile.family", "profile.track", F.col("profile.years").cast("long").alias("years"))


_DEGREES = {0: ("BSc", "required", "CS"), 1: ("MSc", "required", "Statistics"), 4: ("BSc", "preferred", "Economics"), 6: ("MSc", "preferred", ""), 8: ("BSc", "required", "Engineering")}
#: The words around the mention reach back into the title, where "Developer" speaks of building.
_AI = "CASE WHEN _ord % 12 = 5 THEN CASE WHEN contains(lower(title), 'develop') THEN 'ai-efficiency,ai-automation,ai-building' ELSE 'ai-efficiency,ai-automation' END ELSE '' END"


@query("SELECT _ord % 12 AS text, CASE _ord % 12 " + " ".join(f"WHEN {k} THEN '{'/'.join(v)}'" for k, v in _DEGREES.items()) + f" END AS degree, {_AI} AS ai, count(*) AS n FROM {JOBS_SQL} GROUP BY ALL")
def degrees_and_ai(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("profile.degree")
    flat = F.when(d.isNotNull(), F.concat_ws("/", d["level"], d["status"], F.array_join(d["fields"], ",")))
    return _profiles(spark, sf_dir).groupBy((F.col("_ord") % 12).alias("text"), flat.alias("degree"), F.array_join("profile.ai.token", ",").alias("ai")).agg(F.count(F.lit(1)).alias("n"))


_CLUSTER = "CASE " + " ".join(f"WHEN skill IN ({', '.join(q(n) for c, rules in L.SKILLS.items() for n, _ in rules if L.SKILL_CLUSTER.get(n, L.CATEGORY_CLUSTER.get(c)) == k)}) THEN {q(k)}" for k, _ in L.CLUSTERS) + " END"
_TOP = "SELECT {g}, skill, n FROM (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY n DESC, o, skill) AS p FROM (SELECT {g}, skill, count(*) AS n, min(_ord) AS o FROM {rows} GROUP BY ALL)) WHERE p <= {k}"


@query(_TOP.format(g="cluster", k=8, rows=f"(SELECT *, {_CLUSTER} AS cluster FROM (SELECT _ord, unnest(skills) AS skill FROM {_PROFILES})) WHERE cluster IS NOT NULL"))
def demand_by_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.demand_by_cluster(_profiles(spark, sf_dir)).select("cluster", "skill", "n")


@query("WITH f AS (" + _TOP.format(g="family", k=6, rows=f"(SELECT _ord, family, unnest(skills) AS skill FROM {_PROFILES}) WHERE skill NOT IN ('Dashboards', 'Statistics')") + f") SELECT family, jobs, skill, n FROM (SELECT family, count(*) AS jobs FROM {_PROFILES} GROUP BY 1) LEFT JOIN f USING (family)")
def demand_by_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.demand_by_family(_profiles(spark, sf_dir))


_AXES = f"(SELECT *, unnest(['platform', 'country']) AS axis, unnest([ats_platform, country_code]) AS value, {_YEARS} AS years, _ord % 12 IN (0, 1, 8) AS deg, _ord % 12 = 5 AS ai FROM {_PROFILES})"


@query(
    f"""SELECT axis, value, count(DISTINCT company) AS companies, count(*) AS jobs, round_even(count(*) FILTER (deg) / count(*), 2) AS degree_required_rate, round_even(count(*) FILTER (track = 'Lead') / count(*), 2) AS lead_share,
    round_even(count(*) FILTER (ai) / count(*), 2) AS ai_mention_rate, CAST(list_sort(list(years) FILTER (years IS NOT NULL))[1 + len(list(years) FILTER (years IS NOT NULL)) // 2] AS BIGINT) AS median_years FROM {_AXES} GROUP BY ALL"""
)
def demand_by_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _profiles(spark, sf_dir).withColumn("platform", F.col("ats_platform")).withColumn("country", F.col("country_code"))
    return stats.by_axes(rows, ["platform", "country"]).select("axis", "value", "companies", "jobs", "degree_required_rate", "lead_share", "ai_mention_rate", F.col("median_years").cast("long").alias("median_years"))


_FOLD = "array_to_string(list_transform({}, lambda x: x.k || '=' || x.n), ',')"
_BY = "(SELECT company, list({{'k': k, 'n': n}} ORDER BY k) AS l FROM (SELECT company, {0} AS k, count(*) AS n FROM {1} GROUP BY ALL) GROUP BY 1)"
_TOP_SKILLS = "(SELECT company, string_agg(skill, '|' ORDER BY n DESC, skill) AS skills FROM (" + _TOP.format(g="company", k=15, rows=f"(SELECT company, _ord, unnest(skills) AS skill FROM {_PROFILES})") + ") GROUP BY 1)"
_FIRST_TITLES = f"(SELECT company, string_agg(title, '|' ORDER BY _ord) AS titles FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY _ord) AS p FROM {JOBS_SQL}) WHERE p <= 10 GROUP BY 1)"


_ASKED_DEGREE = "CASE _ord % 12 " + " ".join(f"WHEN {k} THEN '{v[0]} ({v[1]})'" for k, v in _DEGREES.items()) + " END"
_ASKED_AI = "CASE WHEN _ord % 12 <> 5 THEN [] WHEN contains(lower(title), 'develop') THEN ['AI for efficiency', 'AI for automation', 'Building with AI'] ELSE ['AI for efficiency', 'AI for automation'] END"
_ASKS = "(SELECT company, string_agg(v || '=' || n, '|' ORDER BY n DESC, v) AS l FROM (SELECT company, v, count(*) AS n FROM (SELECT company, _ord, {0} AS v FROM {1}) WHERE v IS NOT NULL GROUP BY company, v QUALIFY row_number() OVER (PARTITION BY company ORDER BY n DESC, min(_ord), v) <= 5) GROUP BY 1)"


@query(
    f"""SELECT j.company, j.jobs, j.asked, j.years[len(j.years) // 2 + 1] AS median_years, {_FOLD.format('f.l')} AS families, {_FOLD.format('t.l')} AS tracks, coalesce(s.skills, '') AS skills, i.titles, coalesce(d.l, '') AS degrees, coalesce(a.l, '') AS ai
    FROM (SELECT company, count(*) AS jobs, count({_YEARS}) AS asked, list_sort(list({_YEARS}) FILTER ({_YEARS} IS NOT NULL)) AS years FROM {JOBS_SQL} GROUP BY 1) j
    JOIN {_BY.format('family', _PROFILES)} f USING (company) JOIN {_BY.format('track', _PROFILES)} t USING (company)
    LEFT JOIN {_TOP_SKILLS} s USING (company) JOIN {_FIRST_TITLES} i USING (company) LEFT JOIN {_ASKS.format(_ASKED_DEGREE, JOBS_SQL)} d USING (company) LEFT JOIN {_ASKS.format(f'unnest({_ASKED_AI})', JOBS_SQL)} a USING (company)"""
)
def company_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias(c)
    asks = lambda c: F.array_join(F.transform(c, lambda e: F.concat_ws("=", e["value"], e["n"].cast("string"))), "|")
    found = stats.fingerprints(_profiles(spark, sf_dir))
    return found.select(
        "company", "jobs", "asked", "median_years", flat("families"), flat("tracks"), F.array_join("skills", "|").alias("skills"), F.array_join("titles", "|").alias("titles"), asks("degree_asks").alias("degrees"), asks("ai_asks").alias("ai"),
    )


@query(
    f"""SELECT 'total' AS label, 'postings' AS token, count(*) AS n FROM {JOBS_SQL} UNION ALL SELECT 'total', 'with_skills', count(*) FILTER (len(skills) > 0) FROM {_PROFILES}
    UNION ALL SELECT v, CASE v WHEN 'AI for efficiency' THEN 'ai-efficiency' WHEN 'AI for automation' THEN 'ai-automation' ELSE 'ai-building' END, count(*) FROM (SELECT unnest({_ASKED_AI}) AS v FROM {JOBS_SQL}) GROUP BY ALL"""
)
def tag_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _profiles(spark, sf_dir)
    t = stats.totals(rows)
    total = t.select(F.explode(F.array(*(F.struct(F.lit("total").alias("label"), F.lit(k).alias("token"), F.col(c).alias("n")) for k, c in (("postings", "total"), ("with_skills", "with_skills"))))).alias("t")).select("t.*")
    return total.unionByName(stats.tag_counts(rows, F.col("profile.ai")))


@query(
    """WITH log AS (SELECT o_orderkey AS i, CASE WHEN o_custkey % 5 < 2 THEN 'error' WHEN o_custkey % 5 = 2 THEN 'failed' ELSE 'ok' END AS result FROM orders),
    runs AS (SELECT i - row_number() OVER (PARTITION BY result = 'error' ORDER BY i) AS g, * FROM (SELECT row_number() OVER (ORDER BY i) AS i, result FROM log))
    SELECT (SELECT max(n) FROM (SELECT count(*) AS n FROM runs WHERE result = 'error' GROUP BY g)) AS streak, count(*) FILTER (result = 'ok') AS ok, count(*) FILTER (result = 'failed') AS failed FROM log"""
)
def attempt_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest row of errors in a log of attempts, beside its tallies."""
    k = F.col("o_custkey") % 5
    log = dealt(read(spark, sf_dir, "orders"), "o_orderkey").select(F.col("o_orderkey").alias("_ord"), F.when(k < 2, "error").when(k == 2, "failed").otherwise("ok").alias("result"))
    said = lambda result: (F.col("result") == result).cast("bigint").alias(result)
    return state.longest_run(log, "_ord", F.col("result") == "error", said("ok"), said("failed"))


# --- sources and the whole run ---
_ACCEPTED = f"_ord IN (SELECT _ord FROM {_CLASSES} WHERE decision = 'accept')"
_BOARD_FAMILY = _FAMILY.replace("description", "squeezed")


@query(
    rf"""WITH o AS {_merged_sql(_DAY1)}, n AS {_merged_sql(_ACCEPTED)}, failed AS (SELECT DISTINCT company FROM {JOBS_SQL} WHERE _ord % 70 = 0),
    after_ AS (SELECT coalesce(o.mkey, n.mkey) AS mkey, coalesce(o.company, n.company) AS company, coalesce(o.title, n.title) AS title, CASE WHEN n.mkey IS NULL THEN o.location ELSE n.location END AS location, CASE WHEN n.mkey IS NULL THEN o.description ELSE n.description END AS description,
        CASE WHEN n.mkey IS NULL OR (o.posted_date <> '' AND n.posted_date = '') THEN o.posted_date ELSE n.posted_date END AS posted_date, CASE WHEN o.mkey IS NULL THEN '1998-08-01' ELSE '1998-07-30' END AS first_seen, CASE WHEN n.mkey IS NULL THEN '1998-07-30' ELSE '1998-08-01' END AS last_seen
        FROM o FULL JOIN n ON o.mkey = n.mkey),
    alive AS (SELECT *, CASE WHEN posted_date <> '' THEN posted_date ELSE first_seen END AS fresh FROM after_ WHERE CASE WHEN posted_date <> '' THEN posted_date ELSE first_seen END >= '1998-07-18' AND (last_seen >= '1998-07-31' OR company IN (SELECT company FROM failed))),
    board AS (SELECT *, trim(regexp_replace(description, '\s+', ' ', 'g')) AS squeezed, date_diff('day', CAST(nullif(posted_date, '') AS DATE), CAST(first_seen AS DATE)) AS lag FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY fresh DESC, mkey) AS p FROM alive) WHERE p <= 8)
    SELECT mkey, company, title, {_CITY} AS city, CASE WHEN lag <= -3 THEN 'reposted' WHEN age <= 1 THEN 'new' WHEN age >= 60 THEN '60+ days' WHEN age >= 45 THEN '45+ days' ELSE '' END AS flag, posted_date, first_seen, {_BOARD_FAMILY} AS family,
    squeezed AS summary FROM (SELECT *, date_diff('day', CAST(fresh AS DATE), DATE '1998-08-01') AS age FROM board)"""
)
def daily_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: postings to board, with yesterday's state."""
    done = _daily(spark, sf_dir)
    board = daily.board_view(done.board, "1998-08-01")
    return board.select("mkey", "company", "title", "city", "flag", "posted_date", "first_seen", F.col("profile.family").alias("family"), "summary")


def _daily(spark: SparkSession, sf_dir: str, counters: stats.Counters | None = None) -> daily.Run:
    from .sources.tables import STATE, empty

    rows = jobs(spark, sf_dir)
    before = state.upsert_matched(empty(spark, STATE["matched"]), _merged(spark, sf_dir, _DAY1), "1998-07-30")
    sent = rows.where("_ord % 50 = 0").select(seen_id().alias("seen_id"))
    failed = rows.where("_ord % 70 = 0").select("company")
    return daily.run(rows, before, sent, failed, "1998-08-01", counters=counters)


@query(
    f"""WITH o AS {_merged_sql(_DAY1)}, n AS {_merged_sql(_ACCEPTED)}, jobs AS {JOBS_SQL}, classes AS {_CLASSES}, failed AS (SELECT DISTINCT company FROM jobs WHERE _ord % 70 = 0), sent AS (SELECT DISTINCT {_SEEN} AS s FROM jobs WHERE _ord % 50 = 0),
    after_ AS (SELECT *, CASE WHEN posted_date <> '' THEN posted_date ELSE first_seen END AS fresh FROM (SELECT coalesce(o.mkey, n.mkey) AS mkey, coalesce(o.company, n.company) AS company, list_concat(coalesce(o.ids, []), coalesce(n.ids, [])) AS ids,
        CASE WHEN n.mkey IS NULL OR (o.posted_date <> '' AND n.posted_date = '') THEN o.posted_date ELSE n.posted_date END AS posted_date, CASE WHEN o.mkey IS NULL THEN '1998-08-01' ELSE '1998-07-30' END AS first_seen, CASE WHEN n.mkey IS NULL THEN '1998-07-30' ELSE '1998-08-01' END AS last_seen
        FROM o FULL JOIN n ON o.mkey = n.mkey)),
    known AS (SELECT DISTINCT mkey FROM (SELECT mkey, unnest(ids) AS s FROM after_) JOIN sent USING (s)),
    email AS (SELECT row_number() OVER (PARTITION BY company ORDER BY fresh DESC, mkey) AS p FROM after_ ANTI JOIN known USING (mkey) WHERE last_seen = '1998-08-01' AND fresh >= '1998-07-31'),
    board AS (SELECT row_number() OVER (PARTITION BY company ORDER BY fresh DESC, mkey) AS p FROM after_ WHERE fresh >= '1998-07-18' AND (last_seen >= '1998-07-31' OR company IN (SELECT company FROM failed)))
    SELECT name, CAST(n AS BIGINT) AS n FROM (
    SELECT 'scanned' AS name, count(DISTINCT o_custkey) AS n FROM orders UNION ALL SELECT 'failed', count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 7 = 0
    UNION ALL SELECT 'fetched', count(*) FROM jobs UNION ALL SELECT 'matched', count(*) FROM classes UNION ALL SELECT 'accepted', count(*) FROM classes WHERE decision = 'accept' UNION ALL SELECT 'merged', count(*) FROM n
    UNION ALL SELECT 'new', count(*) FROM email WHERE p <= 3 UNION ALL SELECT 'board', count(*) FROM board WHERE p <= 8
    UNION ALL SELECT 'path_' || p, (SELECT count(*) FROM classes WHERE path = p) FROM (VALUES ('keyword'), ('keyword_nollm'), ('llm_cache'), ('llm'), ('llm_failed_fallback')) v(p))"""
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's counters, taken while its outputs are written once; and of the responses, while their outcomes are."""
    from .query_sources import broken_bronze
    from .sources.payloads import listed, responses

    counters = stats.Counters()
    done = _daily(spark, sf_dir, counters)
    daily.outputs(done).write.format("noop").mode("overwrite").save()
    done.matched.unpersist()
    listed(daily.counted_responses(responses(broken_bronze(spark, sf_dir), "2026-08-22"), counters), "2026-08-22", parts(read(spark, sf_dir, "orders"))).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(counters.read().items()), "name string, n bigint")


_EVENTS = "FROM events WHERE value IS NOT NULL"


@query(f"SELECT date_trunc('day', ts) AS start, date_trunc('day', ts) + INTERVAL 1 DAY AS end, event_type, count(*) AS n, round(sum(value), 2) AS total {_EVENTS} GROUP BY ALL")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(read(spark, sf_dir, "events").where("value is not null"), "ts", ["event_type"], "1 day").withColumn("total", F.round("total", 2))


@query(
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM e) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS end, count(*) AS n FROM s GROUP BY user_id, i"""
)
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(read(spark, sf_dir, "events"), "ts", "user_id", "6 hours")


# --- the relational surface that Spark gives ---
@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def pricing_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    return rows.rollup("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query("SELECT n_name, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY CUBE (n_name, c_mktsegment)")
def orders_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    rows = read(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.cube("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


from . import query_sources  # noqa: E402, F401  (registers more)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""Raw board responses to postings. A platform is a schema, the way to its list, and one expression per field.

Bronze rows hold one response page each: company_name, ats_platform, token, api_url, page_no, body, _row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import epoch_date, guessed_epoch_date, iso_date, relative_date
from ..functions.identity import host, is_agency
from ..functions.places import country_code
from ..functions.text import first_filled, join_filled, snippet, squeeze, strip_html
from .tables import JOB, order

FIELDS = ("title", "location", "country_code", "url", "posted_date", "job_id", "description")


#: Platforms whose descriptions are HTML cut to a length, those whose are HTML, and those whose dates are ISO or English text.
_SNIPPETS = ("comeet", "greenhouse", "lever", "recruitee", "ashby", "custom_json", "oraclehcm", "eightfold", "phenom")
_HTML = ("workable", "breezy")
_DATED = ("comeet", "greenhouse", "smartrecruiters", "recruitee", "ashby", "custom_json", "oraclehcm", "eightfold", "phenom")


@dataclass(frozen=True)
class Platform:
    """schema: of the whole body; items: its list of postings; fields: from `p`, which picks a value of one posting by its path, to expressions by name; bronze columns can be used beside it."""

    schema: str
    items: str
    fields: Callable[[Callable[[str], Column]], dict[str, Column]] = lambda p: {}
    once_per_id: bool = False


def _upper(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def _first_ten(*columns: Column) -> Column:
    return squeeze(F.substring(first_filled(*columns), 1, 10))


def _sections(details: Column) -> Column:
    named = F.transform(details, lambda s: F.struct(F.coalesce(s["name"], F.lit("")).alias("n"), strip_html(s["value"]).alias("v")))
    return F.array_join(F.transform(F.filter(named, lambda s: s["v"] != ""), lambda s: F.when(s["n"] != "", F.concat_ws(": ", s["n"], s["v"])).otherwise(s["v"])), " ")


def _listed(c: Column, separator: str = ", ") -> Column:
    return F.array_join(F.filter(c, lambda x: F.coalesce(x, F.lit("")) != ""), separator)


def platforms(run_date: Column | str) -> dict[str, Platform]:
    site = F.split(F.regexp_extract("api_url", r"^[a-z]+://[^/]+/(.*)$", 1), "/")
    level = lambda p: F.when(F.coalesce(p("experience_level"), F.lit("")) != "", F.concat(F.lit("Experience level: "), p("experience_level"), F.lit(".")))
    tail = lambda p: F.when(p("externalPath").contains("_"), F.substring_index(p("externalPath"), "_", -1)).otherwise(p("externalPath"))
    friendly = lambda p: first_filled(p("friendly_id"), p("_id"))
    country = lambda p: F.coalesce(F.get_json_object(p("location.country"), "$.name"), F.when(~p("location.country").startswith("{"), p("location.country")))
    eightfold = Platform(
        "positions array<struct<id:string,ats_job_id:string,name:string,location:string,locations:array<string>,canonicalPositionUrl:string,positionUrl:string,t_create:string,create_date:string,job_description:string,description:string>>",
        "positions",
        lambda p: {"title": squeeze(p("name")), "location": squeeze(first_filled(p("location"), _listed(p("locations")))), "url": first_filled(p("canonicalPositionUrl"), p("positionUrl")),
         "posted_date": first_filled(p("t_create"), p("create_date")), "job_id": first_filled(p("id"), p("ats_job_id")), "description": first_filled(p("job_description"), p("description"))},
        once_per_id=True,
    )
    return {
        "comeet": Platform(
            "array<struct<name:string,uid:string,time_updated:string,experience_level:string,url_comeet_hosted_page:string,url_active_page:string,location:struct<city:string,name:string,state:string,country:string>,details:array<struct<name:string,value:string>>>>",
            "",
            lambda p: {"title": squeeze(p("name")), "location": squeeze(join_filled(", ", first_filled(p("location.city"), p("location.name")), p("location.state"), p("location.country"))),
             "country_code": _upper(p("location.country")), "url": first_filled(p("url_comeet_hosted_page"), p("url_active_page")), "posted_date": p("time_updated"), "job_id": p("uid"),
             "description": F.concat_ws(" ", level(p), F.nullif(_sections(p("details")), F.lit("")))},
        ),
        "greenhouse": Platform(
            "jobs array<struct<title:string,id:string,absolute_url:string,updated_at:string,first_published:string,content:string,location:struct<name:string>>>",
            "jobs",
            lambda p: {"title": squeeze(p("title")), "location": squeeze(p("location.name")), "url": p("absolute_url"), "posted_date": first_filled(p("updated_at"), p("first_published")), "job_id": p("id"), "description": p("content")},
        ),
        "lever": Platform(
            "array<struct<text:string,id:string,hostedUrl:string,applyUrl:string,createdAt:string,country:string,descriptionPlain:string,description:string,categories:struct<location:string,allLocations:array<string>>>>",
            "",
            lambda p: {"title": squeeze(p("text")), "location": squeeze(first_filled(_listed(p("categories.allLocations")), p("categories.location"))),
             "country_code": F.when(F.length(F.trim(p("country"))).isin(2, 3), _upper(p("country"))), "url": first_filled(p("hostedUrl"), p("applyUrl")), "posted_date": epoch_date(p("createdAt")), "job_id": p("id"),
             "description": first_filled(p("descriptionPlain"), p("description"))},
        ),
        "smartrecruiters": Platform(
            "content array<struct<id:string,name:string,releasedDate:string,location:struct<fullLocation:string,city:string,region:string,country:string>>>",
            "content",
            lambda p: {"title": squeeze(p("name")), "location": squeeze(first_filled(p("location.fullLocation"), join_filled(", ", p("location.city"), p("location.region"), p("location.country")))), "country_code": _upper(p("location.country")),
             "url": F.concat(F.lit("https://jobs.smartrecruiters.com/"), F.coalesce("token", F.lit("")), F.lit("/"), F.coalesce(p("id"), F.lit(""))), "posted_date": p("releasedDate"), "job_id": p("id")},
        ),
        "recruitee": Platform(
            "offers array<struct<title:string,id:string,location:string,country_code:string,careers_url:string,careers_apply_url:string,published_at:string,description:string>>",
            "offers",
            lambda p: {"title": squeeze(p("title")), "location": squeeze(p("location")), "country_code": _upper(p("country_code")), "url": first_filled(p("careers_url"), p("careers_apply_url")), "posted_date": p("published_at"), "job_id": p("id"), "description": p("description")},
        ),
        "ashby": Platform(
            "jobs array<struct<title:string,id:string,location:string,secondaryLocations:array<struct<location:string>>,address:struct<postalAddress:struct<addressCountry:string,addressRegion:string>>,jobUrl:string,applyUrl:string,publishedAt:string,descriptionPlain:string>>",
            "jobs",
            lambda p: {"title": squeeze(p("title")),
             "location": squeeze(_listed(F.concat(F.array(p("location")), F.coalesce(p("secondaryLocations.location"), F.array().cast("array<string>")), F.array(p("address.postalAddress.addressRegion"))))),
             "country_code": country_code(p("address.postalAddress.addressCountry")), "url": first_filled(p("jobUrl"), p("applyUrl")), "posted_date": p("publishedAt"), "job_id": p("id"), "description": p("descriptionPlain")},
        ),
        "workday": Platform(
            "jobPostings array<struct<title:string,externalPath:string,bulletFields:array<string>,locationsText:string,postedOn:string>>",
            "jobPostings",
            lambda p: {"title": squeeze(p("title")), "location": squeeze(p("locationsText")),
             "url": F.concat(F.lit("https://"), host("api_url"), F.lit("/"), F.coalesce(F.try_element_at(site, F.lit(4)), F.lit("")), F.coalesce(p("externalPath"), F.lit(""))),
             "posted_date": relative_date(p("postedOn"), run_date), "job_id": F.coalesce(F.try_element_at(p("bulletFields"), F.lit(1)), tail(p))},
        ),
        "custom_json": Platform(
            "jobs array<struct<title:string,normalized_location:string,location:string,country_code:string,job_path:string,posted_date:string,id_icims:string,id:string,description_short:string,description:string>>",
            "jobs",
            lambda p: {"title": squeeze(p("title")), "location": squeeze(first_filled(p("normalized_location"), p("location"))), "country_code": _upper(p("country_code")),
             "url": F.concat(F.lit("https://www.amazon.jobs"), F.coalesce(p("job_path"), F.lit(""))), "posted_date": p("posted_date"), "job_id": first_filled(p("id_icims"), p("id")), "description": first_filled(p("description_short"), p("description"))},
        ),
        "microsoft": Platform(
            "data struct<positions:array<struct<name:string,displayJobId:string,id:string,locations:array<string>,postedTs:string,creationTs:string>>>",
            "data.positions",
            lambda p: {"title": squeeze(p("name")), "location": squeeze(F.coalesce(F.try_element_at(p("locations"), F.lit(1)), F.lit("Israel"))), "country_code": F.lit("IL"),
             "url": F.concat(F.lit("https://jobs.careers.microsoft.com/global/en/job/"), first_filled(p("displayJobId"), p("id"))), "posted_date": guessed_epoch_date(first_filled(p("postedTs"), p("creationTs"))), "job_id": first_filled(p("displayJobId"), p("id"))},
        ),
        "workable": Platform(
            "jobs array<struct<title:string,city:string,state:string,country:string,country_code:string,url:string,application_url:string,shortcode:string,id:string,created_at:string,description:string>>",
            "jobs",
            lambda p: {"title": squeeze(p("title")), "location": squeeze(join_filled(", ", p("city"), p("state"), p("country"))), "country_code": _upper(p("country_code")),
             "url": first_filled(p("url"), p("application_url"), F.when((F.coalesce("token", F.lit("")) != "") & (F.coalesce(p("shortcode"), F.lit("")) != ""), F.concat(F.lit("https://apply.workable.com/"), F.col("token"), F.lit("/j/"), p("shortcode"), F.lit("/")))),
             "posted_date": _first_ten(p("created_at")), "job_id": first_filled(p("id"), p("shortcode")), "description": p("description")},
        ),
        "breezy": Platform(
            "array<struct<name:string,friendly_id:string,_id:string,url:string,published_date:string,creation_date:string,description:string,location:struct<city:string,name:string,country:string>>>",
            "",
            lambda p: {"title": squeeze(p("name")), "location": squeeze(join_filled(", ", first_filled(p("location.city"), p("location.name")), country(p))), "url": first_filled(p("url"), F.concat(F.substring_index("api_url", "/json", 1), F.lit("/p/"), friendly(p))),
             "posted_date": _first_ten(p("published_date"), p("creation_date")), "job_id": friendly(p), "description": p("description")},
        ),
        "bamboohr": Platform(
            "result array<struct<id:string,jobOpeningName:string,datePosted:string,location:struct<city:string,state:string,addressCountry:string>>>",
            "result",
            lambda p: {"title": squeeze(p("jobOpeningName")), "location": squeeze(join_filled(", ", p("location.city"), p("location.state"), p("location.addressCountry"))), "url": F.concat(F.lit("https://"), host("api_url"), F.lit("/careers/"), F.coalesce(p("id"), F.lit(""))),
             "posted_date": _first_ten(p("datePosted")), "job_id": p("id")},
        ),
        "oraclehcm": Platform(
            "items array<struct<requisitionList:array<struct<Id:string,Title:string,PrimaryLocation:string,secondaryLocations:array<struct<Name:string>>,PostedDate:string,ExternalDescriptionStr:string,ShortDescriptionStr:string>>>>",
            "items[0].requisitionList",
            lambda p: {"title": squeeze(p("Title")), "location": squeeze(_listed(F.concat(F.array(p("PrimaryLocation")), F.coalesce(p("secondaryLocations.Name"), F.array().cast("array<string>"))), "; ")),
             "url": F.concat(F.lit("https://"), host("api_url"), F.lit("/hcmUI/CandidateExperience/en/sites/"), F.coalesce(F.nullif(F.regexp_extract("api_url", r"siteNumber=([A-Za-z0-9_]+)", 1), F.lit("")), F.lit("CX")), F.lit("/job/"), F.coalesce(p("Id"), F.lit(""))),
             "posted_date": p("PostedDate"), "job_id": p("Id"), "description": first_filled(p("ExternalDescriptionStr"), p("ShortDescriptionStr"))},
        ),
        "eightfold": eightfold,
        "phenom": eightfold,
        "jazzhr": Platform("none array<struct<id:string>>", "none"),
        "google_jobs": Platform(
            "jobs_results array<struct<job_id:string,apply_options:array<struct<link:string>>,company_name:string,title:string,location:string,share_link:string,description:string,detected_extensions:struct<posted_at:string>>>",
            "jobs_results",
            lambda p: {"company": F.trim(F.coalesce(p("company_name"), F.lit(""))), "title": F.trim(F.coalesce(p("title"), F.lit(""))), "location": F.trim(F.coalesce(p("location"), F.lit(""))),
             "url": first_filled(F.try_element_at(F.filter(p("apply_options.link"), lambda x: x != ""), F.lit(1)), p("share_link")), "posted_date": p("detected_extensions.posted_at"),
             "job_id": first_filled(p("job_id"), F.try_element_at(p("apply_options.link"), F.lit(1))), "description": F.substring(squeeze(p("description")), 1, 1400)},
        ),
    }


_COLUMNS = tuple(c.split(" ")[0] for c in JOB.split(", "))


def normalised(bronze: DataFrame) -> DataFrame:
    """Bronze with its platform's name as the readers spell it; write it partitioned by `platform`, and each reader prunes to its own rows."""
    return bronze.withColumn("platform", F.lower(F.trim("ats_platform")))


def responses(bronze: DataFrame, run_date: Column | str) -> DataFrame:
    """Bronze rows of known platforms with what they hold under `_jobs`: an array of raw postings, null where a body can't be read.

    A row is parsed by its own platform's schema alone, each into the same fields.
    """
    known = platforms(run_date)
    one = ", ".join(f"{f}:string" for f in ("company", *FIELDS))
    rows = normalised(bronze) if "platform" not in bronze.columns else bronze
    found = F.lit(None).cast(f"array<struct<{one}>>")
    for name, platform in known.items():
        found = F.when(F.col("platform") == name, _listing(platform)).otherwise(found)
    return rows.where(F.col("platform").isin(*known)).withColumn("page_no", F.coalesce("page_no", F.lit(0))).withColumn("_jobs", found)


def lost() -> Column:
    """Whether a response's body is missing or no JSON; a body without a list is merely empty."""
    return F.when(F.col("_jobs").isNotNull(), False).otherwise(F.try_parse_json("body").isNull())


def outcomes(found: DataFrame) -> DataFrame:
    """company_name, platform, n, status of each company among `responses`: ok, empty, or error where nothing could be read."""
    n = F.sum(F.when(F.col("_jobs").isNotNull(), F.size("_jobs")).otherwise(0).cast("bigint"))
    counted = found.groupBy("company_name", "platform").agg(n.alias("n"), F.bool_and(lost()).alias("lost"))
    return counted.select("company_name", "platform", "n", F.when(F.col("lost"), "error").when(F.col("n") > 0, "ok").otherwise("empty").alias("status"))


def postings(bronze: DataFrame, run_date: Column | str, parts: int | None = None) -> DataFrame:
    """Postings of all known platforms, unfiltered, in the order of registry row, page and place (`_ord`).

    One scan. Bodies that don't parse, or hold no list, give no postings. Google results without any id are dropped, and
    repeated ids of one company are kept once where a platform repeats them over pages.
    """
    return listed(responses(bronze, run_date), run_date, parts)


def listed(found: DataFrame, run_date: Column | str, parts: int | None = None) -> DataFrame:
    """The postings in `responses`. `parts`: in how many tasks repeats meet; without it Spark chooses by compressed size, of
    which texts that compress well leave few large tasks."""
    known, kind = platforms(run_date), F.col("platform")
    placed = found.select("platform", "_row", "page_no", F.posexplode("_jobs").alias("_at", "job"))
    raw = placed.select("job.*", "platform", F.when(kind == "phenom", "eightfold").otherwise(kind).alias("ats_platform"), order("_row", F.col("page_no"), F.col("_at")).alias("_ord"))
    # texts and dates that many platforms share are read here, once for all of them
    jobs = raw.withColumns({
        "description": F.when(kind.isin(*_SNIPPETS), snippet("description")).when(kind.isin(*_HTML), strip_html("description")).otherwise(F.col("description")),
        "posted_date": F.when(kind.isin(*_DATED), iso_date("posted_date")).otherwise(F.col("posted_date")),
    }).select(*_COLUMNS)
    google = F.col("ats_platform") == "google_jobs"
    jobs = jobs.where(~google | (F.col("job_id") != ""))
    once = (google | F.col("ats_platform").isin(*(n for n, p in known.items() if p.once_per_id))) & (F.col("job_id") != "")
    # where ids don't repeat, a posting's own place is its key
    within = F.struct(F.when(once & ~google, F.col("company")).alias("in"), F.when(once, F.col("job_id")).alias("id"), F.when(~once, F.col("_ord")).alias("place"))
    jobs = jobs.withColumn("_within", within)
    jobs = jobs.repartition(parts, "ats_platform", "_within") if parts else jobs
    first = F.row_number().over(Window.partitionBy("ats_platform", "_within").orderBy("_ord"))
    return jobs.withColumn("_first", first).where("_first = 1").drop("_first", "_within")


def _listing(platform: Platform) -> Column:
    """array<struct<company, …>>: a body's postings by its platform's fields; null where it doesn't parse."""
    schema = platform.schema if platform.schema.startswith("array<") else f"struct<{platform.schema.replace(' ', ':', 1)}>"
    body = F.from_json("body", schema)
    items = body
    if "[" in platform.items:
        items = F.try_element_at(body["items"], F.lit(1))["requisitionList"]
    elif platform.items:
        items = reduce(lambda c, n: c[n], platform.items.split("."), body)

    def filled(item: Column) -> Column:
        fields = platform.fields(lambda name: reduce(lambda c, n: c[n], name.split("."), item))
        own = fields.get("company", F.col("company_name"))
        return F.struct(F.coalesce(own, F.lit("")).alias("company"), *(F.coalesce(fields.get(f, F.lit("")), F.lit("")).alias(f) for f in FIELDS))

    return F.transform(items, filled)


def unknown_platforms(bronze: DataFrame, run_date: Column | str) -> DataFrame:
    """Companies whose platform nothing reads: their failure is theirs, not the run's."""
    return bronze.where(~F.lower(F.trim("ats_platform")).isin(*platforms(run_date), "scrape", "discovery")).select("company_name", "ats_platform").distinct().withColumn("error", F.concat(F.lit("unknown platform "), "ats_platform"))


def cached_postings(rows: DataFrame, cache: DataFrame) -> DataFrame:
    """Postings of `scrape` rows from a cache (company, jobs array): under the company's name, else under its token."""
    by_name = cache.select(F.col("company").alias("company_name"), F.col("jobs").alias("_own"))
    by_token = cache.select(F.col("company").alias("token"), F.col("jobs").alias("_other"))
    found = rows.join(by_name, "company_name", "left").join(by_token, "token", "left")
    jobs = found.select(*(["_row"] if "_row" in rows.columns else []), F.posexplode(F.when(F.size("_own") > 0, F.col("_own")).otherwise(F.col("_other"))).alias("_at", "job"))
    return jobs.select("job.*", *([order("_row", 0, F.col("_at")).alias("_ord")] if "_row" in rows.columns else []))


def discovered_postings(cache: DataFrame, run_date: Column | str, days: int = 21) -> DataFrame:
    """Discovered postings that are undated or young enough, without those of agencies."""
    cut = F.date_format(F.date_sub(F.to_date(F.lit(run_date)), days), "yyyy-MM-dd")
    young = (F.coalesce("posted_date", F.lit("")) == "") | (F.substring("posted_date", 1, 10) >= cut)
    return cache.where(young & ~is_agency("company"))

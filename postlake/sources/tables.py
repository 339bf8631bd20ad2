"""Schemas of the engine's tables, and readers that treat a missing snapshot as an empty table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

JOB = "company string, title string, location string, country_code string, url string, posted_date string, ats_platform string, job_id string, description string, _ord struct<row:bigint,page:bigint,place:bigint>"
REGISTRY = "company_name string, ats_platform string, token string, api_url string, active string, notes string"
BRONZE = "company_name string, ats_platform string, token string, api_url string, page_no int, body string, _row bigint"
STATE = {
    "sent": "seen_id string, company string, title string, location string, url string, first_sent string, last_seen string",
    "verdicts": "title_key string, verdict boolean, updated string",
    "company_info": "company string, summary string, updated string",
    "firmographics": "company string, record string, updated string",
    "research_failures": "company string, attempts int, last string",
    "matched": "mkey string, company string, title string, location string, url string, posted_date string, seniority string, sources array<string>, seen_ids array<string>, description string, first_seen string, last_seen string",
    "baseline": "company string, best_n bigint",
    "watermarks": "channel string, last_id bigint",
    "attempts": "company string, fails int, last string",
    "probes": "company string, sig bigint, il bigint",
}
FIRMOGRAPHICS = "sector string, sub_sector string, stage string, stage_note string, size_band string, employees_global string, founded string, business_model string, customer_type string, il_center string, as_of string"


def order(row: Column | str, page: Column | int = 0, place: Column | int = 0) -> Column:
    """A posting's place in its source, of the one type that all sources share."""
    whole = lambda c: (c if isinstance(c, Column) else F.col(c) if isinstance(c, str) else F.lit(c)).cast("bigint")
    return F.struct(whole(row).alias("row"), whole(page).alias("page"), whole(place).alias("place"))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def load_registry(spark: SparkSession, path: str, active_only: bool = True) -> DataFrame:
    """The company registry from CSV; fields may hold line breaks."""
    rows = spark.read.csv(path, schema=REGISTRY, header=True, multiLine=True, escape='"')
    return rows.where(F.lower(F.trim("active")) == "true") if active_only else rows


def registry_lines(spark: SparkSession, path: str) -> DataFrame:
    """All registry rows from CSV with `_broken`: the raw line of a row that has more or fewer fields than the header, else null."""
    return spark.read.csv(path, schema=f"{REGISTRY}, _broken string", columnNameOfCorruptRecord="_broken", header=True, multiLine=True, escape='"')


def load_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The latest version of a state table; an empty table where none was written."""
    return latest(spark, f"{root}/{name}", STATE[name])


def save_state(df: DataFrame, root: str, name: str, batch: int | None = None, keep: int = 3) -> int:
    """Publishes the next version of a state table, see `publish`."""
    return publish(df, f"{root}/{name}", batch=batch, keep=keep)


def latest(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", **options) -> DataFrame:
    """The version of a published table that its pointer names; an empty table where there is none."""
    versions = _numbers(spark, folder, "current=")
    if not versions:
        return empty(spark, schema)
    return spark.read.schema(schema).options(**_READ[kind], **options).format(kind).load(f"{folder}/v={versions[-1]}")


_READ = {"parquet": {}, "json": {}, "csv": {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "nullValue": "\\N"}}


def publish(df: DataFrame, folder: str, kind: str = "parquet", batch: int | None = None, keep: int = 3, **options) -> int:
    """Writes a table's next version (`kind`: parquet, csv or json), then points readers to it and removes older ones.

    A writer claims its version by making a file that no other could make, so two never write one. The pointer is the highest
    `current=<n>`, an empty file made in one step when the data are whole: a writer that dies before leaves what nobody reads,
    and of two writers the later version counts. The last `keep` versions stay for those that still read them; what
    lies before goes, with the leavings of dead writers. With `batch`, the number of a streaming batch, a batch published
    before isn't written again.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    done = path(f"{folder}/batch={batch}")
    if batch is not None and fs.exists(done):
        return _numbers(spark, folder, "current=")[-1]
    fs.mkdirs(path(folder))
    version = max([0, *(n for kind_ in ("v=", "claim=", "current=") for n in _numbers(spark, folder, kind_))]) + 1
    while True:
        try:
            fs.create(path(f"{folder}/claim={version}"), False).close()  # fails if it exists
            break
        except Exception:
            if not fs.exists(path(f"{folder}/claim={version}")):
                raise
            version += 1
    df.write.options(**_READ[kind], **options).format(kind).save(f"{folder}/v={version}")
    fs.create(path(f"{folder}/current={version}"), True).close()
    if batch is not None:
        fs.create(done, True).close()
    oldest = ([0] * keep + _numbers(spark, folder, "current="))[-keep]
    for name in ("current=", "v=", "claim="):  # the pointer first: nobody is led to what is half removed
        for n in _numbers(spark, folder, name):
            if n < oldest:
                fs.delete(path(f"{folder}/{name}{n}"), True)
    return version


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers n of a folder's entries `name`n, least first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removeprefix(name)) for n in found if n.startswith(name))

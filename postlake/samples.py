"""Posting data made from the star-schema tables by arithmetic, the same in Spark and in plain SQL, to run operators on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TITLES = (
    "Senior Data Analyst", "Data Analyst", "Software Engineer", "Analytics Team Lead", "Senior Data Scientist", "Junior Data Analyst", "Data Scientist, Product Analytics",
    "Senior Security Analyst", "BI Developer", "Head of Analytics", "Marketing Analyst", "Senior Machine Learning Engineer", "Office Manager", "Product Analyst Intern",
    "Senior Business Analyst, Software Solutions", "Director of Insights", "Staff Scientist", "Senior Financial Analyst", "Lead Data Analyst (BI)", "Quantitative Researcher",
    "Account Executive", "Reporting Analyst", "Principal Analyst, Growth", "Data Engineer",
)
LOCATIONS = ("Tel Aviv-Yafo, Israel", "Haifa", "New York, US", "Israel - Petah Tikva", "Remote", "Herzliya Pituach", "London", "Center District, Israel", "Berlin, Germany", "Be'er Sheva")
CODES = ("", "IL", "isr ", "", "US", "IS")
PLATFORMS = ("greenhouse", "lever", "scrape", "ashby", "comeet")
HOSTS = ("boards.greenhouse.io/acme", "www.acme.com/careers", "www.linkedin.com", "jobs.lever.co/globex", "t.me/", "supplant.me/open")
COMPANIES = ("Acme", "Globex", "Initech", "Hooli", "Umbrella", "Sqlink", "Vandelay")
SUFFIXES = ("", " Ltd", " Technologies", " Software Ltd.")
SKILLED = (
    "Requirements: 5+ years of experience with SQL, Python and Tableau. BSc in Computer Science required. Build dashboards for stakeholders.",
    "About the role: machine learning, deep learning and PyTorch models, NLP pipelines. MSc in Statistics, PhD an advantage.",
    "You will own dbt and Airflow pipelines on Snowflake and AWS. 3 years of experience. Fluent English.",
    "",
    "Analyze A/B test results and KPIs, report insights in Power BI and Excel. B.A. in Economics preferred. 2-4 years experience.",
    "Use ChatGPT and other AI tools to automate reporting workflows faster. SQL a must. At least 4 years.",
    "Lead projects, mentor analysts, present to business leaders. MBA an advantage. 7+ years of experience required.",
    "Founded 20 years ago, we sell software. Looker Studio, Google Analytics, Amplitude.",
    "Spark, Kafka, Databricks, BigQuery and Git. Degree in engineering. Data warehouse and data modeling.",
    "Our AI platform secures identities. Investigate trends, recommend actions, work closely with product.",
    "Forecasting, cohorts and churn analysis in R, SAS or Java. Statistics background.",
    "Jira, Salesforce and SEO. Team player with attention to detail and curiosity.",
)


def _spark_pick(values: tuple[str, ...], at: str) -> str:
    listed = ", ".join("'{}'".format(v.replace("\\", "\\\\").replace("'", "\\'")) for v in values)
    return f"element_at(array({listed}), cast(1 + {at} as int))"


def _sql_pick(values: tuple[str, ...], at: str) -> str:
    listed = ", ".join("'{}'".format(v.replace("'", "''")) for v in values)
    return f"([{listed}])[1 + {at}]"


def _columns(pick, day: str) -> dict[str, str]:
    return {
        "company": f"concat({pick(COMPANIES, 'o_custkey % 7')}, ' ', cast(o_custkey % 40 as varchar(9)), {pick(SUFFIXES, 'o_orderkey % 4')})",
        "title": pick(TITLES, "(o_orderkey * 7 + o_custkey) % 24"),
        "location": pick(LOCATIONS, "(o_orderkey + o_custkey) % 10"),
        "country_code": pick(CODES, "o_custkey % 6"),
        "url": f"concat('https://', {pick(HOSTS, 'o_orderkey % 6')}, '/jobs/', cast(o_orderkey as varchar(19)))",
        "posted_date": f"case when o_orderkey % 13 = 0 then '' else {day} end",
        "ats_platform": pick(PLATFORMS, "o_orderkey % 5"),
        "job_id": "case when o_orderkey % 11 = 0 then '' else cast(o_orderkey % 3000 as varchar(19)) end",
        "description": pick(SKILLED, "o_orderkey % 12"),
        "_ord": "o_orderkey",
    }


#: The postings as a SQL subquery over `orders`.
JOBS_SQL = "(SELECT " + ", ".join(f"{x} AS {n}" for n, x in _columns(_sql_pick, "strftime(o_orderdate, '%Y-%m-%d')").items()) + " FROM orders)"


def dealt(rows: DataFrame, by: str, most: int = 20_000) -> DataFrame:
    """The rows over all cores, about `most` to a task, those of equal `by` together.

    Texts written from a row cost far more than its bytes: a small file is one split, and shuffles of texts that compress
    well are coalesced by their compressed size. The number of tasks grows with the rows, so no task does.
    """
    return rows.repartition(parts(rows, most), by)


def parts(rows: DataFrame, most: int = 20_000) -> int:
    """How many tasks take about `most` of the rows each; at least one a core."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // most))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = dealt(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    picked = _columns(_spark_pick, "date_format(o_orderdate, 'yyyy-MM-dd')")
    return orders.select(*(F.expr(x.replace("varchar(9)", "string").replace("varchar(19)", "string")).alias(n) for n, x in picked.items()))

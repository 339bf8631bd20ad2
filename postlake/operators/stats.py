"""Demand statistics over role profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lexicons import CLUSTERS
from ..functions.profile import cluster
from .dedup import most_common

#: Fixed value: skills every description names; noise in the lists by family.
EVERYWHERE = ("Dashboards", "Statistics")


def skill_rows(profiles: DataFrame, *keep: str) -> DataFrame:
    """One row per posting and skill: `keep`, skill, category, cluster, _ord."""
    rows = profiles.select(*keep, "_ord", F.explode("profile.skills").alias("s"))
    return rows.select(*keep, "_ord", F.col("s.name").alias("skill"), F.col("s.category").alias("category"), cluster(F.col("s.name"), F.col("s.category")).alias("cluster"))


def demand_by_cluster(profiles: DataFrame, k: int = 8) -> DataFrame:
    """cluster, label, skill, n: the k skills asked for most in each chart."""
    labels = F.create_map(*(F.lit(x) for pair in CLUSTERS for x in pair))
    top = most_common(skill_rows(profiles).where("cluster is not null"), ["cluster"], "skill", k, "_ord")
    return top.select("cluster", F.try_element_at(labels, F.col("cluster")).alias("label"), "skill", "n")


def demand_by_family(profiles: DataFrame, k: int = 6) -> DataFrame:
    """family, jobs, skill, n: postings of each family and its k skills asked for most (null where it has none)."""
    jobs = profiles.groupBy(F.col("profile.family").alias("family")).agg(F.count(F.lit(1)).alias("jobs"))
    rows = skill_rows(profiles.withColumn("family", F.col("profile.family")), "family").where(~F.col("skill").isin(*EVERYWHERE))
    return jobs.join(most_common(rows, ["family"], "skill", k, "_ord"), "family", "left")


def tag_counts(profiles: DataFrame, tags: Column) -> DataFrame:
    """label, token, n of an array of tags."""
    return profiles.select(F.explode(tags).alias("t")).groupBy("t.label", "t.token").agg(F.count(F.lit(1)).alias("n"))


def totals(profiles: DataFrame) -> DataFrame:
    return profiles.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size("profile.skills") > 0).alias("with_skills"))


def by_axes(profiles: DataFrame, axes: list[str], k: int = 10) -> DataFrame:
    """axis, value, companies, jobs, median_years, degree_required_rate, lead_share, ai_mention_rate, top_skills.

    One scan: each posting becomes a row per axis, and aggregates are combined before the shuffle. The median is the
    upper one of the years asked for; it comes from counts per number of years, so no list of postings is gathered.
    """
    axis = F.explode(F.array(*(F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in axes)))
    lead, ai = F.col("profile.track") == "Lead", F.size("profile.ai") > 0
    rows = profiles.select(axis.alias("x"), "company", "_ord", "profile", lead.alias("lead"), ai.alias("ai"), (F.col("profile.degree.status") == "required").alias("deg")).select("x.*", "company", "_ord", "profile", "lead", "ai", "deg").where("value is not null")
    rate = lambda c: F.bround(F.count_if(c) / F.count(F.lit(1)), 2)
    main = rows.groupBy("axis", "value").agg(F.count_distinct("company").alias("companies"), F.count(F.lit(1)).alias("jobs"), rate(F.col("deg")).alias("degree_required_rate"), rate(F.col("lead")).alias("lead_share"), rate(F.col("ai")).alias("ai_mention_rate"))
    asked = rows.where("profile.years > 0").groupBy("axis", "value", F.col("profile.years").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("y", "n")))
    half = F.floor(F.aggregate("l", F.lit(0).cast("bigint"), lambda a, s: a + s["n"]) / 2)
    walk = F.aggregate(
        "l", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("y")),
        lambda a, s: F.struct((a["seen"] + s["n"]).alias("seen"), F.when(a["y"].isNull() & (a["seen"] + s["n"] > F.col("half")), s["y"]).otherwise(a["y"]).alias("y")), lambda a: a["y"],
    )
    median = asked.groupBy("axis", "value").agg(listed.alias("l")).withColumn("half", half).select("axis", "value", walk.alias("median_years"))
    top = most_common(rows.select("axis", "value", "_ord", F.explode("profile.skills.name").alias("skill")), ["axis", "value"], "skill", k, "_ord")
    best = top.groupBy("axis", "value").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "skill"))).alias("l"))
    best = best.select("axis", "value", F.transform("l", lambda s: F.struct(s["skill"].alias("skill"), (-s["m"]).alias("n"))).alias("top_skills"))
    return main.join(median, ["axis", "value"], "left").join(best, ["axis", "value"], "left")


#: More values of one kind than a posting's family, track, years or degree can have; of others only the first few are kept.
_VALUES = 100


def fingerprints(profiles: DataFrame, k_skills: int = 15, k_titles: int = 10, k_asks: int = 5) -> DataFrame:
    """Per company: jobs, asked (postings that ask for years), median_years, families, tracks (maps), skills, titles, degree_asks, ai_asks.

    One scan: a posting becomes one row for each thing it says (kind, value), counted per company before the first values of
    each kind are kept, so that no row grows with a company. The median is the upper one; of equal counts the value said first
    comes before the others when lists are cut, and in lists the lesser text does. Asks are array<struct<value, n>>.
    """
    said = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
    p = lambda name: F.col(f"profile.{name}")
    none = F.array().cast("array<struct<kind:string,value:string>>")
    degree = F.concat(p("degree.level"), F.lit(" ("), p("degree.status"), F.lit(")"))
    things = F.concat(
        F.array(said("family", p("family")), said("track", p("track")), said("title", F.col("title"))), F.when(p("years") > 0, F.array(said("years", p("years")))).otherwise(none),
        F.when(degree.isNotNull(), F.array(said("degree", degree))).otherwise(none), F.transform(p("skills"), lambda x: said("skill", x["name"])), F.transform(p("ai"), lambda x: said("ai", x["label"])),
    )
    rows = profiles.select("company", "_ord", F.explode(things).alias("t")).select("company", "_ord", "t.*")
    # every posting's title is one of its own
    counted = rows.groupBy("company", "kind", F.when(F.col("kind") == "title", F.col("_ord")).alias("_at"), "value").agg(F.count(F.lit(1)).alias("n"), F.min("_ord").alias("_first"))
    rank = F.row_number().over(Window.partitionBy("company", "kind").orderBy(F.desc("n"), "_first", "value"))
    kept = counted.withColumn("rank", rank).where(F.col("rank") <= max(_VALUES, k_skills, k_titles, k_asks))
    one = F.struct("rank", "value", "n")
    lists = kept.groupBy("company").agg(*(F.array_sort(F.collect_list(F.when(F.col("kind") == k, one))).alias(k) for k in ("family", "track", "title", "years", "degree", "skill", "ai")))
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    by_name = lambda c: F.map_from_entries(F.array_sort(F.transform(c, lambda x: F.struct(x["value"], x["n"]))))
    first = lambda c, k: F.transform(F.array_sort(F.transform(F.slice(c, 1, k), lambda x: F.struct((-x["n"]).alias("less"), x["value"].alias("value")))), lambda x: F.struct(x["value"].alias("value"), (-x["less"]).alias("n")))
    years = F.array_sort(F.transform("years", lambda x: F.struct(x["value"].cast("int").alias("y"), x["n"].alias("n"))))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("y"))
    upper = lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.when(a["y"].isNull() & (a["seen"] + x["n"] > F.floor(total(F.col("years")) / 2)), x["y"]).otherwise(a["y"]).alias("y"))
    return lists.select(
        "company", total(F.col("track")).alias("jobs"), total(F.col("years")).alias("asked"), F.aggregate(years, start, upper, lambda a: a["y"]).alias("median_years"), by_name(F.col("family")).alias("families"),
        by_name(F.col("track")).alias("tracks"), F.transform(first(F.col("skill"), k_skills), lambda x: x["value"]).alias("skills"), F.transform(F.slice("title", 1, k_titles), lambda x: x["value"]).alias("titles"),
        first(F.col("degree"), k_asks).alias("degree_asks"), first(F.col("ai"), k_asks).alias("ai_asks"),
    )


def coverage(researched: DataFrame, registry: DataFrame) -> DataFrame:
    """One row: total companies known anywhere, in the registry, active, and researched ones the registry lacks."""
    key = lambda c: F.lower(F.trim(c)).alias("k")
    a, b = researched.select(key("company")).distinct(), registry.select(key("company_name"), (F.lower(F.trim("active")) == "true").alias("on")).groupBy("k").agg(F.bool_or("on").alias("on"))
    both = a.withColumn("r", F.lit(True)).join(b.withColumn("c", F.lit(True)), "k", "full_outer")
    return both.agg(F.count(F.lit(1)).alias("total"), F.count_if("c").alias("registered"), F.count_if("on").alias("active"), F.count_if(F.col("r") & F.col("c").isNull()).alias("missing"))


class Counters:
    """Counts that an execution takes on its way: steps of a plan name them, and its first action fills them, without one of its own."""

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def on(self, df: DataFrame, **counts: Column) -> DataFrame:
        """df, which counts itself when it runs."""
        self._seen.append(Observation())
        return df.observe(self._seen[-1], *(c.alias(n) for n, c in counts.items()))

    def read(self) -> dict[str, int]:
        """All counts; waits for an action on what the steps lead to."""
        return {n: v for seen in self._seen for n, v in seen.get.items()}


def run_counters(classified: DataFrame) -> DataFrame:
    """path, decision, n of a run's classified postings."""
    return classified.groupBy("class.path", "class.decision").agg(F.count(F.lit(1)).alias("n"))

"""A structured role profile from title and description, by native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicons as L
from .text import insensitive, ladder, let, matches, may_occur, occurs, squeeze, text


def tagged(c: Column, rules, make, low: Column | None = None) -> Column:
    """array of make(rule) for the rules whose last entry, a pattern, occurs in c (`low`: c in lower case)."""
    return F.array_compact(F.array(*(F.when(occurs(c, r[-1], low), make(r)) for r in rules)))


def skills(c: Column, low: Column | None = None) -> Column:
    """array<struct<name, category>> in the order of the lists; one expression per category keeps generated code small."""
    named = lambda category: lambda r: F.struct(F.lit(r[0]).alias("name"), F.lit(category).alias("category"))
    return F.concat(*(tagged(c, rules, named(category), low) for category, rules in L.SKILLS.items()))


def cluster(name: Column, category: Column) -> Column:
    """The chart a skill belongs to; null for languages."""
    pairs = lambda d: F.create_map(*(F.lit(x) for p in d.items() for x in p))
    return F.coalesce(F.try_element_at(pairs(L.SKILL_CLUSTER), name), F.try_element_at(pairs(L.CATEGORY_CLUSTER), category))


def family(title: Column, description: Column) -> Column:
    return F.coalesce(ladder(title, L.FAMILIES, F.lit(None)), ladder(F.substring(description, 1, 400), L.FAMILIES, F.lit(None)), F.lit("Other"))


def track(title: Column) -> Column:
    return F.when(title.rlike(L.LEAD_TITLE), "Lead").otherwise("IC")


def years(c: Column) -> Column:
    """Years asked for, 1 to 15: the first number said near 'experience', else the first; the Hebrew word for two without any."""
    number = lambda m: F.regexp_extract(m["value"], r"^(\d{1,2})", 1).cast("int")

    def near(m: Column) -> Column:
        start = F.greatest(m["start"] - 60, F.lit(0))
        return F.substring(c, start + 1, m["end"] + 30 - start).rlike("(?i)experience|ניסיון")

    def chosen(found: Column) -> Column:
        first = lambda a: F.try_element_at(F.transform(a, number), F.lit(1))
        return F.coalesce(first(F.filter(found, near)), first(found), F.when(c.rlike("שנתיים"), F.lit(2)))

    return let(F.filter(matches(c, L.YEARS), lambda m: number(m).between(1, 15)), chosen)


def degree(c: Column) -> Column:
    """struct<level, status, fields>: the lowest level required, else the lowest named; null without any."""

    def asked(level: str, pattern: str) -> Column:
        at = F.regexp_instr(c, F.lit(insensitive(pattern)))
        clause = F.split(F.substring(c, at + F.length(F.regexp_extract(c, insensitive(pattern), 0)), F.lit(150)), r"[•\n]|(?<=[a-zא-ת])\.\s", 2)[0]
        for other, rule in L.DEGREE_LEVELS:
            if other != level:  # what follows another degree is about that one
                clause = F.split(clause, insensitive(rule), 2)[0]

        def judged(part: Column) -> Column:
            status = F.when(part.rlike(L.DEGREE_HEDGE), "preferred").otherwise("required")
            rank = F.when(part.rlike(L.DEGREE_HEDGE), 10).otherwise(0) + {"BSc": 0, "MSc": 1, "PhD": 2}[level]
            return F.struct(rank.alias("rank"), F.lit(level).alias("level"), status.alias("status"), F.slice(tagged(part, L.DEGREE_FIELDS, lambda r: F.lit(r[0])), 1, 3).alias("fields"))

        return F.when(at > 0, let(clause, judged))

    def primary(found: Column) -> Column:
        lent = F.try_element_at(F.filter(found, lambda x: F.size(x["fields"]) > 0), F.lit(1))["fields"]
        none = F.array().cast("array<string>")
        filled = lambda first: F.struct(first["level"].alias("level"), first["status"].alias("status"), F.when(F.size(first["fields"]) > 0, first["fields"]).otherwise(F.coalesce(lent, none)).alias("fields"))
        return F.when(F.size(found) > 0, let(F.array_min(found), filled))

    return let(F.array_compact(F.array(*(asked(*rule) for rule in L.DEGREE_LEVELS))), primary)


def ai_usage(c: Column, low: Column | None = None) -> Column:
    """array<struct<label, token>>: what a posting wants done with AI; mentions of its own AI product don't count. `low`: c in lower case."""

    def context(m: Column) -> Column:
        start = F.greatest(m["start"] - 70, F.lit(0))
        before = F.substring(c, start + 1, m["start"] - start)
        after = F.substring(c, m["start"] + 1, m["end"] + 70 - m["start"])
        return F.concat(F.substring_index(before, "•", -1), F.substring_index(after, "•", 1))

    named = lambda label, token: F.struct(F.lit(label).alias("label"), F.lit(token).alias("token"))

    def used(real: Column) -> Column:
        wanted = lambda pattern: F.exists(real, lambda w: w.rlike(insensitive(pattern)))
        found = F.array_compact(F.array(*(F.when(wanted(pattern), named(label, token)) for label, token, pattern in L.AI_USAGE)))
        return let(found, lambda f: F.when((F.size(real) > 0) & (F.size(f) == 0), F.array(named("AI (unspecified)", "ai-unspecified"))).otherwise(f))

    real = F.filter(F.transform(matches(c, L.AI_MENTION), context), lambda w: ~(w.rlike(L.AI_PRODUCT) & ~w.rlike(L.AI_TOOL_WORDS)))
    said = let(F.lower(c), lambda low: may_occur(low, L.AI_MENTION)) if low is None else may_occur(low, L.AI_MENTION)
    return F.when(said, let(real, used)).otherwise(F.array().cast("array<struct<label:string,token:string>>"))


def soft_skills(c: Column, low: Column | None = None) -> Column:
    """array<struct<label, token>> of the soft skills named; with `low`, c in lower case, c is of one line with single spaces."""
    made = lambda r: F.struct(F.lit(r[0]).alias("label"), F.lit(r[1]).alias("token"))
    found = lambda s, low: tagged(s, L.SOFT_SKILLS, made, low)
    return let(squeeze(c), lambda s: let(F.lower(s), lambda low: found(s, low))) if low is None else found(c, low)


def task_of(bullet: Column) -> Column:
    """struct<label, token> of the task group with most hits in a bullet, the earlier on ties; null without any."""

    def counted(b: Column, low: Column) -> Column:
        hits = lambda p: F.when(may_occur(low, p), F.regexp_count(b, F.lit(insensitive(p)))).otherwise(0)
        return F.array(*(F.struct(hits(p).alias("n"), F.lit(-i).alias("order"), F.lit(label).alias("label"), F.lit(token).alias("token")) for i, (label, token, p) in enumerate(L.TASK_GROUPS)))

    top = let(bullet, lambda b: let(F.lower(b), lambda low: F.array_max(counted(b, low))))
    return let(top, lambda t: F.when(t["n"] > 0, F.struct(t["label"].alias("label"), t["token"].alias("token"))))


def tasks(bullets: Column) -> Column:
    """Groups that win two bullets or a quarter of those won, by wins, ties to the group won first."""
    return let(F.array_compact(F.transform(bullets, task_of)), _emphasized)


def _emphasized(won: Column) -> Column:
    tally = F.transform(F.array_distinct(won), lambda g: F.struct((-F.size(F.filter(won, lambda x: x == g))).alias("n"), F.array_position(won, g).alias("first"), g.alias("group")))
    kept = F.filter(tally, lambda t: (t["n"] <= -2) | (-t["n"] >= 0.25 * F.size(won)))
    return F.transform(F.array_sort(kept), lambda t: t["group"])


def profile(title: Column, description: Column, both: Column, low: Column) -> Column:
    """struct<skills, family, track, years, degree, ai> of squeezed texts; `both`: the two joined by a space, `low`: in lower case."""
    return F.struct(skills(both, low).alias("skills"), family(title, description).alias("family"), track(title).alias("track"), years(both).alias("years"), degree(both).alias("degree"), ai_usage(both).alias("ai"))


def profiled(jobs: DataFrame, title: str = "title", description: str = "description") -> DataFrame:
    """jobs with their `profile`. A posting's texts often repeat over places and days: each distinct pair is profiled once."""
    key = F.md5(F.concat_ws(":", F.length(text(title)), text(title), text(description)).cast("binary"))
    keyed = jobs.withColumn("_texts", key)
    texts = keyed.groupBy("_texts").agg(F.first(text(title)).alias("t"), F.first(text(description)).alias("d")).select("_texts", squeeze("t").alias("t"), squeeze("d").alias("d"))
    whole = texts.withColumn("both", F.concat_ws(" ", "t", "d")).withColumn("low", F.lower("both"))
    found = whole.select("_texts", profile(*map(F.col, ("t", "d", "both", "low"))).alias("profile"))
    return keyed.join(found, "_texts").drop("_texts")


def once_per_text(rows: DataFrame, column: str, made: dict[str, Column]) -> DataFrame:
    """rows without the text column but with what is made of it (by name): each distinct text is read once, however often it repeats."""
    keyed = rows.withColumn("_text", F.md5(text(column).cast("binary")))
    texts = keyed.groupBy("_text").agg(F.first(text(column)).alias(column)).select("_text", *(c.alias(n) for n, c in made.items()))
    return keyed.drop(column).join(texts, "_text").drop("_text")

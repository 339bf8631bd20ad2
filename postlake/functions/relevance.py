"""Rules that accept or reject postings by title and description, with the path and reason of each decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as L
from .text import text


def relevance(title: Column | str) -> Column:
    t = F.lower(text(title))
    strong = t.rlike(L.TITLE_STRONG)
    return F.when(t.rlike(L.TITLE_EXCLUDED), F.when(strong, "signal").otherwise("excluded")).when(strong, "strong").when(t.rlike(L.TITLE_SIGNAL), "signal").otherwise("none")


def seniority(title: Column | str) -> Column:
    t = F.lower(text(title))
    return F.when(t.rlike(L.TITLE_SENIOR), "senior").when(t.rlike(L.TITLE_JUNIOR), "junior").otherwise("unknown")


def describes_modelling(description: Column | str) -> Column:
    """Whether the role's part of a description is about models rather than analysis."""
    d = text(description)
    start = F.regexp_instr(d, F.lit(L.ROLE_START))
    role = F.when(start > 0, F.substring(d, start, F.length(d))).otherwise(d)
    models, analysis = F.regexp_count(role, F.lit(L.TEXT_MODELLING)), F.regexp_count(role, F.lit(L.TEXT_ANALYTICS))
    return (models >= 2) & (models > analysis)


def accepts_signal(rel: Column, sen: Column, title: Column | str, description: Column | str) -> Column:
    t, d = F.lower(text(title)), text(description)
    evidence = d.rlike(L.TEXT_ANALYTICS)
    bare = t.rlike(L.BARE_SCIENTIST) & ~t.rlike(L.SCIENTIST_QUALIFIER)
    anchored = F.when(bare, evidence).otherwise(t.rlike(L.TITLE_ANCHOR) | evidence)
    return F.when((rel == "signal") & (sen == "senior"), F.when(describes_modelling(d), False).otherwise(anchored)).otherwise(False)


def classify(title: Column | str = "title", description: Column | str = "description", cached: Column | None = None, judged: Column | None = None) -> Column:
    """struct<decision, path, reason, relevance, seniority>.

    Rules come first. For what they leave open, `cached` and then `judged` verdicts (boolean columns, null where there
    is none) decide; without either column the rules alone do.
    """
    rel, sen = relevance(title), seniority(title)
    by_rules = F.when((rel == "strong") | accepts_signal(rel, sen, title, description), "accept").otherwise("reject")
    named = lambda path, reason, decision: F.struct(decision.alias("decision"), F.lit(path).alias("path"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"))
    sure = lambda decision, reason: named("keyword", reason, F.lit(decision))
    verdict = lambda c: F.when(c, "accept").otherwise("reject")
    out = (
        F.when(rel == "excluded", sure("reject", "engineering or other excluded title")).when(rel == "none", sure("reject", "no analytics signal in title"))
        .when(sen == "junior", sure("reject", "junior title")).when((rel == "strong") & (sen == "senior"), sure("accept", "senior analyst title"))
    )
    if cached is not None:
        out = out.when(cached.isNotNull(), named("llm_cache", "cached verdict", verdict(cached)))
    if judged is not None:
        out = out.when(judged.isNotNull(), named("llm", "verdict", verdict(judged)))
    last = "keyword_nollm" if cached is None and judged is None else "llm_failed_fallback"
    vetoed = F.when((rel == "signal") & (sen == "senior") & (by_rules == "reject"), "vetoed senior scientist title").otherwise("strong or anchored senior title accepted, others not")
    found = out.otherwise(named(last, vetoed, by_rules))
    return F.struct(found["decision"].alias("decision"), found["path"].alias("path"), found["reason"].alias("reason"), rel.alias("relevance"), sen.alias("seniority"))

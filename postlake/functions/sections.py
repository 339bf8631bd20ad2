"""The parts of a description: requirements with badges, duties, and what a company says of itself. Native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicons as L
from .profile import ai_usage, soft_skills, tasks
from .text import clean_description, computed, first_match, let, matches, occurs, shorten, squeeze, text

_PARTS = "array<struct<text:string,badge:string>>"


def _strip(c: Column, signs: str, left: bool = True, right: bool = True) -> Column:
    """Without the signs (as in a pattern's brackets) at the ends of a text of one line."""
    cut = F.btrim if left and right else F.ltrim if left else F.rtrim
    return cut(c, F.lit(signs.replace("\\t", "\t").replace("\\", "")))


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _count(c: Column, sign: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(sign), F.lit("")))


def _from(c: Column, start: Column) -> Column:
    return F.substring(c, start + 1, F.length(c))


def unlabelled(description: Column | str) -> Column:
    """The cleaned description without the labels some boards put before it."""
    return let(clean_description(description), lambda c: F.when(c.rlike(r"(?i)^(?:\s|experience level|description)"), F.regexp_replace(c, L.LABEL_PREFIX, "")).otherwise(c))


def badge(piece: Column) -> Column:
    """struct<text, badge>: a must or plus marker at either end of a piece becomes its badge."""
    made = lambda c, b: F.struct(c.alias("text"), F.lit(b).cast("string").alias("badge"))

    def read(p: Column) -> Column:
        peeled = lambda pattern: _strip(F.regexp_replace(p, pattern, ""), " \\-–—(:", left=False)
        return (
            F.when(~let(F.lower(p), lambda low: occurs(p, L.BADGE_WORDS, low)), made(p, None))
            .when(p.rlike(L.LEADING_PLUS), made(F.regexp_replace(p, L.LEADING_PLUS, ""), "plus")).when(p.rlike(L.LEADING_MUST), made(F.regexp_replace(p, L.LEADING_MUST, ""), "must"))
            .when(p.rlike(L.PLUS_AT_END), made(peeled(L.TRAILING_PLUS), "plus")).when(p.rlike(L.MUST_AT_END), made(peeled(L.TRAILING_MUST), "must")).otherwise(made(p, None))
        )

    return let(piece, read)


def clean_bullet(piece: Column, most: int = 210) -> Column:
    """One fragment without markers, leaked headers, stray spaces and dangling words; longer ones are cut at a word."""
    return _cleaned(squeeze(piece), most)


def _cleaned(piece: Column, most: int = 210) -> Column:
    """clean_bullet of a text of one line with single spaces, as all parts of a cleaned description are."""

    def capped(p: Column) -> Column:
        head = F.substring(p, 1, most)
        word = F.coalesce(F.nullif(F.regexp_extract(head, "^(.*) ", 1), F.lit("")), head)
        return F.when(F.length(p) > most, F.concat(_strip(word, " ,;:–—\\-", left=False), F.lit("…"))).otherwise(p)

    def closed(p: Column) -> Column:
        """An open bracket is closed, or goes if nothing stands in it."""
        inner = F.trim(F.substring_index(p, "(", -1))
        before = _strip(F.regexp_extract(p, r"^(.*)\([^(]*$", 1), " \\-–—,", left=False)
        return F.when(~p.contains("(") | (_count(p, "(") <= _count(p, ")")), p).when(F.length(inner) < 2, before).otherwise(F.concat(_strip(p, " \\-–—,", left=False), F.lit(")")))

    p = _strip(piece, " \\t•·–—\\-:;.")
    p = _strip(F.regexp_replace(p, L.LEADING_HEADER, ""), " :–—\\-")

    def joined(p: Column) -> Column:
        done = p
        for pattern, new in ((r"\s+([,.;:%)])", "$1"), (r"(\d)\s+\+", "$1+"), (r"\(\s+", "(")):
            done = F.regexp_replace(done, pattern, new)
        return F.when(p.rlike(r"\s[,.;:%)+]|\(\s"), done).otherwise(p)

    def ended(p: Column) -> Column:
        p = F.regexp_replace(p, r"(?i)[\s,]+(?:is an?|are|with|and|or|to|of|the|for|in|on|an?|is)$", "")
        return _strip(F.regexp_replace(p, r"(?i)^(?:is|are|has|have|will be)\s+", ""), " \\-–—,;:", left=False)

    return let(let(let(let(p, joined), capped), closed), ended)


def looks_like_header(c: Column) -> Column:
    """Two to five words, all but one at most with a capital, without digits and requirement words."""
    named = lambda words: (F.size(words).between(2, 5)) & (F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}"))) >= F.size(words) - 1)
    return let(F.split(c, " "), named) & ~c.rlike(r"\d") & ~c.rlike(L.REQUIREMENT_SIGNAL)


def _is_bullet(c: Column) -> Column:
    return F.length(c).between(8, 220) & ~c.rlike(L.HEADER_ONLY) & ~looks_like_header(c) & ~c.startswith("#") & ~let(F.lower(c), lambda low: occurs(c, L.BULLET_JUNK, low))


def _pieces(section: Column, run_on: str, longest: int, *more: str) -> Column:
    """A section's fragments: at its markers, else at sentences; long ones also where a list has lost its markers."""
    parts = F.when(section.contains("•"), F.split(section, "•")).otherwise(F.split(section, L.SENTENCES))
    cut = lambda pattern: lambda p: F.when(F.length(p) > longest, F.split(p, pattern)).otherwise(F.array(p))
    for pattern in (run_on, *more):  # a second argument of a transform's function would be the piece's place
        parts = F.flatten(F.transform(parts, cut(pattern)))
    return parts


def bullets(section: Column, default: str | None = None) -> Column:
    """array<struct<text, badge>> of a section; a bare sub-header of advantages makes plus the badge of what follows."""

    def cleaned(p: Column) -> Column:
        return let(badge(F.trim(p)), lambda b: F.struct(_cleaned(b["text"]).alias("text"), b["badge"].alias("badge")))

    def step(a: Column, x: Column) -> Column:
        kept = _is_bullet(x["text"]) & ((F.length(x["text"]) <= 120) | x["text"].rlike(L.REQUIREMENT_SIGNAL))
        one = F.struct(x["text"].alias("text"), F.coalesce(x["badge"], a["badge"]).alias("badge"))
        return F.when(x["text"].rlike(L.PLUS_ONLY), F.struct(F.lit("plus").alias("badge"), a["found"].alias("found"))).when(kept, F.struct(a["badge"].alias("badge"), F.array_append(a["found"], one).alias("found"))).otherwise(a)

    start = F.struct(F.lit(default).cast("string").alias("badge"), _none(_PARTS).alias("found"))
    return F.aggregate(F.transform(_pieces(section, L.RUN_ON, 80, L.DASHES), cleaned), start, step, lambda a: a["found"])


def _once(parts: Column, name=lambda x: x) -> Column:
    """The first of the parts that are equal but for case; each is put in lower case once, not for each pair."""
    first = lambda names: lambda _, i: F.array_position(names, F.get(names, i)) == i + 1
    return let(parts, lambda all_: let(F.transform(all_, lambda x: F.lower(name(x))), lambda names: F.filter(all_, first(names))))


def _opening(plain: Column, found: Column, soft: Column) -> Column:
    """Of the first five headers the first that no duty follows, else the first, else a softer one."""

    def opens(m: Column) -> Column:
        head = _cleaned(F.split(_strip(F.substring(plain, m["end"] + 1, F.lit(160)), " ?:\\-–—•"), "•")[0])
        return let(head, lambda h: (h != "") & ~h.rlike(L.DUTY_VERB))

    first = lambda all_: F.try_element_at(all_, F.lit(1))
    chosen = lambda five: F.when(F.size(five) < 2, first(five)).otherwise(F.coalesce(first(F.filter(five, opens)), first(five)))
    return F.coalesce(let(chosen(F.slice(found, 1, 5)), lambda m: F.when(m.isNotNull(), F.struct(m["start"].alias("start"), m["end"].alias("end")))), soft)


def requirements_header(plain: Column) -> Column:
    """struct<start, end> of the header that opens the requirements: of the first five the first that no duty follows, else the first, else a softer one."""
    return _opening(plain, matches(plain, L.REQUIREMENTS), first_match(plain, L.SOFT_REQUIREMENTS))


def _cuts(plain: Column, low: Column) -> dict[str, Column]:
    """The places of what cuts a description, each kind found in one run over the text."""
    kinds = {"asks": L.REQUIREMENTS, "ends": L.SECTION_END, "pluses": L.PLUS_SECTION}
    return {k: matches(plain, p, low) for k, p in kinds.items()} | {"duties": first_match(plain, L.DUTIES, low)}


def _bounds(plain: Column, low: Column, asks: Column, ends: Column, pluses: Column, duties: Column) -> Column:
    soft = F.when(F.size(asks) == 0, first_match(plain, L.SOFT_REQUIREMENTS, low))
    return F.struct(plain.alias("plain"), asks.alias("asks"), ends.alias("ends"), pluses.alias("pluses"), duties.alias("duties"), _opening(plain, asks, soft).alias("header"))


def boundaries(plain: Column) -> Column:
    """What cuts a description: struct of the places of requirement headers, section ends and headers of advantages, and of the one
    header each that opens the requirements and the duties."""
    named = lambda t: F.struct(t["plain"].alias("plain"), t["low"].alias("low"), *(c.alias(k) for k, c in _cuts(t["plain"], t["low"]).items()))
    found = let(let(plain, lambda p: F.struct(p.alias("plain"), F.lower(p).alias("low"))), named)
    return let(found, lambda f: _bounds(*(f[k] for k in ("plain", "low", "asks", "ends", "pluses", "duties"))))


def _section(b: Column, header: Column, most: int, *ends: str) -> Column:
    """struct<start, end> of what follows a header: `most` characters at most, to the first of each kind of end unless that begins within the first 20."""
    edge = " ?:\\-–—•"
    body = let(_from(b["plain"], header["end"]), lambda t: F.struct(F.length(t).alias("n"), F.length(_strip(t, edge, right=False)).alias("left"), F.length(_strip(t, edge)).alias("kept")))
    start, least = lambda t: header["end"] + t["n"] - t["left"], lambda t: F.least(t["kept"], F.lit(most))

    def cut(t: Column) -> Column:
        place = lambda kind: let(F.get(F.filter(b[kind], lambda m: m["end"] > start(t)), F.lit(0))["start"] - start(t), lambda at: F.when(at > 20, at))
        return F.struct(start(t).alias("start"), (start(t) + F.least(least(t), *(F.coalesce(place(k), F.lit(most)) for k in ends))).alias("end"))

    return F.when(header.isNotNull(), let(body, cut))


def _slice(plain: Column, start: Column, end: Column) -> Column:
    return F.substring(plain, start + 1, F.greatest(end - start, F.lit(0)))


def _requirements(b: Column) -> Column:
    def split(s: Column) -> Column:
        text_ = lambda start, end: _slice(b["plain"], start, end)
        first = F.get(F.filter(b["pluses"], lambda m: (m["end"] > s["start"]) & (m["end"] <= s["end"])), F.lit(0))
        return let(first, lambda m: F.when(m["start"] - s["start"] > 20, F.concat(bullets(text_(s["start"], m["start"])), bullets(text_(m["end"], s["end"]), "plus"))).otherwise(bullets(text_(s["start"], s["end"]))))

    found = let(_section(b, b["header"], 2600, "ends"), lambda s: F.when(s.isNotNull(), split(s)))
    return F.coalesce(F.slice(_once(found, lambda x: x["text"]), 1, 12), _none(_PARTS))


def _duties(b: Column) -> Column:
    cut = let(_section(b, b["duties"], 2200, "asks", "ends"), lambda s: F.when(s.isNotNull(), _slice(b["plain"], s["start"], s["end"])))
    found = F.filter(F.transform(let(cut, lambda s: _pieces(s, L.RUN_ON_DUTIES, 90)), lambda p: _cleaned(p)), _is_bullet)
    return F.coalesce(F.slice(_once(found), 1, 8), _none("array<string>"))


def _prose(b: Column) -> Column:
    """Sentences before the requirements, for descriptions that list no duties."""
    intro = F.substring(b["plain"], F.lit(1), F.least(F.coalesce(b["header"]["start"], F.length(b["plain"])), F.lit(2200)))
    return let(intro, lambda i: let(F.filter(F.split(i, L.SENTENCES), lambda s: F.length(s) > 15), lambda s: F.when(F.size(s) > 0, s).when(i != "", F.array(i)).otherwise(_none("array<string>"))))


def requirements(description: Column | str) -> Column:
    """array<struct<text, badge>>: up to 12 things asked for, badge must, plus or null."""
    return let(let(unlabelled(description), boundaries), _requirements)


def duties(description: Column | str) -> Column:
    """array<string>: up to 8 things the role does."""
    return let(let(unlabelled(description), boundaries), _duties)


def _asked(requirements: Column) -> Column:
    return F.array_join(requirements["text"], " • ")


def _mentioned(ai_asked: Column, ai_daily: Column, plain: Column, low: Column | None = None) -> Column:
    """AI on the job: a mention outside both parts counts as done."""
    return F.when((F.size(ai_asked) == 0) & (F.size(ai_daily) == 0), ai_usage(plain, low)).otherwise(ai_daily)


def _duty_tasks(duties: Column, b: Column) -> Column:
    return tasks(F.when(F.size(duties) > 0, duties).otherwise(_prose(b)))


def sections(description: Column | str) -> Column:
    """struct<requirements, duties, tasks, soft, ai_asked, ai_daily> of a description.

    Where AI is mentioned tells whether it is asked for or done on the job; a mention outside both counts as done.
    """

    def made(x: Column) -> Column:
        asked = _asked(x["requirements"])
        ai_asked, ai_daily = ai_usage(asked), ai_usage(F.array_join(x["duties"], " • "))
        done = _mentioned(ai_asked, ai_daily, x["b"]["plain"])
        return F.struct(x["requirements"].alias("requirements"), x["duties"].alias("duties"), _duty_tasks(x["duties"], x["b"]).alias("tasks"), soft_skills(asked).alias("soft"), ai_asked.alias("ai_asked"), done.alias("ai_daily"))

    parts = let(let(unlabelled(description), boundaries), lambda b: F.struct(b.alias("b"), _requirements(b).alias("requirements"), _duties(b).alias("duties")))
    return let(parts, made)


def sectioned(rows: DataFrame, description: str = "description") -> DataFrame:
    """rows with the parts that `sections` gives, in place of the description.

    Each step is a column of its own: names within one expression are values of lambdas, which Spark interprets and copies at each
    level, while a column is computed by generated code.
    """
    c = F.col
    kept = [n for n in rows.columns if n != description]
    at = computed(rows, _text=text(description)).select(*kept, unlabelled("_text").alias("_plain"))
    at = computed(at, _plain=c("_plain"), _low=F.lower("_plain"))
    at = computed(at, **{f"_{k}": found for k, found in _cuts(c("_plain"), c("_low")).items()})
    at = computed(at, _b=_bounds(*(c(f"_{k}") for k in ("plain", "low", "asks", "ends", "pluses", "duties"))))
    at = computed(at.select(*kept, "_low", "_b"), requirements=_requirements(c("_b")), duties=_duties(c("_b")))
    at = computed(at, _asked=_asked(c("requirements")), _done=F.array_join("duties", " • "))
    at = computed(at, _asked_low=F.lower("_asked"), _done_low=F.lower("_done"))
    at = computed(at, ai_asked=ai_usage(c("_asked"), c("_asked_low")), _ai=ai_usage(c("_done"), c("_done_low")), soft=soft_skills(c("_asked"), c("_asked_low")), tasks=_duty_tasks(c("duties"), c("_b")))
    return at.select(*kept, "requirements", "duties", "tasks", "soft", "ai_asked", _mentioned(c("ai_asked"), c("_ai"), c("_b.plain"), c("_low")).alias("ai_daily"))


def role_summary(description: Column | str, most: int = 230) -> Column:
    """The text from where the role begins, or after a first sentence about the company, cut at a word."""

    def begun(d: Column) -> Column:
        marker, said = first_match(d, L.ROLE_MARKER), first_match(F.substring(d, 1, 220), L.COMPANY_IS)
        return F.when(marker["start"] < 700, _from(d, marker["start"])).when(said["end"] < 220, _strip(_from(d, said["end"]), " .,\\-")).otherwise(d)

    return shorten(let(unlabelled(description), begun), most)


def company_blurb(description: Column | str, company: Column | str = "") -> Column:
    """What a description says its company is or does: the phrase after the company's name, else after `is a`; empty without one."""
    name = F.replace(F.lit("") if isinstance(company, str) and not company else text(company), F.lit("\\E"), F.lit(""))
    words = lambda c: F.filter(F.split(F.regexp_replace(F.trim(c), r"\.+$", ""), " "), lambda w: w != "")

    def found(d: Column) -> Column:
        named = words(F.call_function("regexp_extract", F.substring(d, 1, 400), F.concat(F.lit("(?i)\\Q"), name, F.lit("\\E" + L.COMPANY_DOES)), F.lit(1)))
        plain = words(F.regexp_extract(F.substring(d, 1, 220), L.COMPANY_IS, 1))
        fits = lambda w: (name != "") & (F.size(w) >= 3) & ~F.lower(F.get(w, F.lit(0))).isin(*L.BLURB_STRAYS)
        return let(named, lambda w: F.when(fits(w), F.array_join(F.slice(w, 1, 16), " ")).otherwise(F.array_join(F.slice(plain, 1, 12), " ")))

    return let(_strip(unlabelled(description), " •", right=False), found)


def about(static: Column, cached: Column, description: Column | str, company: Column | str) -> Column:
    """A company's text: the curated one, else the cached, else what the description says; error messages never show."""
    given = F.coalesce(F.nullif(static, F.lit("")), F.nullif(cached, F.lit("")), F.lit(""))
    return F.when((given != "") & ~given.rlike(L.BLURB_JUNK), given).otherwise(company_blurb(description, company))


def is_mangled(title: Column | str) -> Column:
    """Whether a title is a scraped card run together, or too long for a title."""
    return text(title).rlike(L.MANGLED_TITLE) | (F.length(text(title)) > 100)


def employment(title: Column | str) -> Column:
    return F.coalesce(*(F.when(F.lower(text(title)).contains(word), F.lit(label)) for word, label in L.EMPLOYMENT), F.lit(""))


def experience_chip(description: Column | str) -> Column:
    """The level a board states, else the years first asked for; empty without either."""
    stated = F.trim(F.regexp_extract(text(description), L.EXPERIENCE_LEVEL, 1))
    years = F.regexp_extract(text(description), r"(?i)(\d+)\s*\+?\s*(?:-\s*\d+\s*)?years?\b", 1)
    return F.when(stated != "", _strip(stated, ".", left=False)).when(years != "", F.concat(years, F.lit("+ yrs"))).otherwise("")


def level(chip: Column, title: Column | str) -> Column:
    """Junior, Mid, Senior, Lead+ or —."""

    def named(c: Column, t: Column, n: Column) -> Column:
        return (
            F.when(c.rlike("junior|entry|intern"), "Junior").when(c.rlike(L.LEAD_WORDS) | t.rlike(L.LEAD_WORDS), "Lead+").when(c.rlike("senior|advanced|expert") | t.rlike(L.SENIOR_WORDS), "Senior")
            .when(n >= 8, "Lead+").when(n >= 5, "Senior").when(n.isNotNull() | c.contains("mid"), "Mid").otherwise("—")
        )

    return let(_number(chip), lambda x: let(F.lower(text(title)), lambda t: named(x["c"], t, x["n"])))


def _number(chip: Column) -> Column:
    """struct<c, n>: a level in lower case, and the first number in it."""
    return let(F.lower(text(chip)), lambda c: F.struct(c.alias("c"), F.regexp_extract(c, r"(\d+)", 1).try_cast("int").alias("n")))


def level_rank(chip: Column) -> Column:
    """A number to sort levels by; unknown ones last."""

    def ranked(c: Column, n: Column) -> Column:
        return (
            F.when(c.isin("", "—"), 99).when(c.rlike("junior|entry"), 1).when(c.rlike("lead|manager|head|principal|staff|director|vp|chief"), 6).when(c.contains("mid-senior"), 4).when(c.contains("senior"), 5)
            .when(c.contains("mid"), 3).when(n >= 5, 6).when(n >= 3, 5).when(n.isNotNull(), 3).when(c.rlike("advanced|expert"), 6).otherwise(4)
        )

    return let(_number(chip), lambda x: ranked(x["c"], x["n"]))


def age_note(posted: Column | str, run_date: str) -> Column:
    """A warning for old postings: months from 60 days on, days from 45 on, else empty."""
    days = F.datediff(F.to_date(F.lit(run_date)), F.substring(text(posted), 1, 10).try_cast("date"))
    return F.when(days >= 60, F.concat(F.lit("posted ~"), F.floor(days / 30).cast("string"), F.lit("mo ago"))).when(days >= 45, F.concat(F.lit("posted "), days.cast("string"), F.lit("d ago"))).otherwise("")

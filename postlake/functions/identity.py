"""Keys and names of companies and postings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as L
from .text import any_of, squeeze, text

_OTHER = r"[^0-9a-z֐-׿]+"
_SECOND_LEVEL = ("co", "com", "org", "net", "ac", "gov", "edu")


def literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in d.items() for x in pair))


def norm(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(text(c)), _OTHER, " "))


def norm_company(c: Column | str) -> Column:
    """As norm, without one trailing corporate suffix."""
    return norm(F.regexp_replace(F.trim(text(c)), L.MERGE_SUFFIX, ""))


def merge_key(company: Column | str = "company", title: Column | str = "title") -> Column:
    """The same opening wherever it is posted: company and title, without the place."""
    return F.concat_ws("|", norm_company(company), norm(title))


def seen_id(platform: Column | str = "ats_platform", job_id: Column | str = "job_id", url: Column | str = "url") -> Column:
    """One posting across days: platform with its id, or with its url where the id is blank."""
    own = F.trim(text(job_id))
    return F.concat(text(platform), F.lit(":"), F.when(own != "", own).otherwise(text(url)))


def identity_key(c: Column | str) -> Column:
    """One company across spellings: all trailing suffixes go, annotations in brackets too, known aliases fold."""
    # a bracket that opens with an annotation goes whole, any other loses only its brackets, as do all signs
    plain = F.regexp_replace(text(c), r"(?i)\(\s*(?:formerly|now|part of|acquired|previously|by |a |an )[^)]*\)", " ")
    bare = F.regexp_replace(norm(plain), rf"(?:\s+(?:{'|'.join(L.IDENTITY_SUFFIXES)}))+$", "")
    return F.coalesce(F.try_element_at(literal_map(L.IDENTITY_ALIASES), bare), bare)


def is_division(c: Column | str) -> Column:
    """Whether a bracket in the name tells apart, as opposed to one that annotates."""
    inner = F.regexp_extract_all(text(c), F.lit(r"\(([^)]*)\)"), F.lit(1))
    return F.exists(inner, lambda x: ~x.rlike(L.ANNOTATION))


def looks_like_junk(c: Column | str) -> Column:
    return F.lower(squeeze(c)).isin(*L.CATEGORY_NAMES) | text(c).rlike(L.JUNK_NAME)


def host(url: Column | str) -> Column:
    whole = F.when(text(url).rlike("(?i)^[a-z][a-z0-9+.-]*://"), text(url)).otherwise(F.concat(F.lit("http://"), text(url)))
    return F.coalesce(F.lower(F.try_parse_url(whole, F.lit("HOST"))), F.lit(""))


def registrable(h: Column) -> Column:
    """The label a company registered: the last but one, or the one before a second-level domain."""
    parts = F.split(F.regexp_replace(F.regexp_replace(F.lower(h), r":\d+$", ""), r"^www\.", ""), r"\.")
    second = F.try_element_at(parts, F.lit(-2))
    third = F.try_element_at(parts, F.lit(-3))
    return F.coalesce(F.when(second.isin(*_SECOND_LEVEL) & third.isNotNull(), third).otherwise(second), parts[0], F.lit(""))


def _words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(text(c)), F.lit("[a-z0-9]+"), F.lit(0))


def acronym(c: Column | str) -> Column:
    """Initials of the telling words, or of all where fewer than two tell."""
    words = _words(c)
    telling = F.filter(words, lambda w: ~w.isin(*L.COMMON_NAME_WORDS))
    used = F.when((F.size(telling) < 2) & (F.size(words) >= 2), words).otherwise(telling)
    return F.array_join(F.transform(used, lambda w: F.substring(w, 1, 1)), "")


def site_verdict(company: Column | str, url: Column | str) -> Column:
    """Whether a site is the company's: ats, match, weak, mismatch or unknown; the first rule that applies decides."""
    h = host(url)
    name, label = F.array_join(_words(company), ""), F.regexp_replace(registrable(h), "[^a-z0-9]", "")
    parents = F.create_map(*(x for k, v in L.PARENT_HOSTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    parent = F.exists(F.coalesce(F.try_element_at(parents, F.lower(squeeze(company))), F.array().cast("array<string>")), lambda p: h.endswith(p))
    telling = F.filter(_words(company), lambda w: (F.length(w) >= 4) & ~w.isin(*L.COMMON_NAME_WORDS))
    near = F.exists(telling, lambda w: label.contains(w) & (F.length(label) - F.length(w) <= 2))
    held = F.exists(telling, lambda w: label.contains(w))
    close = (label.contains(name) | name.contains(label)) & (F.abs(F.length(label) - F.length(name)) <= 1)
    initials = acronym(company)
    return (
        F.when(h == "", "unknown").when(h.rlike(L.BOARD_HOSTS), "ats").when((name == "") | (label == ""), "unknown").when(parent, "match")
        .when(label == name, "match").when(close, "match").when(near, "match").when(held, "weak")
        .when((F.length(initials) >= 2) & label.startswith(initials) & (F.length(label) <= F.length(initials) + 4), "match").otherwise("mismatch")
    )


def is_foreign(company: Column | str, url: Column | str) -> Column:
    """Whether a site provably is another company's; a weak verdict proves nothing."""
    return site_verdict(company, url) == "mismatch"


def page_mentions(company: Column | str, page: Column | str) -> Column:
    """Whether a page names the company, in one piece or by all its telling words."""
    flat = F.regexp_replace(F.lower(F.regexp_replace(text(page), "<[^>]+>", " ")), "[^a-z0-9]", "")
    telling = F.filter(_words(company), lambda w: (F.length(w) >= 3) & ~w.isin(*L.COMMON_NAME_WORDS))
    name = F.array_join(_words(company), "")
    return (name != "") & (flat.contains(name) | ((F.size(telling) > 0) & F.forall(telling, lambda w: flat.contains(w))))


def slug_matches(company: Column | str, slug: Column | str) -> Column:
    """Whether a board's token belongs to the company's name; opaque ids are let pass."""
    s, name = F.regexp_replace(F.lower(text(slug)), "[^a-z0-9]", ""), F.array_join(_words(company), "")
    opaque = text(slug).rlike(r"^(?:[0-9A-F]{2}\.[0-9A-F]{3}|[0-9a-f-]{16,}|\d+)$")
    return opaque | F.exists(_words(company), lambda w: (F.length(w) >= 3) & s.contains(w)) | ((F.length(s) >= 4) & name.contains(s)) | ((F.length(s) >= 5) & name.startswith(F.substring(s, 1, 5)))


def display_company(c: Column | str) -> Column:
    head = F.trim(F.split(squeeze(c), r"\s[-–—|]\s")[0])
    legal = F.regexp_replace(head, r"(?i)[,\s]+(?:ltd|inc|llc|corp|gmbh|co)\.?$", "")
    return F.trim(F.regexp_replace(legal, r"(?i)\s+(?:technologies|media group|group)$", ""))


def primary_sector(c: Column | str) -> Column:
    low = F.lower(text(c))
    head = F.trim(F.split(F.when(text(c) == "", "(unknown)").otherwise(text(c)), "/")[0])
    return F.coalesce(*(F.when(low.rlike(any_of(keys)), F.lit(name)) for name, keys in L.SECTORS), F.nullif(head, F.lit("")), F.lit("(unknown)"))


def size_band(n: Column) -> Column:
    return F.when(n < 200, "S").when(n < 1000, "M").when(n < 5000, "L").when(n.isNotNull(), "XL")


def bucket_bounds(c: Column | str) -> Column:
    """struct<lo, hi> of '11-50' or '10,001+'; an open end is 1e9."""
    s = F.regexp_replace(text(c), r"[,\s]", "")
    low = F.regexp_extract(s, r"^(\d+)", 1).try_cast("bigint")
    high = F.when(s.rlike(r"^\d+\+"), F.lit(1_000_000_000).cast("bigint")).otherwise(F.regexp_extract(s, r"^\d+[-–](\d+)", 1).try_cast("bigint"))
    return F.when(low.isNotNull() & high.isNotNull(), F.struct(low.alias("lo"), high.alias("hi")))


def slug_candidates(c: Column | str) -> Column:
    """Board tokens a company may have, likeliest first."""
    words = _words(c)
    telling = F.filter(words, lambda w: ~w.isin("ltd", "inc", "llc", "corp", "co", "gmbh"))
    options = F.array(F.array_join(telling, ""), F.array_join(telling, "-"), F.array_join(words, ""), F.array_join(words, "-"), F.coalesce(telling[0], F.lit("")))
    return F.filter(F.array_distinct(options), lambda x: F.length(x) >= 2)


def is_agency(c: Column | str) -> Column:
    name = F.lower(squeeze(c))
    return name.isin(*L.AGENCIES) | name.rlike(L.AGENCY_WORDS)


def is_listing_site(url: Column | str) -> Column:
    """Whether the host is a job listing site rather than a company's own board."""
    hosts = "|".join(h.rstrip("/").replace(".", r"\.") for h in L.LISTING_HOSTS)
    return text(url).rlike(rf"(?i)(?://|^)([^/]*\.)?({hosts})")

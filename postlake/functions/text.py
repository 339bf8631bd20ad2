"""Column expressions over free text. Every function takes and returns Columns; null counts as the empty string."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lexicons import JUNK_MARKUP

_SPACE = r"(?U)\s+"
_UNSEEN = "[\uFEFF\u200B\u200E\u200F\u00AD]"
#: What a text of one line with single spaces doesn't hold.
_LOOSE = rf"\s\s|[\t-\r\x1C-\x1F\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]|{_UNSEEN}"
_FURNITURE = "(?is)" + "|".join(f"<{t}[^>]*>.*?</{t}>" for t in ("script", "style", "nav", "header", "footer", "svg", "noscript"))
#: The entities that occur in postings; the ampersand comes last, so that each pass undoes one level.
ENTITIES = (("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&ndash;", "–"), ("&mdash;", "—"), ("&rsquo;", "’"), ("&lsquo;", "‘"), ("&rdquo;", "”"), ("&ldquo;", "“"), ("&bull;", "•"), ("&hellip;", "…"), ("&amp;", "&"))


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def squeeze(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(text(c), _SPACE, " "))


def unescape(c: Column | str) -> Column:
    return reduce(lambda s, e: F.replace(s, F.lit(e[0]), F.lit(e[1])), ENTITIES, text(c))


def strip_html(c: Column | str) -> Column:
    """Plain text of (doubly escaped) HTML; list items and block ends leave a bullet."""
    steps = (
        (r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " "), (r"(?is)<li[^>]*>", " • "), (r"(?is)<br\s*/?>|</(p|div|h[1-6]|tr|ul|ol)\s*>", " • "),
        (r"<[^>]+>", " "), (" ", " "), (r"(?U)\s*•(?:\s*•)+\s*", " • "),
    )
    return squeeze(reduce(lambda s, p: F.regexp_replace(s, *p), steps, unescape(unescape(c))))


def snippet(c: Column | str, most: int = 6000) -> Column:
    """Plain text, cut to `most` characters; empty where application markup was pasted in."""
    plain = strip_html(c)
    return F.when(plain.rlike(JUNK_MARKUP), "").otherwise(F.substring(plain, 1, most))


def html_lines(c: Column | str) -> Column:
    """Text of a page with block ends as new lines and without page furniture."""
    bare = F.regexp_replace(text(c), _FURNITURE, " ")
    lines = F.regexp_replace(F.regexp_replace(bare, r"(?is)<br\s*/?>|</(p|div|li|h[1-6]|tr|ul|ol|section)\s*>", "\n"), r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(unescape(lines), r"[ \t ]+", " "), r"\s*\n\s*", "\n"))


def clean_description(c: Column | str) -> Column:
    """One line without invisible signs and without what expands a folded text."""
    shown = lambda d: F.when(d.contains("Show "), F.regexp_replace(d, r"\s*\bShow (?:more|less)\b", "")).otherwise(d)
    one_line = lambda d: F.when(d.rlike(_LOOSE), squeeze(F.regexp_replace(d, _UNSEEN, ""))).otherwise(F.trim(d))
    return let(let(text(c), one_line), shown)


def shorten(c: Column | str, n: int) -> Column:
    """At most n characters, cut at a word with an ellipsis."""
    plain = squeeze(c)
    head = F.substring(plain, 1, n)
    return F.when(F.length(plain) <= n, plain).otherwise(F.concat(F.coalesce(F.nullif(F.regexp_extract(head, r"^(.*) ", 1), F.lit("")), head), F.lit("…")))


def safe_url(c: Column | str) -> Column:
    return F.when(text(c).rlike(r"(?i)^https?://"), text(c)).otherwise("")


def markdown_escape(c: Column | str) -> Column:
    return F.regexp_replace(text(c), r"([`*_{}\[\]()#+\-!@~|>])", r"\\$1")


def html_escape(c: Column | str) -> Column:
    return reduce(lambda s, e: F.replace(s, F.lit(e[0]), F.lit(e[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")), text(c))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty, else the empty string."""
    return F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in columns), F.lit(""))


def join_filled(separator: str, *columns: Column) -> Column:
    return F.array_join(F.filter(F.array(*(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), lambda x: x != ""), separator)


def insensitive(pattern: str) -> str:
    return pattern if pattern.startswith("(?i)") else f"(?i){pattern}"


def _branches(pattern: str) -> list[tuple[str, list[str]]]:
    """The alternatives of a pattern, each with what its groups hold that must match; the groups themselves are left out as NUL."""
    out, text_, groups, at = [], "", [], 0
    while at <= len(pattern):
        if at == len(pattern) or pattern[at] == "|":
            out.append((text_, groups))
            text_, groups, at = "", [], at + 1
            continue
        found = re.match(r"\\.|\[(?:[^\]\\]|\\.)*\]", pattern[at:], re.S)
        if found or pattern[at] != "(":
            text_, at = text_ + (found[0] if found else pattern[at]), at + (len(found[0]) if found else 1)
            continue
        end, depth = at, 0
        while True:
            step = re.match(r"\\.|\[(?:[^\]\\]|\\.)*\]|.", pattern[end:], re.S)[0]
            depth, end = depth + (step == "(") - (step == ")"), end + len(step)
            if not depth:
                break
        inner, tail = pattern[at + 1 : end - 1], re.match(r"[?*+]|\{[^}]*\}", pattern[end:])
        if (not inner.startswith("?") or inner.startswith("?:")) and (not tail or tail[0] == "+"):
            groups.append(inner.removeprefix("?:"))
        text_, at = text_ + "\0", end + (len(tail[0]) if tail else 0)
    return out


def hints(pattern: str) -> tuple[str, ...]:
    """Lower-case texts of which any match of the pattern holds one, or none where an alternative has no plain stretch of two characters."""
    found: list[str] = []
    for branch, groups in _branches(pattern.removeprefix("(?i)")):
        plain = re.sub(r"\[[^\]]*\](?:[?*+]|\{[^}]*\})?|\\.(?:[?*+]|\{[^}]*\})?|.(?:[?*]|\{[^}]*\})|[.^$+]", "\0", branch)
        longest = max(plain.split("\0"), key=len).lower()
        more = (longest,) if len(longest) > 1 else next((h for h in map(hints, groups) if h), ())
        if not more:
            return ()
        found += more
    return tuple(dict.fromkeys(found))


def may_occur(low: Column, pattern: str) -> Column:
    """Whether plain searches in a lower-case text leave room for a match of the pattern."""
    return reduce(Column.__or__, (low.contains(h) for h in hints(pattern)), F.lit(not hints(pattern)))


def occurs(c: Column, pattern: str, low: Column | None = None) -> Column:
    """Whether the pattern occurs, ignoring case. `low`, the lower-case text, lets plain searches spare most of the work."""
    found = c.rlike(insensitive(pattern))
    return may_occur(low, pattern) & found if low is not None and hints(pattern) else found


def any_of(words: tuple[str, ...]) -> str:
    """Alternation of literal words."""
    return "|".join(re.escape(w) for w in words)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used: expressions have no other local names."""
    return F.transform(F.array(value), use)[0]


def computed(rows: DataFrame, **made: Column) -> DataFrame:
    """rows with columns that are computed once a row, whatever uses them: filters are pushed below projections by copying their
    expressions, but not below a generator."""
    return rows.select("*", F.explode(F.array(F.struct(*(c.alias(n) for n, c in made.items())))).alias("_made")).select(*(n for n in rows.columns if n not in made), "_made.*")


#: Stands for a match's ends while a text is cut; a private character, which a space replaces where a text has it.
_MARK = "\uE000"


def matches(c: Column, pattern: str, low: Column | None = None) -> Column:
    """array<struct<start, end, value>> of the matches, offsets from 0, end exclusive; the pattern runs over the text once at most.

    `low`, the lower-case text, lets plain searches spare texts without a match.
    """
    empty = F.expr("array()").cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), empty.alias("found"))

    def step(seen: Column, part: Column) -> Column:
        end = seen["at"] + F.length(part)
        one = F.struct(seen["at"].alias("start"), end.alias("end"), part.alias("value"))
        return F.struct(end.alias("at"), (~seen["hit"]).alias("hit"), F.when(seen["hit"], F.array_append(seen["found"], one)).otherwise(seen["found"]).alias("found"))

    located = lambda parts: F.when(F.size(parts) > 1, F.aggregate(parts, start, step, lambda s: s["found"])).otherwise(empty)
    found = let(F.split(F.regexp_replace(F.replace(c, F.lit(_MARK), F.lit(" ")), pattern, f"{_MARK}$0{_MARK}"), _MARK, -1), located)
    return found if low is None else F.when(may_occur(low, pattern), found).otherwise(empty)


def first_match(c: Column, pattern: str, low: Column | None = None) -> Column:
    """struct<start, end> of the first match, offsets from 0 in characters, end exclusive; null without one."""
    return let(F.get(matches(c, pattern, low), F.lit(0)), lambda m: F.when(m.isNotNull(), F.struct(m["start"].alias("start"), m["end"].alias("end"))))


def ladder(c: Column, rules, otherwise: Column) -> Column:
    """The value of the first rule (value, pattern) whose pattern occurs, ignoring case."""
    return F.coalesce(*(F.when(occurs(c, p), F.lit(v)) for v, p in rules), otherwise)

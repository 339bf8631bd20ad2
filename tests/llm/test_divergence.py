import re
from collections import Counter, defaultdict

import pytest

from postlake.llm import divergence


def plain(rows, least, top=50):
    """The contract, one step after the other, over (text, lang, source)."""
    docs = [((t or "").translate({i: i + 32 for i in range(65, 91)}), g or "", s or "") for t, g, s in rows]
    words = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t), g, s) for t, g, s in docs]
    out = set()
    for lang in {g for _, g, _ in words}:
        df = Counter(w for ws, g, _ in words if g == lang for w in set(ws))
        kept = sorted(w for w, n in df.items() if n >= least)
        by, whole = {s: Counter() for _, g, s in words if g == lang}, Counter()
        for ws, g, s in words:
            if g == lang:
                by[s].update(w for w in ws if w in set(kept))
                whole.update(w for w in ws if w in set(kept))
        share = lambda c, w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept))
        found = defaultdict(list)
        for s, c in by.items():
            for o, d in by.items():
                if o != s:
                    found[s, "pair"].append((sum(abs(share(c, w) - share(d, w)) for w in kept), o))
            found[s, "term"] = [(share(c, w) - share(whole, w), w) for w in kept if c[w] and share(c, w) > share(whole, w)]
        for (s, part), items in found.items():
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, part, w, v, i) for i, (v, w) in enumerate(ranked if part == "pair" else ranked[:top], 1)}
    return out


def frame(spark, rows, parts=3):
    """Documents whose other columns bear the names of inner ones."""
    rows = [(i, *r, 1, "k", 2.0, None) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n int, term string, total double, shard int").repartition(parts)


def found(df):
    return {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()}


ODD = [
    ("Überall the THE the-cat É", "en", "a"), ("the cat\x00sat 9cat 日本", "en", "b"), (None, "en", "c"), ("", "en", None), ("the é É dog", "en", None),
    ("the cat", None, "a"), ("THE dog", None, "b"), ("mot " * 9, "fr", "only"), ("dog dog", "en", "a"), ("dog dog", "en", "a"), ("nothing kept here", "de", "a"), (None, "de", "b"),
    ("cat " * 50_000 + "dog", "en", "b"),
]


@pytest.mark.parametrize("least, top", [(1, 50), (2, 50), (2, 1), (100, 50)])
def test_odd_rows(spark, least, top):
    """Nulls, one source, repeated rows, ties, a very long text, languages that keep no term; many small shards."""
    got = divergence.source_divergence(frame(spark, ODD), least=least, top=top, shard_rows=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert found(got) == plain(ODD, least, top)


def test_hot_source_over_many_partitions(spark):
    rows = [(" ".join(f"w{chr(97 + (i * j) % 23)}" for j in range(1, 40)), "en" if i % 3 else "de", "hot" if i % 2 else f"s{i % 7}") for i in range(300)]
    assert found(divergence.source_divergence(frame(spark, rows, 13))) == plain(rows, 30)


def test_empty_tables(spark):
    assert divergence.source_divergence(frame(spark, ODD).limit(0)).collect() == []
    assert found(divergence.source_divergence(frame(spark, [(None, None, None)]))) == set()

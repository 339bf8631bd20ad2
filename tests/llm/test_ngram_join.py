import random

import numpy as np
import pytest

from postlake.llm.ngram_join import ngram_join
from postlake.llm.prefixes import prefix


def plain(rows, percent=85, width=4):
    """Sets, links and components of (id, text), one pair after the other."""
    sets, n = {}, []
    for i, t in rows:
        w = (t or "").translate({k: k + 32 for k in range(65, 91)})
        for space in "\t\n\x0b\x0c\r":
            w = w.replace(space, " ")
        w = [x for x in w.split(" ") if x]
        s = {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
        n.append((i, len(s)))
        if i is not None and s:
            sets.setdefault(i, []).append(s)
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    alike = lambda x, y: min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if root(a) != root(b) and any(alike(x, y) for x in sets[a] for y in sets[b]):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return sorted(((i, k, root(i)) for i, k in n), key=str)


def joined(df, **settings):
    got = ngram_join(df, **settings)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(seed=5):
    """Near copies of several bases and of each other, a line that many texts share, short texts around the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    line = " ".join(word() for _ in range(20))
    texts = []
    for size in (30, 60, 200):
        base = [word() for _ in range(size)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, size // 25 + 1)):
                copy[rng.randrange(size)] = word()
            texts.append(" ".join(copy))
    texts += [f"{line} {' '.join(word() for _ in range(rng.randint(0, 5)))}" for _ in range(40)]
    texts += [" ".join("abcdefghijkl"[: rng.randint(1, 12)]) for _ in range(25)]
    texts += [" ".join(word() for _ in range(50)) for _ in range(20)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("settings", [{}, {"deepest": 1, "rounds": 0, "counters": 16}, {"block": 4, "rounds": 3, "crowd": 2}, {"percent": 60, "width": 2}])
def test_equals_brute_force(spark, make, settings):
    rows = corpus()
    assert joined(make(rows), **settings) == plain(rows, settings.get("percent", 85), settings.get("width", 4))


def test_odd_rows(make):
    """Nulls, blank and very long texts, copies, repeated rows, ids with several texts, null ids; white space and case."""
    long = " ".join(f"w{i % 7001}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\x0btwo"), (6, "one two three"), (7, long), (8, long + " more"), (9, "É two three four five"), (10, "é two three four five")]
    rows += [(11, "a b c d e f g h"), (11, long + " more"), (11, "a b c d e f g h"), (None, "one two"), (None, None), (12, "A B C D E F G H"), (13, "a b c d e f g h"), (2, "")]
    assert joined(make(rows)) == plain(rows)


def test_groups_and_empty_tables(make):
    """A third of all rows are copies, another third near copies; an empty table; a table of empty texts."""
    base = [f"v{i}" for i in range(120)]
    rows = [(i, " ".join(base)) for i in range(100)] + [(i, " ".join([*base[: i % 118], f"own{i}", *base[i % 118 + 1 :]])) for i in range(100, 200)]
    rows += [(i, " ".join(f"x{i}y{j}" for j in range(40))) for i in range(200, 300)]
    right = plain(rows)
    assert joined(make(rows).repartition(5)) == joined(make(rows).repartition(1)) == right
    assert len({c for *_, c in right}) == 101
    assert joined(make(rows).limit(0)) == [] and joined(make([(1, None), (2, "")])) == plain([(1, None), (2, "")])


def test_prefixes_lengthen_only_where_they_pay():
    """A set of rare shingles asks for more matches than one whose next shingle is very frequent; the rarest come first."""
    items = np.arange(1, 101, dtype=np.uint64) << np.uint64(40)
    rare, depth, typical = prefix(items, np.arange(1, 101), 0.0, 85, 8)
    assert depth > 1 and len(rare) == 15 + depth and (rare == items[: 15 + depth]).all()
    first, shallow, higher = prefix(items, np.where(np.arange(100) < 16, 2, 1_000_000), 0.0, 85, 8)
    assert shallow == 1 and len(first) == 16 and higher > typical

import random

import duckdb
import numpy as np
import pytest

from postlake.llm import queries
from postlake.llm import components as component_steps
from postlake.llm.common import cut, lookup, measured, spread
from postlake.llm.components import components
from postlake.llm.decontaminate import align, aligned, contaminated, without_contaminated, words
from postlake.llm.licenses import scan_licenses
from postlake.llm import near_dedup
from postlake.llm.near_dedup import near_duplicates, one_of_each
from postlake.llm.prefixes import confirmed


def brute_groups(rows, percent, width=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = (t or "").translate(low).encode().split()
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or (common and 100 * common >= percent * len(sets[i] | sets[j])):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [(r[0], len(s), min(rows[k][0] for k in range(len(rows)) if find(k) == find(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("percent", "block"), [(85, 256), (80, 16)])
def test_near_duplicates_equal_brute_force(spark, make, percent, block):
    """A large group around the threshold, where many links pass by the least member; small blocks force the exact rest."""
    rng = random.Random(percent)
    base = [f"t{i}" for i in range(120)]
    rows = [(1000 + i, edited(rng, base, rng.randrange(1, 6))) for i in range(150)]
    rows += [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60)))) for i in range(100)]
    rows += [(200, None), (201, ""), (202, " \t"), (203, "A b"), (204, "a B"), (205, "a b c d e"), (206, "A B C D E"), (206, "A B C D E"), (207, "a b c d")]
    got = near_duplicates(make(rows), percent=percent, block=block).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_groups(rows, percent))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_query_equals_sql(spark, sf):
    got = queries.op8_near_dedup(spark, sf).toPandas().sort_values("doc_id").to_numpy().tolist()
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == duckdb.sql(queries.OP8_SQL + " ORDER BY doc_id").df().to_numpy().tolist()


def test_near_duplicates_edges(spark, make):
    assert near_duplicates(make([(1, "a")]).where("false")).count() == 0
    got = near_duplicates(make([(None, "a b"), (5, "a b"), (None, None), (7, "x " * 100_000)])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [(-1, -1, True), (-1, -1, True), (5, 5, True), (7, 7, True)]
    docs = make([(1, "a b"), (2, "a b"), (2, "a b"), (3, "c"), (3, "c"), (None, "z"), (None, "z")])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, -1, 1, 3]


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id as a", "id + 1 as b").union(spark.sql("select 900L as a, 900L as b"))
    assert {(r["node"], r["root"]) for r in components(edges).collect()} == {(i, 0) for i in range(201)}
    assert components(edges.where("false")).count() == 0


def test_few_edges_make_few_tasks(spark, monkeypatch):
    """A star step over few edges is written by one task, also where the session shuffles to many."""
    parts = []

    def counted(df):
        done = measured(df)
        parts.append(done.rdd.getNumPartitions())
        return done

    monkeypatch.setattr(component_steps, "measured", counted)
    changed = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        got = components(spark.range(60).selectExpr("id as a", "id - id % 20 as b")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r["node"], r["root"]) for r in got} == {(i, i - i % 20) for i in range(60)}
    assert set(parts[1:]) == {1}


def brute_score(item, text):
    h, best = np.zeros((len(item) + 1, len(text) + 1), int), 0
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if item[i - 1] == text[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
            best = max(best, h[i, j])
    return best


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item, text = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 25))
        score, start, end = align(item, text)
        assert score == brute_score(item, text)
        if score:
            assert brute_score(item, text[start:end]) == score


def test_contamination_finds_copies_and_edits_only(spark, make):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["the", "of"]) if rng.random() < 0.3 else f"v{rng.randrange(5000)}" for _ in range(n))
    items = [(i, text(30)) for i in range(20)]
    words = items[3][1].split()
    rows = [(0, text(200)), (1, f"{text(90)} {items[1][1].upper()}, {text(90)}"), (2, text(40) + " " + " ".join(w for k, w in enumerate(words) if k % 6) + " " + text(9)), (3, None), (4, "")]
    rows += [(5, text(50) + " " + " ".join(w if k % 5 else "changed" for k, w in enumerate(items[7][1].split()))), (1, items[1][1]), (8, text(20_000)), (9, " ".join(words[:5]))]
    bench = spark.createDataFrame([*items, (50, None), (51, "two words"), (1, items[1][1])], "item_id long, text string")
    got = contaminated(make(rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (1, 1), (1, 1), (1, 1), (2, 3), (5, 7)]
    assert {r["score"] for r in got if r["doc_id"] == 1} == {1.0}
    # a filter far too small lets everything pass to the join, and loses nothing
    assert sorted(map(tuple, contaminated(make(rows), bench, most_bits=6).collect())) == sorted(map(tuple, got))
    docs = make([*rows, (None, "z")])
    kept = without_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or -(r["doc_id"] is None)) for r in kept.collect()) == [-1, 0, 3, 4, 8, 9]
    assert contaminated(make(rows).where("false"), bench).count() == 0 == contaminated(make(rows), bench.where("false")).count()


def test_copies_of_an_item_are_reported_each(spark, make):
    bench = spark.createDataFrame([(i, "one passage that is there many times") for i in range(40)] + [(None, "one passage that is there many times"), (90, "another item of some few words")], "item_id long, text string")
    got = contaminated(make([(1, "well one passage that is there many times"), (2, "no")]), bench).collect()
    assert sorted((r["doc_id"], -1 if r["item_id"] is None else r["item_id"]) for r in got) == [(1, i) for i in range(-1, 40)]


def test_short_items_and_ties(spark, make):
    bench = spark.createDataFrame([(1, "two words"), (2, "word"), (3, ""), (4, "!"), (5, "alpha beta gamma delta")], "item_id long, text string")
    docs = make([(1, "here two words are"), (2, "two other words"), (3, "Word!"), (4, "alpha beta gamma delta x alpha beta gamma delta"), (5, "a " * 50_000 + "alpha beta gamma delta")])
    got = sorted((r["doc_id"], r["item_id"], r["score"], r["first_word"], r["end_word"]) for r in contaminated(docs, bench).collect())
    assert got == [(1, 1, 1.0, 1, 3), (3, 2, 1.0, 0, 1), (4, 5, 1.0, 0, 4), (5, 5, 1.0, 50_000, 50_004)]
    assert sorted(r["doc_id"] for r in without_contaminated(docs, bench).collect()) == [1, 2, 3]


def test_recall_on_edited_copies_against_full_alignment(spark, make):
    """Words of a small vocabulary, so that many n-grams are common; copies with a third or fewer of their words changed, dropped or added."""
    rng = random.Random(8)
    text = lambda n: [f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(n)]
    items = [text(rng.randrange(20, 60)) for _ in range(30)]

    def copied(item):
        rate = rng.random() / 3
        return [w for x in item for w in ([x] if rng.random() > rate else rng.choice([["z"], [], [x, "y"], text(1)]))]

    rows = [(i, " ".join(text(60) + (copied(items[i % 30]) if i % 2 else []) + text(60))) for i in range(240)]
    truth = set()
    for i, t in rows:
        for k, item in enumerate(items):
            codes = {w: n for n, w in enumerate(dict.fromkeys(item))}
            if align(np.array([codes[w] for w in item]), np.array([codes.get(w, -1) for w in t.split()]))[0] >= 0.4 * 2 * len(item):
                truth.add((i, k))
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(make(rows), spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")).collect()}
    copies = {(i, i % 30) for i, _ in rows if i % 2} & truth
    # pairs that are no copies align by chance, over words that nearly every text holds
    assert got <= truth and len(copies) > 80 and len(got & copies) >= 0.95 * len(copies) and len(got) >= 0.9 * len(truth)
    assert aligned(words("x a b c d"), words("a b c d")) == (1.0, 1, 5)


def test_common_passages_make_no_pairs(make, monkeypatch):
    """Documents that share 200 of 255 words are in common buckets and not linked: what is compared in full grows with their number."""
    compared = []
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *a: compared.append(pairs.count()) or confirmed(pairs, *a))
    passage = " ".join(f"p{i}" for i in range(200))
    for n in (150, 300):
        rows = [(i, f"{passage} " + " ".join(f"d{i}w{j}" for j in range(55))) for i in range(n)] + [(n + i, f"{passage} x" + " own" * i) for i in range(4)]
        got = near_duplicates(make(rows)).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_groups(rows, 80)
    assert compared and max(compared) <= 304


def test_many_near_copies_meet_their_typical_one(make, monkeypatch):
    """Of 400 near copies with up to six edits each, most are no links: what is compared grows with their number, not its square."""
    compared = []
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *a: compared.append(pairs.count()) or confirmed(pairs, *a))
    rng = random.Random(3)
    base = [f"t{i}" for i in range(150)]
    rows = [(i, edited(rng, base, rng.randrange(1, 7))) for i in range(400)]
    got = near_duplicates(make(rows), percent=85).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_groups(rows, 85))
    assert compared and sum(compared) <= 800


def test_an_id_with_two_texts_is_one_document(spark, make):
    a, b = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")
    got = near_duplicates(make([(5, a), (5, b), (7, a + " x"), (8, b + " y"), (9, "else " * 9)])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(5, 5), (5, 5), (7, 5), (8, 5), (9, 9)]


def test_lookups_spread_hot_keys(spark):
    left = spark.range(600).selectExpr("case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 40 end as k", "id as v")
    right = cut(spark.range(30).selectExpr("id as k", "id * 10 as w"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(str, left.join(right, ["k"], how).collect()))
        for most in (0, 100):
            assert sorted(map(str, lookup(left, right, ["k"], how, most=most, parts=8).collect())) == want, (how, most)
    assert sorted(map(str, spread(left, right, ["k"], right["w"] == 70).collect())) == sorted(map(str, left.join(right, ["k"]).collect()))


def test_licenses_inherit_from_the_nearest_directory(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("a/x.py", "plain"), ("a/b/c/d.py", None), ("a/b/own.py", "# Licensed under the Apache License, Version 2.0.\ncode"), ("z/y.py", "no licence to speak of at all in this place here"),
        ("a/x.py", "plain"), ("ab/q.py", ""), (None, "text"), ("top", "word " * 20_000 + "SPDX-License-Identifier: MIT"),
    ]
    files = spark.createDataFrame([(p, t, "k", 1.0) for p, t in rows], "path string, text string, license string, score double")
    got = {r["path"]: (r["license"], r["origin"], r["directory"]) for r in scan_licenses(files).collect()}
    assert got["a/LICENSE"] == ("MIT", "file", None) and got["a/b/COPYING.txt"] == ("GPL-3.0", "file", None)
    assert got["a/x.py"] == ("MIT", "inherited", "a") and got["a/b/c/d.py"] == ("GPL-3.0", "inherited", "a/b")
    assert got["a/b/own.py"] == ("Apache-2.0", "header", None)
    assert all(got[p] == (None, "none", None) for p in ("z/y.py", "ab/q.py", None)) and len(got) == 9
    assert scan_licenses(files.where("false")).count() == 0


def test_licenses_beside_other_words_and_over_lines(spark):
    prose = " ".join(f"word{i}" for i in range(40))
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("1", "Copyright 2019 Acme Corp. Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("2", "Copyright (c) 2021 Jane Doe. Released under the MIT License.", "MIT"),
        ("3", f"{prose} {gpl} {prose}", "GPL-3.0"), ("4", f"{prose}\n# This work is licensed under the GNU\n# General Public License,\n# version 3.\n{prose}", "GPL-3.0"),
        ("5", f"/* {prose} This software was dedicated to the public\n * domain under CC0 1.0 Universal. */", "CC0-1.0"), ("6", f"{prose} this license and that licence of {prose}, under the licence of the author {prose}", None),
        ("7", f"{prose} was released under the license of {prose}", None), ("8", "Copyright 2020 The Authors, all rights reserved, Permission is hereby\ngranted, free of charge, to any person obtaining a copy of this software\nand associated documentation files (the Software), to deal in the Software without restriction.", "MIT"),
        ("9", f"licensed license {prose} Licensed under CC BY-NC 4.0. {prose} license", "CC-BY-NC-4.0"), ("d/LICENSE", f"{prose} Released under the ISC License. {prose}", "ISC"),
    ]
    got = {r["path"]: (r["license"], r["origin"]) for r in scan_licenses(spark.createDataFrame([r[:2] for r in rows], "path string, text string")).collect()}
    assert got == {p: (k, ("file" if "/" in p else "header") if k else "none") for p, _, k in rows}


def test_license_ties_and_long_lines(spark):
    twice = (("B", "Released under the same License."), ("A", "Released under the same License."))
    files = spark.createDataFrame([("x", "Released under the same License."), ("y", "word " * 60_000 + "Released under the same License. " + "more " * 60_000)], "path string, text string")
    assert {(r["path"], r["license"]) for r in scan_licenses(files, templates=twice).collect()} == {("x", "A"), ("y", "A")}


def test_license_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op5_licenses(spark, sf).toPandas().sort_values("doc_id").fillna("-").to_numpy().tolist()
    assert {r[4] for r in got} == {"file", "header", "inherited", "none"}
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == duckdb.sql(queries.OP5_SQL + " ORDER BY doc_id").df().fillna("-").to_numpy().tolist()


def test_words_are_hashed_alike_in_steps_and_workers_keep_little(monkeypatch):
    """A word's number doesn't depend on the step it falls in; what a worker keeps to its end is under 20 MB."""
    import pyarrow as pa

    from postlake.llm import common

    texts = pa.array(["one two  three", None, "x" * 300, "four\tfive " * 40, ""])
    monkeypatch.setattr(common, "_POWERS", [p[:1] for p in common._POWERS])
    whole = [a.tolist() for a in common.hashed_words(texts)]
    assert sum(p.nbytes for p in common._POWERS) < 20_000_000
    monkeypatch.setattr(common, "_STEP", 16)
    assert [a.tolist() for a in common.hashed_words(texts)] == whole


def test_a_step_of_a_worker_holds_little(monkeypatch):
    """Hashing and encoding 4 MB of short texts takes little beside the texts: what a step makes is bounded."""
    import random
    import tracemalloc

    import public_tokenizers as P
    import pyarrow as pa

    from postlake.llm import common
    from postlake.llm.byte_bpe import ByteBPE

    pick = random.Random(5)
    words = ["".join(pick.choices("abcdefghij", k=pick.randrange(2, 200))) for _ in range(4000)]
    batch = pa.record_batch({"id": range(800), "text": [" ".join(pick.choices(words, k=50)) for _ in range(800)]})
    bpe = ByteBPE(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    monkeypatch.setattr(common, "_POWERS", [p[:1] for p in common._POWERS])

    def peak(step) -> int:
        tracemalloc.start()
        for piece in common.slices([batch]):
            step(piece)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(lambda piece: common.hashed_words(piece.column(1))) < 16_000_000
    assert peak(lambda piece: bpe.encode(piece.column(1).to_pylist())) < 24_000_000

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm.language import ByteBiGRU, pooled, predict_languages, windows
from postlake.llm.language import train as train_network
from postlake.llm.quality import Follower, features, good_quality, quality_scores
from postlake.llm.quality import train as train_weights

SF = "/root/testdata/sf0.1"


def test_gradients_match_differences():
    net = ByteBiGRU(3, hidden=4, seed=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = np.random.default_rng(0).integers(1, 6, (5, 4)).astype(np.uint8), np.array([0, 2, 1, 0])
    x[3:, 1] = 0

    def loss():
        p = net.probabilities(x)
        return -np.log(p[:, np.arange(4), y])[x > 0].mean()

    g = net.gradients(x, y)
    for name, at in (("Egf", (3, 1)), ("Enb", (2, 0)), ("Ugf", (1, 5)), ("Unb", (0, 2)), ("Wf", (1, 1)), ("c", (2,))):
        kept, h = net.p[name][at], 1e-2
        net.p[name][at] = kept + h
        up = loss()
        net.p[name][at] = kept - h
        down = loss()
        net.p[name][at] = kept
        assert g[name][at] == pytest.approx((up - down) / (2 * h), rel=0.05, abs=2e-4), name


def test_windows_cover_whole_texts():
    x, counts = windows([b"abc", b"", b"abcdefgh"], 4)
    assert counts.tolist() == [1, 0, 2] and x.tobytes() == b"abc\0abcdefgh"


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 3000")
    got = predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 3000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98


def test_language_edges(spark, make):
    docs = spark.createDataFrame([(0, "the cat", "en", 1), (2, "el gato", "es", 1), (4, None, "en", 1), (5, "12 ++", None, 1), (5, "12 ++", None, 1), (6, "", "en", 1), (9, "a" * 100_000, None, 1)], "doc_id long, text string, lang string, id int")
    got = predict_languages(docs).collect()
    assert len(got) == 7
    assert {r["lang_pred"] for r in got if r["doc_id"] in (4, 5, 6)} == {"und"}
    assert all(r["lang_pred"] in ("en", "es") for r in got if r["doc_id"] in (0, 2, 9))
    assert predict_languages(docs.where("false")).count() == 0
    assert {r["lang_pred"] for r in predict_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    bad, good = [r["predicted"] for r in got if r["quality"] == 0], [r["predicted"] for r in got if r["quality"] == 1]
    assert np.mean(bad) < 0.05 and np.mean(good) > 0.99
    flat = np.array([[r["score"], r["predicted"]] for r in got])
    assert ((flat[:, 0] >= 0.3) == (flat[:, 1] == 1)).all()


def test_quality_edges(spark, make):
    docs = make([(1, "good words here"), (2, "BAD!! BAD!! BAD!!"), (3, None), (4, ""), (2, "BAD!! BAD!! BAD!!"), (6, "x " * 50_000)])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] == 1} == {zlib.crc32(b"1") % 5 == 0}
    assert quality_scores(docs.where("false"), labels).count() == 0
    assert {r["score"] for r in quality_scores(docs, labels.where("false")).collect()} == {0.5}
    kept = good_quality(docs, labels.where("false"))
    assert kept.columns == docs.columns and kept.count() == 6


def test_follower_matches_the_update_by_hand():
    model = Follower(4, alpha=1.0, beta=1.0, l1=0.0, l2=0.0)
    model.learn(np.array([3, 0]), np.array([0.5, 1.0]), 1)
    g = (0.5 - 1) * np.array([0.5, 1.0])
    assert model.z[[3, 0]] == pytest.approx(g) and model.n[[3, 0]] == pytest.approx(g * g)
    assert model.weights()[[3, 0]] == pytest.approx(-g / (1 + np.abs(g)))


def test_features():
    at, x = features("a b a b", 18)
    assert len(at) == len(set(at.tolist())) and x[at == 0] == 1 and len(features(None, 18)[0]) == 1


def test_signs_that_are_no_letters(spark, make):
    docs = make([(0, "the cat"), (2, "el gato"), (4, "½ ² Ⅷ ① 12"), (5, "ª"), (6, "ж")])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 0, "en").when(F.col("doc_id") == 2, "es"))
    got = {r["doc_id"]: r["lang_pred"] for r in predict_languages(docs).collect()}
    assert got[4] == "und" and got[5] != "und" and got[6] != "und"


def test_language_query_equals_one_text_at_a_time(spark):
    """The network over each whole text alone; ties go to the first language."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    languages, net = train_network(docs, "doc_id", "text", "lang")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict_languages(docs).collect()}
    for r in docs.collect():
        if r["text"] and any(c.isalpha() for c in r["text"]):
            p = pooled(net, [r["text"].encode()], len(languages), 128)[0]
            assert got[r["doc_id"]][0] == languages[int(p.argmax())] and got[r["doc_id"]][1] == pytest.approx(p.max(), abs=1e-5)


def test_quality_query_equals_plain_python(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    taught = [(str(i), t, y) for i, t, y in ((r["doc_id"], texts.get(r["doc_id"], ""), r["quality"]) for r in labels.collect()) if i in texts and y in (0, 1) and zlib.crc32(str(i).encode()) % 5]
    taught.sort(key=lambda x: (zlib.crc32(x[0].encode()), x[0], x[2]))
    model = Follower(18)
    for epoch in range(3):
        for k in np.random.default_rng(epoch).permutation(len(taught)):
            at, x = features(taught[k][1], 18)
            model.learn(at, x.astype("<f4").astype(float), taught[k][2])
    weights = model.weights()
    for r in quality_scores(docs, labels).collect():
        at, x = features(texts[r["doc_id"]], 18)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-(weights[at] @ x))), abs=1e-6)


def test_a_repeated_id_teaches_once(spark, make):
    docs = make([(1, "good words here"), *[(2, f"BAD!! BAD!! {i}") for i in range(50)], (6, "fine text")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1)], "doc_id long, quality int")
    once = make([(1, "good words here"), (2, min(("BAD!! BAD!! %d" % i for i in range(50)), key=lambda t: tuple(a.astype(k).tobytes() for a, k in zip(features(t, 18), ("<i4", "<f4"), strict=True)))), (6, "fine text")])
    assert (train_weights(docs, labels, "doc_id", "text", "quality") == train_weights(once, labels, "doc_id", "text", "quality")).all()

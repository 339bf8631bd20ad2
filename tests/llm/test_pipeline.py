import public_tokenizers as P

import corpus_pipeline
from postlake.llm.byte_bpe import codec
from postlake.llm.decontaminate import words


def test_stages_one_after_another(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    texts = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == columns, name
            texts[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        kept.append(docs.count())
    assert kept[0] > kept[1] > kept[2] >= kept[3] == kept[4] == kept[5]
    assert len(set(texts["near_dedup"].values())) == len(texts["near_dedup"])
    items = [b" ".join(words(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(item in b" ".join(words(t)) for t in texts["decontaminate"].values() for item in items)
    bpe = codec(P.path(corpus_pipeline.RANKS), P.PATTERN)
    for r in docs.collect():
        assert bpe.decode(bytes(r["ids"])).decode() == texts["secrets"][r["doc_id"]]
    assert corpus_pipeline.run(spark, sf).count() == kept[-1]


def test_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_stages_with_nulls_repeats_long_texts_and_other_columns(spark, sf):
    """Every stage keeps columns and clean rows whatever their names and values are."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    text = docs.orderBy("doc_id").first()["text"]
    odd = spark.createDataFrame([(None, None, None, None, None), (900_001, None, "en", "s", None), (900_002, "", "en", "s", 0), (900_003, text + " tail " + " ".join(f"q{i} of" for i in range(60_000)), "en", "s", 1), (900_004, text, None, None, 2), (900_004, text, None, None, 2)], docs.schema)
    docs = docs.unionByName(odd).selectExpr("*", "1 as key", "2 as id", "'x' as label", "3.0 as score")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf)
        if name != "encode":
            assert after.columns == docs.columns, name
        docs = after.cache()
        assert docs.count() > 0, name
    ids = [r["doc_id"] for r in docs.collect()]
    assert ids.count(900_004) <= 1 and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})

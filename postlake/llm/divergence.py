"""Audit of how the sources of a language differ in their words, by exact integer shares.

1. Tasks count terms of their documents in DuckDB, one row for each term of a language with its sources side by side.
2. Spark deals these rows out by a hash of language and term; DuckDB adds each shard up, keeps the terms in enough
   documents, and states what every source and the language as a whole holds of them.
3. Shards of kept terms meet the totals of all sources; DuckDB sums each shard's differences of every pair of sources and
   ranks its terms. Sums run over terms that a source holds; what both lack is one product. Spark merges sums and ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, slices

#: Terms: runs of ASCII letters and characters beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Shares are counted in parts of this many; each term is given so many occurrences more than it has.
PARTS, EXTRA = 1_000_000_000, 5

_COUNT = f"""
WITH held AS (SELECT i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(text, '{TERM}') AS terms FROM piece),
each_ AS (SELECT i, lang, source, term, count(*) AS n FROM (SELECT i, lang, source, unnest(terms) AS term FROM held) GROUP BY ALL),
by_source AS (SELECT lang, source, term, sum(n)::BIGINT AS n, count(*) AS docs FROM each_ GROUP BY ALL UNION ALL SELECT DISTINCT lang, source, '', 0, 0 FROM held)
SELECT lang, term, sum(docs)::BIGINT AS docs, list(source) AS sources, list(n) AS counts FROM by_source GROUP BY ALL
"""

#: A row without a source stands for the language; the empty term marks that a source occurs.
_KEPT = """
WITH shard AS MATERIALIZED (SELECT lang, term, docs, unnest(sources) AS source, unnest(counts) AS n, generate_subscripts(sources, 1) = 1 AS once FROM arriving),
wide AS (SELECT lang, term FROM shard GROUP BY ALL HAVING term = '' OR sum(docs) FILTER (once) >= $least),
kept AS (SELECT lang, term, source, sum(n)::BIGINT AS n FROM shard SEMI JOIN wide USING (lang, term) GROUP BY ALL)
SELECT lang, term, source, n FROM kept UNION ALL SELECT lang, term, NULL, sum(n)::BIGINT FROM kept GROUP BY ALL
"""

_SHARE = f"(1 + ({PARTS}::HUGEINT * ({{n}} + {EXTRA})) // (t.total + {EXTRA} * t.kinds))::BIGINT"
_PARTIAL = f"""
WITH held AS MATERIALIZED (SELECT * FROM arriving),
totals AS (SELECT DISTINCT lang, source, total, kinds, {_SHARE.format(n=0)} AS least FROM held t WHERE term IS NULL),
shares AS MATERIALIZED (
    SELECT k.lang, k.term, k.source, k.n, {_SHARE.format(n="k.n")} AS p
    FROM held k JOIN totals t ON t.lang = k.lang AND t.source IS NOT DISTINCT FROM k.source WHERE k.term IS NOT NULL
), pairs AS (
    SELECT a.lang, a.source AS a, t.source AS b, abs(a.p - coalesce(b.p, t.least)) AS gap, b.p IS NULL AS lone
    FROM shares a JOIN totals t ON t.lang = a.lang AND t.source <> a.source
    LEFT JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source = t.source WHERE a.source IS NOT NULL
), sums AS (SELECT lang, a, b, sum(gap)::BIGINT AS value, count(*) AS seen, coalesce(sum(gap) FILTER (lone), 0)::BIGINT AS back, count(*) FILTER (lone) AS back_seen FROM pairs GROUP BY ALL)
SELECT 'pair' AS part, lang, a AS source, b AS item, value, seen FROM sums
UNION ALL SELECT 'pair', lang, b, a, back, back_seen FROM sums WHERE back_seen > 0
UNION ALL SELECT 'term', lang, source, term, p - q, 1 FROM (SELECT s.*, w.p AS q FROM shares s JOIN shares w ON w.lang = s.lang AND w.term = s.term AND w.source IS NULL WHERE s.n > 0 AND s.source IS NOT NULL)
    WHERE p > q QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) <= $top
"""


def _ask(sql: str, name: str, rows: pa.Table | pa.RecordBatchReader, memory: str, **settings) -> pa.Table:
    """The result of one statement over Arrow rows known as `name`, on one thread within bounded memory; what spills is removed."""
    with duckdb.connect(config={"threads": 1, "memory_limit": memory, "preserve_insertion_order": False}) as engine:
        engine.register(name, rows)
        return engine.sql(sql, params=settings or None).to_arrow_table()


def _answers(sql: str, schema: str, memory: str, **settings):
    """For mapInArrow: a statement over the rows of a whole shard, which DuckDB reads batch by batch."""
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            reader = pa.RecordBatchReader.from_batches(first.schema, (b for some in ([first], batches) for b in some))
            yield from _ask(sql, "arriving", reader, memory, **settings).select(names).to_batches(max_chunksize=1 << 16)

    return run


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = 30, top: int = 50, shard_rows: int = 100_000, memory: str = "400MB") -> DataFrame:
    """Per language and source: lang, source, part, item, value (long), rank (int, from 1 by value descending, then item in UTF-8).

    Null texts, languages and sources are read as ''. A language keeps the terms that at least `least` of its rows hold; a
    group (language and source, or the whole language) gives a kept term p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)),
    where N counts kept terms in the group and V is the number of kept terms. Part `pair`: item is each other source of the
    language, value the summed difference of p over all V terms (0 if V = 0). Part `term`: item is each kept term that the
    source holds and favours over its language, value that difference, ranks to `top`. All arithmetic is exact.

    Every row counts as a document, repeated ones each; a language with one source has no pairs; ties are ranked by item.
    Other columns are left out, whatever their names; an empty table gives an empty result.

    `shard_rows`: about how many (term, source) rows DuckDB joins at once. The first shards are Spark's shuffle partitions;
    beyond `memory` DuckDB spills within a task.
    """
    rows = docs.select(*(F.col(c).cast("string").alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 0, 32 << 20):
            columns = {"i": pa.array(range(piece.num_rows)), "text": pc.ascii_lower(piece.column(0)), "lang": piece.column(1), "source": piece.column(2)}
            yield from _ask(_COUNT, "piece", pa.table(columns), memory).to_batches(max_chunksize=1 << 16)

    counted = rows.mapInArrow(count, "lang string, term string, docs bigint, sources array<string>, counts array<bigint>")
    schema = "lang string, term string, source string, n bigint"
    kept = cut(counted.repartition("lang", "term").mapInArrow(_answers(_KEPT, schema, memory, least=least), schema))
    # totals: one row for each source of a language and one, without a source, for the language
    kinds = kept.where("source is null").groupBy("lang").agg(F.sum((F.col("term") != "").cast("long")).alias("kinds"))
    totals = cut(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(kinds, "lang"))
    shards = max(1, -(-kept.count() // shard_rows))
    dealt = kept.where("term <> ''").withColumn("shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int"))
    everywhere = totals.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    dealt = dealt.unionByName(everywhere.where("kinds > 0"), allowMissingColumns=True).repartition(shards, "shard").drop("shard")
    schema = "part string, lang string, source string, item string, value bigint, seen bigint"
    partial = cut(dealt.mapInArrow(_answers(_PARTIAL, schema, memory, top=top), schema))
    share = F.expr(f"CASE WHEN kinds = 0 THEN 0 ELSE 1 + {PARTS * EXTRA} div (total + {EXTRA} * kinds) END")
    sides = totals.where("source is not null").select("lang", "kinds", "source", share.alias("p"))
    others = sides.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    summed = partial.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("held"), F.sum("seen").alias("seen"))
    pairs = sides.join(others, "lang").where("source <> item").join(summed, ["lang", "source", "item"], "left")
    value = F.coalesce("held", F.lit(0)) + (F.col("kinds") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("p") - F.col("q"))
    out = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    out = out.unionByName(partial.where("part = 'term'").select("lang", "source", "part", "item", "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return out.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))

"""JSON of unknown shape. Members keep the text's order; VARIANT tells a text that looks like JSON from a nested value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lexicons import TEXT_KEYS
from .text import let

_STRICT = {"allowSingleQuotes": "false"}
_NODES = "array<struct<path:array<int>,json:string>>"


def members(json: Column) -> Column:
    """array<struct<key, json, kind, value>> of an object or array in order: kind is `text` (json is it), `node` or `other`; empty where it doesn't parse."""
    read = lambda kind: F.from_json(json, kind, _STRICT)

    def one(key: Column, raw: Column, value: Column) -> Column:
        kind = F.when(F.schema_of_variant(value) == "STRING", "text").when(raw.startswith("{") | raw.startswith("["), "node").otherwise("other")
        return F.struct(key.alias("key"), raw.alias("json"), kind.alias("kind"), value.alias("value"))

    in_list = F.zip_with(read("array<string>"), read("array<variant>"), lambda raw, value: one(F.lit(None).cast("string"), raw, value))
    in_object = let(F.map_entries(read("map<string,string>")), lambda e: F.zip_with(e, F.map_values(read("map<string,variant>")), lambda m, value: one(m["key"], m["value"], value)))
    return F.coalesce(F.when(json.startswith("["), in_list).otherwise(in_object), F.array().cast("array<struct<key:string,json:string,kind:string,value:variant>>"))


def with_lists(df: DataFrame, json: str, name: str, depth: int = 14) -> DataFrame:
    """df with `name`: array<struct<path, json>>, every array in a JSON column down to `depth` levels below the root, each before what is in it."""
    start = F.ltrim(F.regexp_replace(json, r"^\s+", ""))
    root = F.array(F.struct(F.array().cast("array<int>").alias("path"), start.alias("json")))

    def below(node: Column) -> Column:
        return F.filter(F.transform(members(node["json"]), lambda m, i: F.when(m["kind"] == "node", F.struct(F.array_append(node["path"], i).alias("path"), m["json"].alias("json")))), lambda n: n.isNotNull())

    levels = [f"{name}_{k}" for k in range(depth + 1)]
    out = df.withColumn(levels[0], F.when(start.rlike(r"^[\[{]"), root).otherwise(F.array().cast(_NODES)))
    for above, here in zip(levels, levels[1:], strict=False):
        out = out.withColumn(here, F.flatten(F.transform(above, below)))
    return out.withColumn(name, F.sort_array(F.filter(F.concat(*levels), lambda n: n["json"].startswith("[")))).drop(*levels)


def _string(value: Column, path: str) -> Column:
    found = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(value, path, "string"))


def said(value: Column, depth: int = 3) -> Column:
    """The text of a VARIANT: itself, what names an object, the first three of an array (arrays of arrays to `depth`); else empty."""
    inner = F.lit("")
    if depth:
        first = F.transform(F.slice(F.try_variant_get(value, "$", "array<variant>"), 1, 3), lambda v: said(v, depth - 1))
        inner = F.array_join(F.filter(first, lambda t: t != ""), ", ")
    return F.coalesce(_string(value, "$"), *(_string(value, f"$.{k}") for k in TEXT_KEYS), F.when(F.schema_of_variant(value).startswith("ARRAY"), inner), F.lit(""))


def first_said(entries: Column, keys: tuple[str, ...]) -> Column:
    """The first text that is not empty among the members whose key, in any case, is one of the keys."""
    texts = F.transform(F.filter(entries, lambda m: F.lower(m["key"]).isin(*keys)), lambda m: F.when(m["kind"] == "text", m["json"]).otherwise(said(m["value"])))
    return F.coalesce(F.get(F.filter(texts, lambda t: t != ""), F.lit(0)), F.lit(""))

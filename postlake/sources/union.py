"""One table of postings from all sources, in one order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import JOB, order

#: Sources in the order in which a run reads them; of equal postings the earlier source's comes first.
LAYERS = ("boards", "cached", "discovered", "searched", "channels", "pages")


def united(**sources: DataFrame) -> DataFrame:
    """Postings (`tables.JOB`, texts never null, `_ord` led by `layer`) of the sources given by name, see `LAYERS`.

    A column that a source lacks is empty there; other columns are left out. A source that reads nothing, or is not given,
    takes nothing from the others.
    """
    names = [c.split(" ")[0] for c in JOB.split(", ")][:-1]

    def part(layer: int, df: DataFrame) -> DataFrame:
        texts = (F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) if n in df.columns else F.lit("").alias(n) for n in names)
        kind = dict(df.dtypes).get("_ord", "")
        at = F.col("_ord") if kind.startswith("struct") else order("_ord") if kind else order(F.lit(0), 0, F.xxhash64(*(n for n in names if n in df.columns)))
        return df.select(*texts, F.struct(F.lit(layer).alias("layer"), *(at[f].alias(f) for f in ("row", "page", "place"))).alias("_ord"))

    unknown = set(sources) - set(LAYERS)
    if unknown or not sources:
        raise ValueError(f"sources are {', '.join(LAYERS)}; got {', '.join(sorted(unknown)) or 'none'}")
    return reduce(DataFrame.unionByName, (part(i, sources[n]) for i, n in enumerate(LAYERS) if n in sources))

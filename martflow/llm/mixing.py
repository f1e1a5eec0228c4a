"""Mixing sources to target weights by Poisson replication.

A source's target share of the mixture over its share of the data is its
mean repetition rate.  Each document's count is the inverse of the Poisson
distribution with that mean at a uniform number that a hash of the seed and
the document gives, so counts are the same in every run and partitioning.
Documents are repeated by their counts and ordered by another hash, which is
a global shuffle over range partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from martflow.llm.frames import written

MEAN_PER_DRAW = 64.0   # a larger mean is the sum of several draws
ALPHA = 0.5


def uniform(*parts: Column) -> Column:
    """[0, 1) from the first 13 hex digits of an MD5, exact as a double."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_table(mean: float) -> list[float]:
    """Cumulative probabilities of 0, 1, 2, ... up to where they stop growing."""
    p, total, k, out = math.exp(-mean), 0.0, 0, []
    while True:
        total += p
        out.append(min(total, 1.0))
        k += 1
        p *= mean / k
        if k > mean and total + p == total:
            return out


def rates(docs: DataFrame, weights: dict[str, float] | None = None, source_col: str = "source", size: Column | None = None,
          alpha: float = ALPHA, total: float | None = None) -> DataFrame:
    """(source, size, rate): mean repetitions per source.

    ``weights`` are target shares (any scale); a source that they don't name
    has weight 0 and leaves the mixture.  Without weights the targets are
    sizes to the power ``alpha``.  ``size`` measures a document (default 1, a
    document).  The mixture's size is ``total``, by default that of ``docs``.
    """
    spark = docs.sparkSession
    # sums of integers and decimals: the same in every order of the rows
    measure = F.lit(1) if size is None else size.cast("decimal(38,6)")
    per = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.sum(measure).cast("double").alias("size"))
    if weights is None:
        per = per.withColumn("weight", F.pow("size", F.lit(alpha)))
    else:
        wanted = spark.createDataFrame([(k, float(v)) for k, v in weights.items()] or [(None, 0.0)], "name string, weight double")
        per = per.join(wanted, F.col("source").eqNullSafe(F.col("name")), "left").drop("name").withColumn(
            "weight", F.coalesce("weight", F.lit(0.0)))
    per = written(per, "sources")
    top, all_size = per.agg(F.max("weight"), F.sum(F.col("size").cast("decimal(38,6)")).cast("double")).first()
    if not top or top <= 0:
        return per.select("source", "size", F.lit(0.0).alias("rate"))
    # weights as shares of the largest one, so that their scale doesn't matter
    share = (F.col("weight") / F.lit(top)).cast("decimal(38,20)")
    all_weight = per.agg(F.sum(share).cast("double")).first()[0]
    whole = all_size if total is None else float(total)
    rate = F.when(F.col("size") > 0, share.cast("double") / F.lit(all_weight) * F.lit(whole) / F.col("size")).otherwise(0.0)
    return per.select("source", "size", rate.alias("rate"))


def _tables(batches):
    import pandas as pd
    for b in batches:
        draws = [max(1, math.ceil(r / MEAN_PER_DRAW)) for r in b["rate"]]
        yield pd.DataFrame({"name": b["source"], "draws": draws, "cdf": [poisson_table(r / d) for r, d in zip(b["rate"], draws)]})


def replicated(docs: DataFrame, seed: str = "mix", weights: dict[str, float] | None = None, id_col: str = "doc_id",
               source_col: str = "source", alpha: float = ALPHA, total: float | None = None) -> DataFrame:
    """Every document as often as its count: a struct ``doc`` of its columns,
    ``replica`` (from 1) and ``shuffle_key``; not yet ordered.

    A null source is a source of its own; rows that share an id (or have
    none) get the same count; texts aren't looked at, so null, empty and very
    long ones count as any document; an empty table gives an empty mixture.
    """
    per = written(rates(docs, weights, source_col, alpha=alpha, total=total), "rates")
    tables = written(per.select("source", "rate").mapInPandas(_tables, T.StructType([
        T.StructField("name", T.StringType()), T.StructField("draws", T.IntegerType()),
        T.StructField("cdf", T.ArrayType(T.DoubleType()))])), "poisson")
    if weights is not None and len(weights) < 10_000:
        tables = F.broadcast(tables)  # a row per named source or without any rate
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    key = F.col(f"doc.`{id_col}`")
    draw = lambda i: F.size(F.filter("cdf", lambda c: c <= uniform(F.lit(seed), key, i)))
    count = F.aggregate(F.sequence(F.lit(1), F.col("draws")), F.lit(0), lambda a, i: a + draw(i))
    many = rows.join(tables, F.col(f"doc.`{source_col}`").cast("string").eqNullSafe(F.col("name"))).withColumn("count", count)
    out = many.where("count > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("replica"))
    name = F.concat_ws("|", F.lit(f"{seed}/order"), F.coalesce(key.cast("string"), F.lit("")), F.col("replica").cast("string"))
    return out.withColumn("shuffle_key", F.md5(name))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mixture in its global order: ``replicated`` sorted by shuffle_key."""
    return replicated(docs, **how).orderBy("shuffle_key")


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The mixture with the columns of ``docs``."""
    return mixed(docs, **how).select("doc.*")

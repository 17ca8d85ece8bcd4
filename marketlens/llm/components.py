"""Connected components of a link table, by alternating star contractions.

``large star``: every vertex links its larger neighbours to its smallest one;
``small star``: links its smaller neighbours and itself to the smallest of them.  Both keep
the components, and the links end as one star per component, in a number of
rounds that grows with the logarithm of a component's size.  Aggregates
combine before the shuffle, joins are split by adaptive execution when a vertex has
very many links, and every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written

MAX_ROUNDS = 60     # far above the logarithm of any vertex count; reaching it raises


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: distinct (u, v) with u > v."""
    # large: u's smallest over all neighbours; links only its larger ones.  small: over its smaller ones.
    if large:
        both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        out = links.join(low, F.col("v") == F.col("k")).select(F.col("u"), F.col("m").alias("v"))
    else:
        low = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        out = (links.join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionAll(low.select(F.col("k").alias("u"), F.col("m").alias("v"))))
    return out.where(F.col("u") != F.col("v")).distinct()


def _mark(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b), any comparable type -> (vertex, component): every vertex
    that has a link, with the smallest vertex of its component.  Null ends and
    self-links are no links."""
    cur = written(links.where(F.col("a") != F.col("b"))
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _mark(cur)
    for _ in range(MAX_ROUNDS):
        cur = written(_star(_star(cur, large=True), large=False), "links")
        new = _mark(cur)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return (cur.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
            .unionAll(cur.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()))

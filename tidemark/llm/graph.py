"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import cut

# A node may hold a third of all links; its links are spread over so many parts for the joins.
SALTS = 8


def _with_least(links: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the least v of u.  Links of one u go to several tasks."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(spread, ["u", "salt"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    star = _with_least(both).where("v > u")
    return star.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    star = _with_least(links)
    pairs = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return star.select(F.inline(pairs)).where("u > v").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node with a link; root is the least node of its component.

    Self links and repeated links are harmless, an empty input gives an empty result, links with a null end are
    ignored.  The number of rounds is logarithmic in practice; each round is cut with a checkpoint.
    """
    a, b = F.col(left), F.col(right)
    current = cut(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(current)
    while mark[0]:
        following = cut(_small_star(_large_star(current)))
        after = _mark(following)
        current = following
        if after == mark:
            break
        mark = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

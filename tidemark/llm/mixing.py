"""Mixing sources to target weights by capped water-filling.

Sources share a budget in proportion to their weights, but none may repeat its words more than `max_epochs`
times.  Clamping the sources above their cap and sharing the excess again by weight ends at one level: the largest
`level` with target = min(cap, weight * level) that spends the budget.  Ordered by cap / weight, the clamped sources
are the first ones, so prefix sums find the level without repeated rounds.

Inside a source every document is taken `whole` times, and once more if its seeded position lies at or before the
source's cut.  Positions are MD5 texts; the cut is found from sums by position prefix and one ordering of a
single prefix, so no task ever orders a source.  Of equal rows at the cut, which share a position, as many are
taken as bring the source nearest to its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import WORD, cut, fresh, small_side

# Leading hex digits of a position: 16 ** 3 prefixes for each source.
PREFIX = 3


def words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def position(doc_id: Column, text: Column, seed: int) -> Column:
    """Seeded place of a document in its source.  Rows equal in id and text share it."""
    parts = [F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")),
             F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def targets(totals: DataFrame, weights: Sequence[float], budget: float, max_epochs: float) -> DataFrame:
    """`totals` has (source, source_size); adds weight and target.  One row for each source.

    Sources take the weights in code-point order, null last, repeating.  The budget is a multiple of all sizes and
    is spent whole as long as it is at most `max_epochs`; beyond that every source stops at its cap.
    """
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("weight", F.element_at(
        cycle, (F.pmod(F.row_number().over(listed) - 1, F.lit(len(weights))) + 1).cast("int")
    )).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    leveled = ranked.select(
        "*", F.row_number().over(by_ratio).alias("place"),
        (F.sum("source_size").over(everything) * F.lit(float(budget))
         - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))).alias("sharing"),
    ).withColumn("open", F.col("left") * F.col("weight") / F.col("sharing") < F.col("cap"))
    # the first source that stays below its cap fixes the level for itself and all after it
    level = F.min(F.when(F.col("open"), F.struct("place", "left", "sharing"))).over(everything)
    share = F.col("level.left") * F.col("weight") / F.col("level.sharing")
    return leveled.withColumn("level", level).select(
        "source", "source_size", "weight",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), share)).alias("target"),
    )


def mix_plan(measured: DataFrame, weights: Sequence[float], budget: float, max_epochs: float) -> DataFrame:
    """`measured` has (source, size, position): one row per source with target, whole and the cut position.

    Of the `tied` rows at the cut `some` are taken, as many as bring the source nearest to its target.
    """
    measured = measured.withColumn("prefix", F.substring("position", 1, PREFIX))
    sums = cut(measured.groupBy("source", "prefix").agg(F.sum("size").alias("words")))
    totals = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate).cast("int")
    plan = cut(targets(totals, weights, budget, max_epochs).withColumn("whole", whole).withColumn(
        "need", F.col("target") - F.col("whole") * F.col("source_size")
    ))
    reach = F.sum("words").over(
        Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    )
    same = F.col("p.source").eqNullSafe(F.col("s.source"))
    edge = (
        sums.withColumn("reach", reach).alias("s").join(plan.alias("p"), same)
        .where("reach >= need").groupBy("p.source")
        .agg(F.min(F.struct("prefix", (F.col("reach") - F.col("words")).alias("before"))).alias("edge"))
        .select("source", "edge.prefix", "edge.before")
    )
    edge = small_side(edge)
    inside = (
        measured.alias("m").join(edge.alias("e"), F.col("m.source").eqNullSafe(F.col("e.source"))
                                 & (F.col("m.prefix") == F.col("e.prefix")))
        .groupBy("e.source", "e.before", "m.position").agg(F.sum("size").alias("words"), F.count("*").alias("tied"))
    )
    run = F.sum("words").over(
        Window.partitionBy("source").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    ) + F.col("before")
    each = F.col("words") / F.col("tied")
    reached = inside.withColumn("start", run - F.col("words")).withColumn("each", each).alias("i").join(
        plan.alias("p"), F.col("i.source").eqNullSafe(F.col("p.source"))
    )
    some = F.expr("least(tied, bigint(floor((need - start) / each + 0.5)))").alias("some")
    last = reached.where("start + each / 2 <= need and words > 0").groupBy("p.source").agg(
        F.max(F.struct(F.col("i.position").alias("last"), "tied", some)).alias("at")
    ).select("source", "at.*")
    finished = plan.alias("p").join(edge.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left").join(
        last.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")), "left"
    )
    # nothing inside the edge prefix is taken: the cut lies just before it
    return finished.select(
        "p.source", "source_size", "weight", "target", "whole",
        F.when(F.col("need") > 0, F.coalesce("last", "e.prefix")).otherwise(F.lit("")).alias("cut"), "tied", "some",
    )


def _numbered(measured: DataFrame, plan: DataFrame, place: str, number: str) -> DataFrame:
    """Adds `number`, from 1 on, to the rows at a cut where only some are taken; null for all others.

    Equal rows are interchangeable: they are counted by the partitions they lie in, so none of them orders all.
    """
    partly = plan.where("plan.some < plan.tied").select("plan.source", F.col("plan.cut").alias("cut"))
    if partly.isEmpty():
        return measured.withColumn(number, F.lit(None).cast("long"))
    same = F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col(f"d.{place}") == F.col("t.cut"))
    others = measured.alias("d").join(partly.alias("t"), same, "left_anti")
    part, order, earlier, owner = (fresh(measured, c) for c in ("_part", "_order", "_earlier", "_owner"))
    tied = cut(measured.alias("d").join(partly.alias("t"), same, "left_semi").withColumns(
        {part: F.spark_partition_id(), order: F.monotonically_increasing_id()}
    ))
    sums = tied.groupBy(F.col("source").alias(owner), part).agg(F.count("*").alias(earlier)).withColumn(earlier, F.coalesce(
        F.sum(earlier).over(Window.partitionBy(owner).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ))
    own = F.row_number().over(Window.partitionBy("source", part).orderBy(order))
    counted = tied.withColumn(number, own).alias("d").join(
        sums.alias("s"), F.col("d.source").eqNullSafe(F.col(f"s.{owner}")) & (F.col(f"d.{part}") == F.col(f"s.{part}"))
    ).select(*[F.col(f"d.`{c}`") for c in measured.columns], (F.col(f"d.{number}") + F.col(earlier)).alias(number))
    return others.withColumn(number, F.lit(None).cast("long")).unionByName(counted)


def _with_copies(measured: DataFrame, size: str, place: str, settings: tuple, name: str) -> DataFrame:
    """Add the struct `name`: source_size, target and copies."""
    plan = mix_plan(measured.select("source", F.col(size).alias("size"), F.col(place).alias("position")), *settings)
    plan = small_side(plan.select(F.struct("source", "source_size", "target", "whole", "cut", "tied", "some").alias("plan")))
    number = fresh(measured, "_number")
    dealt = _numbered(measured, plan, place, number)
    before = F.col(f"d.{place}") < F.col("p.plan.cut")
    within = (F.col(f"d.{place}") == F.col("p.plan.cut")) & (F.coalesce(f"d.{number}", F.lit(0)) <= F.col("p.plan.some"))
    extra = F.when((F.col("p.plan.cut") != "") & (before | within), 1).otherwise(0)
    joined = dealt.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.plan.source")))
    return joined.select(*[F.col(f"d.`{c}`") for c in measured.columns], F.struct(
        F.col("p.plan.source_size").alias("source_size"), F.col("p.plan.target").alias("target"),
        (F.col("p.plan.whole") + extra).alias("copies"),
    ).alias(name))


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, max_epochs: float = 2, seed: int = 42,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every document.

    Null text counts as empty, null source is a source of its own, of rows equal in id and text some may be taken
    once more and others not, an empty table stays empty.  Other columns are not read; texts are read once.
    """
    measured = cut(docs.select("doc_id", "source", words(F.col("text")).alias("size"),
                               position(F.col("doc_id"), F.col("text"), seed).alias("position")))
    settings = (weights, budget, max_epochs)
    return _with_copies(measured, "size", "position", settings, "mix").select(
        "doc_id", "source", "size", "mix.source_size", "mix.target", "mix.copies",
        (F.col("mix.copies") * F.col("size")).alias("taken"),
    )


def mixed(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, max_epochs: float = 2, seed: int = 42,
) -> DataFrame:
    """The mix itself: whole rows, whatever their columns, each as often as `mix` takes it."""
    size, place, name, copy = (fresh(docs, c) for c in ("_size", "_position", "_mix", "_copy"))
    measured = docs.withColumns({size: words(F.col("text")), place: position(F.col("doc_id"), F.col("text"), seed)})
    counted = _with_copies(measured, size, place, (weights, budget, max_epochs), name).where(F.col(f"{name}.copies") > 0)
    return counted.withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(f"{name}.copies")))
    ).drop(size, place, name, copy)

"""URL filters: path-template trees.

The paths of each host are cut into segments.  A segment with a digit, or one of very many different ones at its place,
becomes a wildcard, so that the paths fall into templates, the nodes of a tree.  Labelled pages give every
template counts of good and bad.  A branch whose bad rate does not differ significantly from that of its siblings is
merged with them, level by level up to the host.  Templates are rejected by the purity, the smoothed share of good pages,
of the highest merged branch they belong to.  Explicit rules for hosts and path prefixes come first, the longest deciding.

Everything is a DataFrame plan: pages are aggregated to (host, template) before any shuffle of more than counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import cut


@dataclass(frozen=True)
class Filter:
    """branches: more different literal segments than this at one place become a wildcard.
    z: branches with a smaller two-proportion z score than this are merged.
    prior: so many pages with the overall share of good ones are added to each template.
    purity: templates below this share of good pages are rejected."""

    branches: int = 50
    z: float = 1.96
    prior: float = 10.0
    purity: float = 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting (verdict, host, path) rule, ties by the first listed; else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    # longest last, so that it wins
    for verdict, rule_host, prefix in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(prefix))
        chosen = F.when(fits, F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def generalised(path: Column) -> Column:
    """Path segments with those that hold a digit as `*`; a file extension after the last dot is kept."""
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    extension = r"(\.[A-Za-z]{1,5})?$"
    return F.transform(segments, lambda s: F.when(
        s.rlike("[0-9]"), F.concat(F.lit("*"), F.regexp_extract(s, extension, 1))
    ).otherwise(s))


def _widened(counts: DataFrame, branches: int) -> DataFrame:
    """(host, segments, good, bad) with `template`, crowded places being wildcards.

    A place is a host with the generalised segments before it.
    """
    place = F.posexplode("segments").alias("at", "segment")
    steps = counts.select("host", "segments", place).select(
        "host", F.array_join(F.slice("segments", F.lit(1), F.col("at")), "/").alias("before"), "segment"
    ).distinct()
    crowded = steps.groupBy("host", "before").agg(F.count("*").alias("n")).where(F.col("n") > branches).select(
        "host", "before", F.lit(True).alias("crowded")
    )
    placed = counts.select("*", F.posexplode_outer("segments").alias("at", "segment")).withColumn(
        "before", F.when(F.col("at").isNotNull(), F.array_join(F.slice("segments", F.lit(1), F.col("at")), "/"))
    ).join(crowded, ["host", "before"], "left")
    word = F.when(F.col("crowded"), F.lit("*")).otherwise(F.col("segment"))
    rebuilt = placed.groupBy("host", "segments", "good", "bad").agg(
        F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", word.alias("word"))))).alias("w")
    )
    return rebuilt.select("host", "segments", "good", "bad", F.transform("w", lambda x: x["word"]).alias("template"))


def _apart(z: float) -> Column:
    """Whether the bad rate of good, bad differs from that of the rest of all_good, all_bad."""
    n, others = F.col("good") + F.col("bad"), F.col("all_good") + F.col("all_bad") - F.col("good") - F.col("bad")
    pooled = F.try_divide("all_bad", F.col("all_good") + F.col("all_bad"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), others)))
    score = F.try_divide(F.abs(F.try_divide("bad", n) - F.try_divide(F.col("all_bad") - F.col("bad"), others)), spread)
    stays = (n > 0) & (others > 0) & (pooled > 0) & (pooled < 1)
    return F.coalesce(F.when(stays, score >= z), F.lit(False))


def merged_branches(branches: DataFrame, z: float) -> DataFrame:
    """(host, template, good, bad) -> (host, template, branch, b_good, b_bad): the highest merged branch of each template.

    Bottom-up, the nodes below one node are compared.  Those that differ from their siblings stay branches of their own;
    the others become one with what they hold and go on as the node above.  Levels at which no node has siblings change
    nothing and are passed over.
    """
    def above(node: str, level) -> Column:
        return F.slice(node, F.lit(1), level)

    nodes = branches.where(F.size("template") > 0).select(
        "host", "template", F.explode(F.sequence(F.lit(1), F.size("template"))).alias("level")
    ).withColumn("node", above("template", F.col("level")))
    families = nodes.select("host", "level", "node").distinct().groupBy("host", "level", above("node", F.col("level") - 1))
    levels = sorted((r.level for r in families.count().where("count > 1").select("level").distinct().collect()), reverse=True)
    counts = [F.sum(c).alias(c) for c in ("good", "bad")]
    rest, marked = branches.select("host", F.col("template").alias("node"), "good", "bad"), []
    for level in levels:
        at = rest.where(F.size("node") >= level).groupBy("host", above("node", F.lit(level)).alias("node")).agg(*counts)
        at = cut(at.withColumn("parent", above("node", F.lit(level - 1))))
        family = at.groupBy("host", "parent").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
        marked.append(cut(at.join(family, ["host", "parent"]).withColumn("apart", _apart(z))))
        going_on = marked[-1].where("not apart").select("host", F.col("parent").alias("node"), "good", "bad")
        rest = cut(rest.where(F.size("node") < level).unionByName(going_on))
    root = rest.groupBy("host").agg(F.sum("good").alias("r_good"), F.sum("bad").alias("r_bad"))
    named = branches.select("host", "template")
    if not marked:
        empty = F.array().cast("array<string>")
        return named.join(root, "host").select("host", "template", empty.alias("branch"), F.col("r_good").alias("b_good"),
                                               F.col("r_bad").alias("b_bad"))
    own = marked[0].where("apart")
    for more in marked[1:]:
        own = own.unionByName(more.where("apart"))
    # the first branch that stays apart on the way up is the deepest one
    deepest = nodes.join(own.select("host", "node", "good", "bad"), ["host", "node"]).groupBy("host", "template").agg(
        F.max(F.struct("level", "good", "bad")).alias("own")
    )
    inside = F.coalesce(F.col("own.level"), F.lit(0))
    return named.join(deepest, ["host", "template"], "left").join(root, "host", "left").select(
        "host", "template", above("template", inside).alias("branch"),
        F.coalesce("own.good", "r_good").alias("b_good"), F.coalesce("own.bad", "r_bad").alias("b_bad"),
    )


def judged_templates(counts: DataFrame, settings: Filter = Filter()) -> DataFrame:
    """(host, segments, good, bad) -> (host, segments, template, merged, purity, branch, branch_purity, verdict), one row
    per input row.

    `purity` is that of the template, or of its merged siblings with equally many segments; `branch_purity`, which decides,
    is that of the highest merged branch.  Without any label the overall share of good pages counts as 1 and nothing is
    rejected.
    """
    widened = cut(_widened(counts, settings.branches))
    parent = F.slice("template", F.lit(1), F.greatest(F.size("template") - 1, F.lit(0)))
    branches = cut(widened.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).withColumn(
        "parent", F.struct(F.size("template").alias("depth"), parent.alias("above"))
    ))
    family = branches.groupBy("host", "parent").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    marked = branches.join(family, ["host", "parent"]).withColumn("merged", ~_apart(settings.z))
    # the merged siblings of a parent are one branch, counted without those that stay apart
    together = marked.where("merged").groupBy("host", "parent").agg(
        F.sum("good").alias("m_good"), F.sum("bad").alias("m_bad")
    )
    total = branches.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    share = total[0] / (total[0] + total[1]) if total[0] + total[1] else 1.0

    def smoothed(good: Column, bad: Column) -> Column:
        return (good + F.lit(settings.prior * share)) / (good + bad + F.lit(settings.prior))

    good = F.when(F.col("merged"), F.col("m_good")).otherwise(F.col("good"))
    bad = F.when(F.col("merged"), F.col("m_bad")).otherwise(F.col("bad"))
    highest = merged_branches(branches, settings.z)
    judged = smoothed(F.col("b_good"), F.col("b_bad"))
    verdicts = marked.join(together, ["host", "parent"], "left").join(highest, ["host", "template"]).select(
        "host", "template", "merged", smoothed(good, bad).alias("purity"), "branch", judged.alias("branch_purity"),
        F.when(judged < settings.purity, "block").otherwise("allow").alias("verdict"),
    )
    return widened.select("host", "segments", "template").join(verdicts, ["host", "template"]).select(
        "host", "segments", F.array_join("template", "/").alias("template"), "merged", "purity",
        F.array_join("branch", "/").alias("branch"), "branch_purity", "verdict"
    )


def filter_urls(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url",
    settings: Filter = Filter(),
) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, template, purity, branch, branch_purity.

    `labels` has the page's key and `good`, 1 or 0; null labels and labels of other pages are ignored, of repeated
    labels the least counts.  Null urls have an empty host and path and form a template of their own.  Repeated
    pages stay repeated.  Other columns are not read.
    """
    host, path = split_url(F.col(url))
    parsed = pages.select(F.col(key).alias("_key"), host.alias("host"), path.alias("path"))
    segmented = parsed.withColumn("segments", generalised(F.col("path")))
    marks = labels.select(F.col(key).alias("_key"), "good").where("good is not null").groupBy("_key").agg(F.min("good").alias("good"))
    counts = segmented.join(marks, "_key", "left").groupBy("host", "segments").agg(
        F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("good") == 0, 1).otherwise(0)).alias("bad"),
    )
    judged = judged_templates(counts, settings).withColumnRenamed("verdict", "_judged")
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    return segmented.join(judged, ["host", "segments"]).withColumn("_rule", rule).select(
        F.col("_key").alias(key), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_judged").alias("verdict"), "template", "purity", "branch",
        "branch_purity",
    )

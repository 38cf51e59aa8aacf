"""URL filter by a tree of path templates, in DataFrame operations alone.

Per host the paths form a tree. Digits become ``#``; below each node, segments that are
mostly seen once become the wildcard ``*``; labelled branches whose share of blocked pages
doesn't differ from their siblings' (two-proportion z-test) are merged into one branch
``~``. Labels are the pages that a rule judges. A template is rejected when its smoothed
share of blocked pages reaches a threshold, so one without labels never is. Paths are
counted before anything is joined, so the tables of the tree have one row per distinct
path and not per page.

Defined results: a NULL address or one without ``://`` has empty host and path and no rule;
paths of any depth are split to their end, and only where a ``depth`` is given do the levels
below it share one wildcard; repeated rows are judged one by one; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from railcadence.llm.common import staged

Rule = tuple[str, str, str]  # host, path, verdict

DEPTH = 8
MIN_BRANCHES = 8
MAX_VISITS = 4.0
MIN_LABELS = 5
MAX_Z = 1.96
SMOOTHING = 2.0
REJECT_AT = 0.8


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; NULL where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def segments_of(path: Column, depth: int | None = DEPTH) -> Column:
    """Path segments with digits generalised; those deeper than ``depth`` become one wildcard."""
    plain = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#"), "/")
    if depth is None:
        return plain
    return F.when(F.size(plain) > depth, F.concat(F.slice(plain, 1, depth), F.array(F.lit("**")))).otherwise(plain)


def template_tree(
    judged: DataFrame, min_branches: int = MIN_BRANCHES, max_visits: float = MAX_VISITS,
    min_labels: int = MIN_LABELS, max_z: float = MAX_Z, smoothing: float = SMOOTHING,
    reject_at: float = REJECT_AT,
) -> DataFrame:
    """``host``, ``segments``, ``template``, ``n_labelled``, ``n_blocked``, ``rejected``.

    ``judged`` has ``host``, ``segments`` and ``label`` (block, allow or NULL) per page.
    """
    paths = staged(
        judged.groupBy("host", "segments").agg(
            F.count("*").alias("n"), F.count("label").alias("lab"), F.count_if(F.col("label") == "block").alias("blk")
        ).select("*", F.lit("").alias("template"), F.lit(0).alias("at")), "paths",
    )
    node, ended = ["host", "template"], F.size("segments") <= F.col("at")
    rest = F.expr("slice(segments, at + 1, size(segments))")
    done = paths.where(ended)
    # Each round splits the nodes where paths part, down to the end of every path.
    while (here := paths.where(~ended)).take(1):
        here = here.withColumn("segment", F.get("segments", F.col("at")))
        branches = here.groupBy(*node, "segment").agg(
            *[F.sum(c).alias(c) for c in ("n", "lab", "blk")], F.min(rest).alias("low"), F.max(rest).alias("high"),
        )
        nodes = branches.groupBy(*node).agg(
            F.count("*").alias("n_branches"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "lab", "blk")]
        )
        other_lab, other_blk = F.col("all_lab") - F.col("lab"), F.col("all_blk") - F.col("blk")
        pooled = F.col("all_blk") / F.nullif("all_lab", F.lit(0))
        gap = F.abs(F.col("blk") / F.nullif("lab", F.lit(0)) - other_blk / F.nullif(other_lab, F.lit(0)))
        error = F.sqrt(pooled * (1 - pooled) * (1 / F.nullif("lab", F.lit(0)) + 1 / F.nullif(other_lab, F.lit(0))))
        similar = (F.col("lab") >= min_labels) & (other_lab >= min_labels) & (gap <= max_z * error)
        variable = (F.col("n_branches") >= min_branches) & (F.col("all_n") <= max_visits * F.col("n_branches"))
        # All paths of a branch share what its least and its greatest path share; up to there
        # its nodes have one branch each, which nothing can merge.
        differ = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), F.lit(False)).cast("int")
        common = F.when(differ > 0, differ - 1).otherwise(F.size("low"))
        named = branches.join(nodes, node).select(
            *node, "segment", F.when(variable, "*").when(similar, "~").alias("token"), common.alias("common")
        )
        plain = F.col("token").isNull()
        tokens = F.when(plain, F.expr("slice(segments, at + 1, common)")).otherwise(F.array("token"))
        paths = staged(
            here.join(named, [*node, "segment"]).select(
                "host", "segments", "n", "lab", "blk",
                F.concat("template", F.lit("/"), F.array_join(tokens, "/")).alias("template"),
                (F.col("at") + F.size(tokens)).alias("at"),
            ),
            "paths",
        )
        done = done.unionByName(paths.where(ended))
    paths = done
    share = (F.col("n_blocked") + 0.5 * smoothing) / (F.col("n_labelled") + smoothing)
    templates = paths.groupBy(*node).agg(F.sum("lab").alias("n_labelled"), F.sum("blk").alias("n_blocked"))
    return paths.select("host", "segments", "template").join(
        templates.withColumn("rejected", share >= reject_at), node
    )


def judge(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
    depth: int | None = None, **tree: float,
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict`` and the ``template`` that a rejected
    page belongs to. The rule decides; without one, the template does."""
    rows = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    rule, label = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), label.alias("label"), segments_of(F.col("path"), depth).alias("segments"))
    tree_rows = template_tree(rows, **tree)
    rejected = tree_rows.where("rejected").select("host", "segments", F.col("template").alias("rejected_template"))
    return rows.join(rejected, ["host", "segments"], "left").select(
        "id", "host", "path", "rule",
        F.coalesce("label", F.when(F.col("rejected_template").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.col("rejected_template").alias("template"),
    )

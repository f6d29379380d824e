"""URL filters: prefix rules, and path templates per host that are rejected by the labels of their pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ANY = "{*}"
STEPS = 8  # rounds of one segment each before shared stretches are looked for


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else null. A rule is ``host/path``: it fits the host and its
    subdomains if the path begins with the rule's path. Of equally long rules the first in code-point order counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _rest(segments: Column) -> Column:
    """All but the first of an array that is not empty."""
    return F.slice(segments, F.lit(2), F.size(segments) - 1)


def _shape(segment: Column) -> Column:
    """A segment with its runs of digits, and then long runs of letters, as wildcards."""
    return F.regexp_replace(F.regexp_replace(segment, "[0-9]+", "{#}"), "\\p{L}{12,}", "{a}")


def _keep(rows: DataFrame, column: str, min_rows: int) -> DataFrame:
    """The values of ``column`` with enough rows under their node to stand for themselves, whatever their share of it."""
    counts = rows.groupBy("host", "node", column).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("host", "node").agg(F.count(F.lit(1)).alias("children"))
    kept = counts.join(totals, ["host", "node"]).filter((F.col("n") >= min_rows) | (F.col("children") == 1))
    return kept.select("host", "node", column, F.lit(True).alias(f"_{column}"))


def _alike(rows: DataFrame, z: float) -> DataFrame:
    """The branches ``(host, node, token)`` that differ by chance only from what the like branches of their node do.

    Like branches have the same most frequent shape next below. A branch is held against their sum, itself included: by
    a chi-square test of the shapes that come next, at ``df + z * sqrt(2 df)``, and by the difference of the labelled
    bad shares in standard errors. So the work is in proportion to the branches, and no two are paired. A branch without
    like ones stays.
    """
    below = F.coalesce(_shape(F.get("segments", F.lit(1))), F.lit("{end}"))
    cells = rows.groupBy("host", "node", "token", below.alias("below")).agg(F.count(F.lit(1)).alias("n"), F.sum("labelled").alias("seen"), F.sum("bad").alias("bad"))
    # branches are held against those whose most frequent next shape is the same
    leading = cells.groupBy("host", "node", "token").agg(F.max_by("below", F.struct("n", "below")).alias("kind"))
    cells = cut_lineage(cells.join(leading, ["host", "node", "token"]))
    group = ["host", "node", "kind"]
    branches = cells.groupBy(*group, "token").agg(F.sum("n").alias("branch_n"), F.sum("seen").alias("branch_seen"), F.sum("bad").alias("branch_bad"))
    pooled = cells.groupBy(*group, "below").agg(F.sum("n").alias("pool"))
    nodes = branches.groupBy(*group).agg(
        F.sum("branch_n").alias("node_n"), F.sum("branch_seen").alias("node_seen"), F.sum("branch_bad").alias("node_bad"), F.count(F.lit(1)).alias("branches")
    )
    kinds = pooled.groupBy(*group).agg(F.count(F.lit(1)).alias("kinds"))
    # sum over shapes of (n - e)^2 / e, with e = branch * pool / node, is node / branch * sum(n^2 / pool) - branch
    parts = cells.join(pooled, [*group, "below"]).groupBy(*group, "token").agg(F.sum(F.col("n") * F.col("n") / F.col("pool")).alias("squares"))
    tested = branches.join(parts, [*group, "token"]).join(nodes, group).join(kinds, group)
    chi = F.col("squares") * F.col("node_n") / F.col("branch_n") - F.col("branch_n")
    free = F.col("kinds") - 1
    share = F.col("node_bad") / F.greatest(F.lit(1), F.col("node_seen"))
    error = F.sqrt(share * (1 - share) / F.greatest(F.lit(1), F.col("branch_seen")))
    off = F.abs(F.col("branch_bad") / F.greatest(F.lit(1), F.col("branch_seen")) - share)
    same = (chi <= free + z * F.sqrt(2.0 * free)) & ((F.col("branch_seen") == 0) | (off <= z * error))
    return tested.filter((F.col("branches") > 1) & same).select("host", "node", "token", F.lit(True).alias("_alike"))


def _skip_shared(rows: DataFrame) -> DataFrame:
    """``rows`` moved past the segments that all open rows of their node share, as rounds would do one by one.

    A segment without siblings stays as it is. What the smallest and the largest path begin with, all in between do.
    """
    ends = rows.groupBy("host", "node").agg(F.min("segments").alias("low"), F.max("segments").alias("high"))
    parted = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), False).cast("int")
    shared = ends.select("host", "node", F.when(parted == 0, F.size("low")).otherwise(parted - 1).alias("n")).filter("n > 0")
    joined = cut_lineage(rows.join(shared, ["host", "node"], "left"))
    path = F.concat("node", F.lit("/"), F.array_join(F.slice("segments", F.lit(1), F.col("n")), "/"))
    rest = F.slice("segments", F.col("n") + 1, F.greatest(F.lit(0), F.size("segments") - F.col("n")))
    moved = {"node": F.when(F.col("n") > 0, path).otherwise(F.col("node")), "segments": F.when(F.col("n") > 0, rest).otherwise(F.col("segments"))}
    return joined.withColumns(moved).select(*rows.columns)


def path_templates(pages: DataFrame, labels: DataFrame, key: str, url: str, min_rows: int = 5, z: float = 3.0) -> DataFrame:
    """All rows of ``pages`` as ``key, host, path, labelled, bad, template``.

    The tree of a host grows by one path segment a round, down to the deepest path. A segment that holds fewer than
    ``min_rows`` rows of its node is variable and becomes its shape (``{#}`` for digits, ``{a}`` for long words), and a
    shape that is rare too becomes ``{*}``. Then branches of a node that are statistically alike become one. After
    ``STEPS`` rounds, stretches without a branching are passed at once, so rounds grow with the branchings on a path.
    ``labels`` has ``key`` and ``bad`` (0 or 1; a page is bad if any of its labels is).
    """
    known = labels.filter(F.col(key).isNotNull() & F.col("bad").isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max("bad").cast("bigint").alias("bad"))
    rows = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.join(known, rows["key"] == known["_key"], "left").drop("_key")
    rows = rows.withColumns(
        {
            "labelled": F.col("bad").isNotNull().cast("bigint"),
            "bad": F.coalesce("bad", F.lit(0).cast("bigint")),
            "segments": F.when(F.length("path") > 0, _rest(F.split("path", "/"))).otherwise(F.array().cast("array<string>")),
            "node": F.lit(""),
        }
    )
    rows, done, rounds = cut_lineage(rows), [], 0
    while True:
        done.append(rows.filter(F.size("segments") == 0))
        open_ = rows.filter(F.size("segments") > 0)
        if open_.limit(1).count() == 0:
            break
        rounds += 1
        if rounds > STEPS:
            moved = cut_lineage(_skip_shared(open_))
            done.append(moved.filter(F.size("segments") == 0))
            open_ = moved.filter(F.size("segments") > 0)
        open_ = open_.withColumn("segment", F.get("segments", F.lit(0)))
        open_ = open_.join(_keep(open_, "segment", min_rows), ["host", "node", "segment"], "left")
        open_ = cut_lineage(open_.withColumn("shape", F.when(F.col("_segment"), F.col("segment")).otherwise(_shape(F.col("segment")))))
        open_ = open_.join(_keep(open_, "shape", min_rows), ["host", "node", "shape"], "left")
        open_ = cut_lineage(open_.withColumn("token", F.when(F.col("_shape"), F.col("shape")).otherwise(F.lit(ANY))))
        open_ = open_.join(_alike(open_, z), ["host", "node", "token"], "left")
        token = F.when(F.col("_alike"), F.lit(ANY)).otherwise(F.col("token"))
        open_ = open_.withColumns({"node": F.concat("node", F.lit("/"), token), "segments": _rest(F.col("segments"))})
        rows = cut_lineage(open_.select(*rows.columns))
    rows = reduce(DataFrame.unionByName, done)
    return rows.select("key", "host", "path", "labelled", "bad", F.col("node").alias("template"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    key: str = "page_id",
    url: str = "url",
    weight: float = 10.0,
    reject: float = 0.5,
    **tree,
) -> DataFrame:
    """One row per page: ``key, host, path, rule, verdict, template, bad_share``.

    The verdict is that of the longest rule that fits, else that of the page's template: blocked if its smoothed bad
    share is ``reject`` or more. The share is drawn by ``weight`` pseudo-labels towards that of the host, and the
    host's towards that of all pages, so a template without labels follows its host; a host without any has no share and
    is allowed. Null urls and urls without ``://`` have empty host and path and share one template. Rows with a repeated
    key are judged each by itself. An empty table gives no rows.
    """
    rows = path_templates(pages, labels, key, url, **tree)
    seen, bad = rows.agg(F.sum("labelled"), F.sum("bad")).first()
    overall = (bad or 0) / seen if seen else 0.0
    counts = cut_lineage(rows.groupBy("host", "template").agg(F.sum("labelled").alias("seen"), F.sum("bad").alias("bad")))
    hosts = counts.groupBy("host").agg(((F.sum("bad") + weight * overall) / (F.sum("seen") + weight)).alias("prior"), F.sum("seen").alias("host_seen"))
    smoothed = (F.col("bad") + weight * F.col("prior")) / (F.col("seen") + weight)
    shares = counts.join(hosts, "host").select("host", "template", F.when(F.col("host_seen") > 0, smoothed).alias("bad_share"))
    rule, says = matched_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_share") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(cut_lineage(shares), ["host", "template"]).select(
        F.col("key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"), "template", "bad_share"
    )

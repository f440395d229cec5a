"""URL filter by rules and a tree of path templates.

Every host has a tree of path segments, as deep as its paths. From the root down, segments
that vary (numbers, long or mixed strings, and all children of a node with many children)
become wildcards. From the leaves up, sibling branches whose labels look alike statistically
are merged. A template is rejected if the smoothed share of labelled urls that are blocked is
high. The labels are the urls that a rule decides; a template without any takes the estimate
of its parent.

The tree is worked on as counts, one row per path that differs, level by level; what lies
below a node with a single path is one leaf, so there are as many rounds as paths have
segments in common.

Defined results: a null url or one without ``://`` has an empty host and path, fits no
rule and belongs to the tree of the empty host. Slashes at either end of a path make no
segment. Repeated rows are judged alike; of ties in a merge none arises, as every branch is
compared with all of its siblings together. Empty tables give no rows; paths of any length
are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.grouping import stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_VARIABLE = r"[0-9]|^.{25,}$|[%=&;,:~+]"
_KEYS = ["url_host", "segments"]


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule ('host/path') that fits, as struct (rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        at, _, below = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def path_segments(path: Column) -> Column:
    """The segments of a path, '*' for those that vary by their form."""
    inner = F.regexp_replace(path, "^/+|/+$", "")
    parts = F.transform(
        F.split(inner, "/"), lambda s: F.when(s.rlike(_VARIABLE), F.lit("*")).otherwise(s)
    )
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(parts)


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    most_children: int = 50,
    smoothing: float = 4.0,
    reject_at: float = 0.8,
    alike_at: float = 1.96,
) -> DataFrame:
    """Pages with `url_host`, `url_path`, `url_rule`, `url_template`, `url_verdict`.

    rules: (allow or block, 'host/path'). Urls are counted per path with a map-side combine,
    and all levels work on these counts, which are then joined back by host and segments.
    """
    url = F.col("url")
    named = pages.drop("url_host", "url_path", "url_rule", "url_template", "url_verdict", "hit")
    seen = named.withColumn("url_host", url_host(url)).withColumn("url_path", url_path(url))
    path = F.col("url_path")
    seen = seen.withColumn("hit", matching_rule(F.col("url_host"), path, rules))
    seen = seen.withColumn("url_segments", path_segments(path))
    leaves = seen.select(
        "url_host", F.col("url_segments").alias("segments"), F.col("hit.verdict").alias("given")
    )
    verdicts = template_verdicts(leaves, most_children, smoothing, reject_at, alike_at)
    told = verdicts.select(*(F.col(k).alias(f"t_{k}") for k in _KEYS), "url_template", "rejected")
    same = (F.col("url_host") == F.col("t_url_host")) & (F.col("url_segments") == F.col("t_segments"))
    by_method = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    joined = seen.join(told, same, "left")
    return joined.select(
        *named.columns,
        "url_host",
        "url_path",
        F.col("hit.rule").alias("url_rule"),
        "url_template",
        F.coalesce(F.col("hit.verdict"), by_method).alias("url_verdict"),
    )


def template_verdicts(
    leaves: DataFrame,
    most_children: int,
    smoothing: float,
    reject_at: float,
    alike_at: float,
) -> DataFrame:
    """For each (host, segments) that occurs: its template and whether it is rejected.

    leaves: one row per url with the segments and the label `given` (allow, block, null).
    """
    bad = F.coalesce(F.sum((F.col("given") == "block").cast("long")), F.lit(0))
    tree = leaves.groupBy(*_KEYS).agg(bad.alias("bad"), F.count("given").alias("known"))
    tree = stored(_with_wildcards(stored(tree, "leaves"), most_children), "tree")
    counts = tree.groupBy("url_host", F.col("branch").alias("own")).agg(
        F.sum("bad").alias("bad"), F.sum("known").alias("known")
    )
    merged = _merged(stored(counts.withColumn("branch", F.col("own")), "branches"), alike_at)
    judged = _shares(merged, smoothing)
    template = F.concat(F.lit("/"), F.array_join("branch", "/"))
    told = merged.join(judged, ["url_host", "branch"]).select(
        "url_host",
        "own",
        template.alias("url_template"),
        (F.col("judged") & (F.col("share") >= reject_at)).alias("rejected"),
    )
    return tree.select(*_KEYS, F.col("branch").alias("own")).join(told, ["url_host", "own"]).drop("own")


def _with_wildcards(tree: DataFrame, most_children: int) -> DataFrame:
    """Adds `branch`: the segments with wildcards for the children of nodes that have many.

    A round takes one level. A path that is alone below its node is done: its further
    segments are the branch's last one, joined.
    """
    empty = F.array().cast("array<string>")
    done = None
    going = tree.withColumn("branch", empty)
    level = 0
    while True:
        segment = F.get("segments", F.lit(level))
        nodes = going.groupBy("url_host", "branch").agg(
            F.count("*").alias("paths"), F.count_distinct(segment).alias("children")
        )
        met = stored(going.join(nodes, ["url_host", "branch"]), "level")
        rest = F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(1)))
        ends = (F.col("paths") == 1) | (F.size("segments") <= level)
        last = F.when(F.size("segments") > level, F.array(F.array_join(rest, "/"))).otherwise(empty)
        own = tree.columns
        ended = met.filter(ends).select(*own, F.concat("branch", last).alias("branch"))
        done = ended if done is None else done.union(ended)
        named = F.when(F.col("children") > most_children, F.lit("*")).otherwise(segment)
        going = met.filter(~ends).select(*own, F.concat("branch", F.array(named)).alias("branch"))
        if going.isEmpty():
            return done
        level += 1


def _prefix(length: int) -> Column:
    return F.slice("branch", 1, length) if length else F.array().cast("array<string>")


def _depth(branches: DataFrame) -> int:
    return branches.agg(F.max(F.size("branch"))).first()[0] or 0


def _merged(branches: DataFrame, alike_at: float) -> DataFrame:
    """`branch` with wildcards where labels do not tell siblings apart, from the leaves up.

    A node is compared with all of its parent's other urls by a z test of two proportions. If
    either side has no labels they are not apart. What is merged at one level is one node for
    the levels above.
    """
    for level in range(_depth(branches), 0, -1):
        sums = [F.sum("bad").alias("bad"), F.sum("known").alias("known")]
        reach = branches.filter(F.size("branch") >= level)
        nodes = reach.groupBy("url_host", _prefix(level).alias("node")).agg(*sums)
        above = branches.filter(F.size("branch") >= level - 1)
        parents = above.groupBy("url_host", _prefix(level - 1).alias("parent")).agg(
            F.sum("bad").alias("all_bad"), F.sum("known").alias("all_known")
        )
        nodes = nodes.withColumn("parent", F.slice("node", 1, level - 1) if level > 1 else _prefix(0))
        known, rest = F.col("known"), F.col("all_known") - F.col("known")
        own_share = F.try_divide("bad", "known")
        rest_share = F.try_divide(F.col("all_bad") - F.col("bad"), rest)
        pooled = F.try_divide("all_bad", "all_known")
        spread = F.sqrt(
            pooled * (1 - pooled) * (F.try_divide(F.lit(1), known) + F.try_divide(F.lit(1), rest))
        )
        apart = F.coalesce(F.abs(own_share - rest_share) > alike_at * spread, F.lit(False))
        found = nodes.join(parents, ["url_host", "parent"]).filter(~apart)
        alike = found.select("url_host", "node", F.lit(True).alias("alike"))
        step = branches.withColumn("node", _prefix(level)).join(alike, ["url_host", "node"], "left")
        tail = F.slice("branch", level + 1, F.greatest(F.size("branch") - level, F.lit(1)))
        wild = F.concat(_prefix(level - 1), F.array(F.lit("*")), tail)
        here = (F.size("branch") >= level) & F.col("alike")
        step = step.withColumn("branch", F.when(here, wild).otherwise(F.col("branch")))
        branches = stored(step.drop("node", "alike"), "branches")
    return branches


def _shares(branches: DataFrame, smoothing: float) -> DataFrame:
    """url_host, branch, share of blocked urls, and judged, whether its host has any label.

    A node's share is smoothed towards its parent's, from the root down.
    """
    counts = branches.groupBy("url_host", "branch").agg(
        F.sum("bad").alias("bad"), F.sum("known").alias("known")
    )
    counts = stored(counts, "templates")
    done, above = None, None
    for level in range(_depth(counts) + 1):
        reach = counts.filter(F.size("branch") >= level)
        nodes = reach.groupBy("url_host", _prefix(level).alias("node")).agg(
            F.sum("bad").alias("bad"), F.sum("known").alias("known")
        )
        if above is None:
            nodes = nodes.withColumns({"before": F.lit(0.5), "judged": F.col("known") > 0})
        else:
            parent = F.slice("node", 1, level - 1) if level > 1 else _prefix(0)
            nodes = nodes.withColumn("parent", parent).join(
                above.select(
                    "url_host", F.col("node").alias("parent"), F.col("share").alias("before"), "judged"
                ),
                ["url_host", "parent"],
            )
        share = (F.col("bad") + smoothing * F.col("before")) / (F.col("known") + smoothing)
        above = stored(nodes.select("url_host", "node", share.alias("share"), "judged"), "shares")
        done = above if done is None else done.union(above)
    return counts.select("url_host", "branch").join(
        done.withColumnRenamed("node", "branch"), ["url_host", "branch"]
    )

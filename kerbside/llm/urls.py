"""URL filter by a tree of path templates for each host, in DataFrame expressions only.

Rules judge some URLs: each is a host and the beginning of a path; it fits its host and all subdomains, and of those
that fit a URL the longest counts (of equally long ones the greatest text). What they say labels the URLs that they fit,
and from these labels the tree judges the others.

A path is its non-empty segments; from DEPTH on they are one segment. Below a node, which is a host and a template,
a segment stands for itself if it holds at least one in MANY of the node's pages and LEAST of them; there are
at most MANY of those. All others are the wildcard `*`. Branches (the wildcard too) with LEAST labelled pages whose
blocked shares do not differ by Hoeffding's bound (at ALPHA) from that of the branch before, in order of the share, are
merged: `{de|fr}`. A merged branch's estimate is its blocked share, smoothed by WEIGHT pages at the estimate of the
node above; a host's is smoothed by the share over all hosts. The estimate of a page's own template decides: the
template is rejected from PURITY on. So without labels below it, a branch is judged like its parent, and hosts without
any labels like all hosts.

Each level takes two aggregates over the pages that are that deep, and a join back. A node with one page in HEAVY or more
meets its pages by broadcast, of which there are at most HEAVY; pages of other nodes are joined by host and template.
Lists are of at most MANY + 1 branches. The driver holds two counts and the greatest depth.

A null URL, or one without `://`, has an empty host and path and is judged like any host. Repeated rows and page_ids are
pages of their own; other columns do not count. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import meet, store

DEPTH, MANY, LEAST, WEIGHT, PURITY, ALPHA = 8, 32, 3, 4, 0.8, 0.05
BOUND = math.sqrt(0.5 * math.log(2 / ALPHA))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIT = "struct<size:int, rule:string, verdict:string>"
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
NODE = ["host", "template"]


def host_and_path(pages: DataFrame) -> DataFrame:
    """(page_id, host, path)."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    found = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    found = found.withColumn("host", F.regexp_extract("rest", "^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(rest, length(host) + 1)"), "^[^?#]*", 0)
    return found.select("page_id", F.translate("host", UPPER, LOWER).alias("host"), path.alias("path"))


def judged(rules: tuple[tuple[str, str], ...]) -> Column:
    """The rule that counts for a host and path, as (size, rule, verdict), or null. Every rule is tried on every URL."""
    fitting = []
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(slash + path)
        fitting.append(F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"),
                                             F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fitting).cast(f"array<{FIT}>"))


def segments() -> Column:
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    rest = F.array_join(F.slice(parts, DEPTH, F.greatest(F.size(parts), F.lit(1))), "/")
    return F.when(F.size(parts) > DEPTH, F.concat(F.slice(parts, 1, DEPTH - 1), F.array(rest))).otherwise(parts)


def smoothed(blocked: Column, labelled: Column, above: Column) -> Column:
    return (blocked + WEIGHT * above) / (labelled + WEIGHT)


def branches(kids: DataFrame, total: int) -> DataFrame:
    """For each node the list of its branches (segment, null for the wildcard; name; estimate), and its pages `n`.

    `kids` counts the pages of each (host, template, estimate, segment).
    """
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    nodes = kids.groupBy(*NODE).agg(F.sum("n").alias("pages"), F.count("*").alias("kinds"))
    literal = (F.col("n") * MANY >= F.col("pages")) & (F.col("n") >= LEAST)
    found = (meet(kids, nodes, NODE, "kinds", total).withColumn("segment", F.when(literal, F.col("segment")))
             .groupBy(*NODE, "estimate", "segment").agg(*sums)
             .withColumns({"compared": F.col("labelled") >= LEAST,
                           "share": F.col("blocked") / F.greatest("labelled", F.lit(1))}))
    by_share = Window.partitionBy(*NODE, "compared").orderBy("share", "segment")
    last_share, last_labelled = F.lag("share").over(by_share), F.lag("labelled").over(by_share)
    alike = F.col("compared") & (F.col("share") - last_share
                                 < BOUND * (1 / F.sqrt("labelled") + 1 / F.sqrt(last_labelled)))
    found = found.withColumn("breaks", F.when(alike, 0).otherwise(1))
    found = found.withColumn("group", F.sum("breaks").over(by_share.rowsBetween(Window.unboundedPreceding, 0)))
    merged = Window.partitionBy(*NODE, "compared", "group")
    # Marks of templates inside a segment are escaped.
    name = F.coalesce(F.regexp_replace("segment", r"[*{|}\\]", r"\\$0"), F.lit("*"))
    names = F.array_sort(F.collect_list(name).over(merged))
    joined = F.when(F.size("names") == 1, F.col("names")[0]).otherwise(
        F.concat(F.lit("{"), F.array_join("names", "|"), F.lit("}")))
    found = found.select("*", names.alias("names"), smoothed(
        F.sum("blocked").over(merged), F.sum("labelled").over(merged), F.col("estimate")).alias("own"))
    branch = F.struct("segment", joined.alias("name"), F.col("own").alias("estimate"))
    return found.groupBy(*NODE).agg(F.collect_list(branch).alias("branches"), F.sum("n").alias("n"))


def grow(pages: DataFrame) -> DataFrame:
    """Pages (with host, path and their rule's verdict) with the template of their path and its estimate."""
    blocked = F.when(F.col("label").isNotNull(), (F.col("label") == "block").cast("int"))
    counts = [F.count("*").alias("n"), F.count("blocked").alias("labelled"),
              F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked")]
    pages = pages.withColumn("blocked", blocked)
    total, deepest, labelled, all_blocked = pages.agg(
        F.count("*"), F.max(F.size(segments())), F.count("blocked"), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    overall = F.lit((all_blocked + 1) / (labelled + 2))
    hosts = pages.groupBy("host").agg(*counts).select(
        "host", F.lit("").alias("template"), smoothed(F.col("blocked"), F.col("labelled"), overall).alias("estimate"), "n")
    rows = store(meet(pages, hosts, ["host"], "n", total).drop("n"), "urls-hosts")
    for depth in range(deepest or 0):
        deep = F.size(segments()) > depth
        here = rows.filter(deep).withColumn("segment", segments()[depth])
        kids = here.groupBy(*NODE, "estimate", "segment").agg(*counts)
        found = meet(here.drop("estimate"), branches(kids, total), NODE, "n", total)
        own = F.filter("branches", lambda b: b["segment"].eqNullSafe(F.col("segment")))
        branch = F.coalesce(F.get(own, F.lit(0)), F.get(F.filter("branches", lambda b: b["segment"].isNull()), F.lit(0)))
        found = (found.withColumn("branch", branch)
                 .withColumns({"template": F.concat("template", F.lit("/"), "branch.name"),
                               "estimate": F.col("branch.estimate")}))
        rows = store(rows.filter(~deep).unionByName(found.select(*rows.columns)), f"urls-{depth}")
    return rows


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, score) of every page."""
    found = host_and_path(pages).withColumn("fit", judged(rules))
    found = store(found.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                               F.col("fit.verdict").alias("label")), "urls-ruled")
    own = F.when(F.col("estimate") >= PURITY, "block").otherwise("allow")
    return grow(found).select("page_id", "host", "path", "rule", F.coalesce("label", own).alias("verdict"),
                              "template", F.col("estimate").alias("score"))

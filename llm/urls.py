"""URL verdicts from host and path rules and from a tree of path templates.

A rule decides where it fits. The rest is judged by templates learned from the urls that rules
decide: in each host, path segments become branches of a tree; segments with digits, and all
children of a node that has many and mostly rare ones, become wildcards. A branch that two-sample
tests do not tell from its siblings taken together, neither by the share of labelled urls nor by
that of blocked ones among these, is merged into the wildcard too. A template is rejected where the
smoothed share of blocked urls among its labelled ones is high, and most of its urls are labelled.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.session import written


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or a url without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def match(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict) of nulls where none does."""
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        found = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits & path.startswith(rule.path), found).otherwise(out)
    return out


def _differ(hits: Column, n: Column, all_hits: Column, all_n: Column, z: float) -> Column:
    """Whether a branch's share of hits differs from that of its siblings: a test of two samples
    with their pooled share. Where one of the samples is empty, nothing tells them apart."""
    rest_hits, rest = all_hits - hits, all_n - n
    pooled = F.try_divide(all_hits, all_n)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), rest)))
    apart = F.abs(F.try_divide(hits, n) - F.try_divide(rest_hits, rest)) > z * spread
    return F.coalesce(apart, F.lit(False))


def _shared(low: Column, high: Column) -> Column:
    """How many segments all paths of a node have in common: those of its least and its largest."""
    differs = F.zip_with(low, high, lambda a, b: ~a.eqNullSafe(b))
    first = F.array_position(differs, True)
    return F.when(first == 0, F.size(low)).otherwise(first - 1).cast("int")


def _joined(template: Column, segments: Column) -> Column:
    return F.when(
        F.size(segments) > 0, F.concat(template, F.lit("/"), F.array_join(segments, "/"))
    ).otherwise(template)


def templates(
    paths: DataFrame,
    many: int = 8,
    rare: float = 0.5,
    z: float = 1.96,
) -> DataFrame:
    """(host, path, template) from (host, path, n, n_labelled, n_bad), one row for each path.

    A node's children all become wildcards if there are at least ``many``, and ``rare`` times as
    many as urls. What all paths of a node have in common is passed over in one step, and paths that
    are used up take no further part. So rounds, of one aggregation over nodes and one over branches,
    are as many as there are branchings one below the other, however long a path is. Runs the rounds
    when called; each is written.
    """
    sums = ["n", "n_labelled", "n_bad"]
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    parts = F.transform(parts, lambda x: F.when(x.rlike("[0-9]"), F.lit("*")).otherwise(x))
    tree = paths.select(*paths.columns, parts.alias("rest"), F.lit("").alias("template"))
    done, level, node = [], 0, ["host", "template"]
    while True:
        done.append(tree.where(F.size("rest") == 0).select(*paths.columns, "template"))
        tree = tree.where(F.size("rest") > 0)
        if tree.isEmpty():
            break
        ends = tree.groupBy(*node).agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
        ends = ends.select(*node, _shared(F.col("low"), F.col("high")).alias("shared"))
        tree = tree.join(ends, node).select(
            *paths.columns,
            F.slice("rest", F.col("shared") + 1, F.size("rest")).alias("rest"),
            _joined(F.col("template"), F.slice("rest", 1, F.col("shared"))).alias("template"),
            F.get("rest", F.col("shared")).alias("segment"),
        )
        tree = written(tree, f"url-nodes-{level}")
        branch = tree.where("segment is not null").groupBy(*node, "segment").agg(
            *[F.sum(c).alias(c) for c in sums]
        )
        of_node = branch.groupBy(*node).agg(
            F.count("*").alias("children"), *[F.sum(c).alias(f"all_{c}") for c in sums]
        )
        variable = (F.col("children") >= many) & (F.col("children") >= rare * F.col("all_n"))
        c = F.col
        apart = _differ(c("n_labelled"), c("n"), c("all_n_labelled"), c("all_n"), z) | _differ(
            c("n_bad"), c("n_labelled"), c("all_n_bad"), c("all_n_labelled"), z
        )
        wild = variable | (~apart & (F.col("children") > 1))
        named = branch.join(of_node, node).select(
            *node, "segment", F.when(wild, "*").otherwise(F.col("segment")).alias("name")
        )
        tree = tree.join(named, [*node, "segment"], "left").select(
            *paths.columns, F.slice("rest", 2, F.size("rest")).alias("rest"),
            F.concat("template", F.coalesce(F.concat(F.lit("/"), "name"), F.lit(""))).alias("template"),
        )
        tree = written(tree, f"url-tree-{level}")
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def purity(tree: DataFrame, prior: float = 0.5, weight: float = 2.0) -> DataFrame:
    """(host, template, n, n_labelled, n_bad, purity): the smoothed share of blocked labelled urls."""
    sums = [F.sum(c).alias(c) for c in ("n", "n_labelled", "n_bad")]
    smoothed = (F.col("n_bad") + prior * weight) / (F.col("n_labelled") + weight)
    return tree.groupBy("host", "template").agg(*sums).withColumn("purity", smoothed)


def judge(
    pages: DataFrame, rules=RULES, threshold: float = 0.9, labelled: float = 0.5
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template) for each row of ``pages``.

    A url that no rule fits is blocked if its template's purity reaches ``threshold`` and at least
    ``labelled`` of its urls are decided by rules, else allowed. Null and malformed urls have an
    empty host and path and are allowed. Repeated rows each get the same verdict; other columns of
    ``pages`` are ignored; an empty table gives no rows.
    """
    host, path = parse(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    found = match(F.col("host"), F.col("path"), rules)
    urls = written(urls.select("*", found.alias("m")).select("page_id", "host", "path", "m.*"), "urls")
    paths = urls.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("verdict").alias("n_labelled"),
        F.count_if(F.col("verdict") == "block").alias("n_bad"),
    )
    tree = templates(paths)
    bad = (F.col("purity") >= threshold) & (F.col("n_labelled") >= labelled * F.col("n"))
    verdicts = purity(tree).select(
        "host", "template", F.when(bad, "block").otherwise("allow").alias("learned")
    )
    by_path = tree.select("host", "path", "template").join(verdicts, ["host", "template"])
    return urls.join(by_path, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "learned").alias("verdict"),
        "template",
    )

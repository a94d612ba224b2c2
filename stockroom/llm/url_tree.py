"""Operator 13: URL filters by explicit rules and by a tree of path templates for each host.

``judge`` gives every URL the verdict of the longest rule that fits it; URLs without one get the verdict of their
path template. The URLs that rules speak for are the labelled ones (``allow`` or ``block``), beside any that the
caller labels.

The tree of a host is grown level by level, one path segment at a time:

1. A segment becomes a token by its form: runs of digits are ``#`` and long hexadecimal numbers ``#x``, so
   ``148.html`` is ``#.html``. Paths are counted per host and token sequence before anything else, so a host with a
   third of all URLs is as many rows as it has kinds of paths.
2. Below a node, tokens with fewer than ``LEAST`` URLs or less than ``SHARE`` of the node's URLs are variable too:
   together they are the wildcard ``*``. At most ``1 / SHARE`` branches and the wildcard are left at a node.
3. Statistically similar branches of a node are merged: neither the share of blocked among labelled URLs nor the
   shares of URLs that end there or go on in a number, a mixed token, a word or a directory differ by more than Hoeffding's
   bound at ``ALPHA``. Branches join, largest first, the first similar group (``en|fr``); what joins the wildcard is ``*``.
4. A branch's *purity* is its share of allowed among labelled URLs, smoothed towards its parent's:
   ``(allowed + WEIGHT * parent) / (labelled + WEIGHT)``, from the share over all hosts (with one of either added) down.

A URL without a rule is blocked if the purity of its template is below ``PURITY``.

Scale: counts are summed in the map tasks; a node's branches are one group of bounded size; joins of rows with their
node have two written sides, which Spark's skew join splits at a hot node. Levels are a driver loop of at most
``DEPTH`` rounds; what lies deeper is one token together, so whole paths count.

Defined results: a null URL or one without ``://`` has an empty host and path
and the verdict of the empty host's tree; a path is empty where nothing but ``?``, ``#`` or the end follows the host, and then fits
no rule, as a rule's path starts with ``/``. Of fitting rules of equal length, a block wins, then the first in
alphabetical order. Repeated rows are counted and returned as often as they stand there; without any label all
purities are 1/2 and no URL is blocked. ``*``, ``(``, ``)`` and ``|`` in a segment count as ``~``. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import lower_az, save

LEAST, SHARE = 20, 0.02
ALPHA = 0.05
WEIGHT = 10.0
PURITY = 0.5
DEPTH = 8

#: How a token goes on: the kinds whose shares are compared.
KINDS = ("end", "directory", "number", "mixed", "word")


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no ``://``."""
    rest = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url))).otherwise("")
    return lower_az(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The name and the verdict of the longest fitting rule, null without one. For short lists of rules."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    order = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    for rule in reversed(order):
        fits = rule.fits(host, path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def tokens(path: Column) -> Column:
    """The path's segments by their form, at most ``DEPTH``; an empty path has none."""

    def form(segment: Column) -> Column:
        plain = F.translate(segment, "*(|)", "~~~~")
        return F.regexp_replace(F.regexp_replace(plain, r"^(?=[^.]*[0-9])(?=[^.]*[A-Fa-f])[0-9A-Fa-f-]{9,}(?=\.|$)", "#x"), "[0-9]+", "#")

    found = F.transform(F.split(F.substring(path, 2, 2**30), "/", -1), form)
    deep = F.concat(F.slice(found, 1, DEPTH - 1), F.array(F.array_join(F.slice(found, DEPTH, 2**30), "/")))
    return F.when(path == "", F.array().cast("array<string>")).when(F.size(found) > DEPTH, deep).otherwise(found)


def _kind(at: int) -> Column:
    """The kind of the token at ``at``, counted from 0, of ``tokens``."""
    token = F.get("tokens", F.lit(at))
    return (
        F.when(token.isNull(), "end").when(token == "", "directory").when(token.isin("#", "#x"), "number").when(token.contains("#"), "mixed").otherwise("word")
    )


def _close(a: int, n: int, b: int, m: int, alpha: float) -> bool:
    """Whether a of n and b of m may have one probability, by Hoeffding's bound."""
    if not n or not m:
        return True
    return abs(a / n - b / m) <= math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def merge(branches: list[dict], parent: float, alpha: float = ALPHA, weight: float = WEIGHT) -> list[dict]:
    """The groups of similar branches of one node: ``name``, ``tokens``, ``n`` and ``purity`` of each.

    A branch has ``token``, ``n``, ``allowed``, ``blocked`` and the counts of ``KINDS``."""
    counts = ("n", "allowed", "blocked", *KINDS)
    groups: list[dict] = []
    for branch in sorted(branches, key=lambda b: (-b["n"], b["token"])):
        for group in groups:
            same = _close(branch["blocked"], branch["allowed"] + branch["blocked"], group["blocked"], group["allowed"] + group["blocked"], alpha)
            if same and all(_close(branch[k], branch["n"], group[k], group["n"], alpha) for k in KINDS):
                group["tokens"].append(branch["token"])
                for c in counts:
                    group[c] += branch[c]
                break
        else:
            groups.append({"tokens": [branch["token"]]} | {c: branch[c] for c in counts})
    for group in groups:
        members = sorted(group["tokens"])
        group["name"] = "*" if "*" in members else members[0] if len(members) == 1 else f"({'|'.join(members)})"
        group["purity"] = (group["allowed"] + weight * parent) / (group["allowed"] + group["blocked"] + weight)
    return groups


_NODE = "host string, template string, branches map<string,string>, sizes map<string,bigint>, purities map<string,double>"


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    branches = [{k: (v if k == "token" else int(v)) for k, v in r.items() if k not in ("host", "template", "purity")} for r in rows.to_dict("records")]
    groups = merge(branches, float(rows["purity"].iloc[0]))
    return pd.DataFrame(
        [
            {
                "host": rows["host"].iloc[0],
                "template": rows["template"].iloc[0],
                "branches": {t: g["name"] for g in groups for t in g["tokens"]},
                "sizes": {g["name"]: g["n"] for g in groups},
                "purities": {g["name"]: g["purity"] for g in groups},
            }
        ]
    )


def templates(paths: DataFrame) -> DataFrame:
    """(host, tokens, template, purity) of counted paths (host, tokens, n, allowed, blocked)."""
    paths = save(paths, "paths")
    whole = paths.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"), F.max(F.size("tokens")).alias("depth")).first()
    prior = ((whole["a"] or 0) + 1) / ((whole["a"] or 0) + (whole["b"] or 0) + 2)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("total"), F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    hosts = hosts.select("host", "total", ((F.col("a") + WEIGHT * prior) / (F.col("a") + F.col("b") + WEIGHT)).alias("purity"))
    rows = save(paths.join(save(hosts, "hosts"), "host").withColumn("template", F.lit("")), "level")
    done = []
    for level in range(whole["depth"] or 0):
        here = rows.where(F.size("tokens") > level)
        done.append(rows.where(F.size("tokens") <= level))
        token = F.get("tokens", F.lit(level))
        sums = [F.sum("n").alias("n"), F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")]
        sums += [F.sum(F.when(_kind(level + 1) == k, F.col("n")).otherwise(0)).alias(k) for k in KINDS]
        children = here.groupBy("host", "template", token.alias("token"), "purity", "total").agg(*sums)
        rare = (F.col("n") < LEAST) | (F.col("n") < SHARE * F.col("total"))
        folded = children.withColumn("token", F.when(rare, "*").otherwise(F.col("token")))
        bounded = folded.groupBy("host", "template", "token", "purity").agg(*[F.sum(c).alias(c) for c in ("n", "allowed", "blocked", *KINDS)])
        nodes = save(bounded.groupBy("host", "template").applyInPandas(_merged, _NODE), "nodes")
        branch = F.coalesce(F.col("branches")[token], F.col("branches")["*"])
        joined = here.drop("purity", "total").join(nodes, ["host", "template"]).withColumn("branch", branch)
        rows = save(
            joined.select(
                "host", "tokens", "n", "allowed", "blocked",
                F.col("sizes")[F.col("branch")].alias("total"),
                F.col("purities")[F.col("branch")].alias("purity"),
                F.concat("template", F.lit("/"), "branch").alias("template"),
            ),
            "level",
        )
    for part in done:
        rows = rows.unionByName(part)
    return rows.select("host", "tokens", "template", "purity")


def judge(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, template, purity) of every row of ``pages``.

    ``labelled`` (url, verdict) are URLs judged elsewhere; they count for their templates beside those that
    ``rules`` judge."""

    def read(df: DataFrame, *more: Column) -> DataFrame:
        host, path = parsed(F.col(url))
        split = df.select(*more, host.alias("host"), path.alias("path"))
        rule, verdict = ruled(F.col("host"), F.col("path"), rules)
        return split.withColumns({"tokens": tokens(F.col("path")), "rule": rule, "ruled": verdict})

    def counted(df: DataFrame, n: Column, verdict: Column) -> DataFrame:
        return df.groupBy("host", "tokens").agg(
            F.sum(n).alias("n"), F.count_if(verdict == "allow").alias("allowed"), F.count_if(verdict == "block").alias("blocked")
        )

    rows = save(read(pages, F.col(key)), "urls")
    paths = counted(rows, F.lit(1).cast("long"), F.col("ruled"))
    if labelled is not None:
        more = counted(read(labelled, F.col("verdict").alias("given")), F.lit(0).cast("long"), F.col("given"))
        paths = paths.unionByName(more).groupBy("host", "tokens").agg(*[F.sum(c).alias(c) for c in ("n", "allowed", "blocked")])
    found = save(templates(paths), "templates")
    method = F.when(F.col("purity") < PURITY, "block").otherwise("allow")
    return rows.join(found, ["host", "tokens"]).select(
        key, "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity"
    )

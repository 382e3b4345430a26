"""URL filters: rules by host and path, and for every other page the standing of its host in the link graph.

Rules say what they say: the longest rule that fits a url decides. For urls without a rule, trust flows from hosts whose pages rules
allow along links, as personalised PageRank, and distrust flows from hosts whose pages rules block against them, to those who link
there. A seed's weight is the share of its pages so ruled, so values read on the scale of one host: a host is blocked where
distrust exceeds trust by more than THRESHOLD, half of the pages of a host nobody links to. A host without seeds or links is allowed.

DataFrame functions only. Rounds run over hosts and distinct host edges, never over pages, and each is written to the shared folder.
A hub's edges are cut into blocks of at most about BLOCK by the hash of their other end, and its value is sent to each of
them. Rules meet hosts by the host's suffixes, so their number is free.

Null urls and urls without ``://`` have an empty host and path, fit no rule and are allowed. Repeated rows are judged each; null html
has no links. Links are the absolute ``href`` of ``a`` tags outside comments and scripts; those to the own host do not count. Other
columns are ignored. No pages give no rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import materialise

#: Share of a host's value that goes on along its links, and rounds: what is left after them is under DAMPING ** ROUNDS.
DAMPING, ROUNDS = 0.85, 20
#: Excess of distrust over trust above which a host is blocked.
THRESHOLD = 0.5
#: Edges of one host that one value row is sent to.
BLOCK = 10_000
#: Comments, scripts, and the absolute link of an ``a`` tag as group 1.
LINK = r"""(?is)<!--.*?-->|<script\b.*?</script\s*>|<a\s[^>]*?\bhref\s*=\s*["']?\s*([a-z][a-z0-9+.\-]*://[^"'\s>]+)"""

#: (verdict, host, path).
Rule = tuple[str, str, str]


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def host_of(url: Column) -> Column:
    """Host of a url in lower-case ASCII letters, as written; empty where there is none."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*", 0), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules of each host and the domains above it, as structs (path, rule, verdict); hosts without any are left out."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    domains = hosts.where("host <> ''").select("host", F.explode(suffixes).alias("domain"))
    named = rules.select(F.col("host").alias("domain"), F.struct("path", F.concat("host", "path").alias("rule"), "verdict").alias("rule"))
    return domains.join(named, "domain").groupBy("host").agg(F.collect_set("rule").alias("rules"))


def _longest(path: Column, rules: Column) -> Column:
    """The longest rule whose path begins the url's, as (length, rule, verdict); of equal rules the blocking one."""
    fitting = F.filter(rules, lambda r: F.startswith(path, r["path"]))
    return F.array_max(F.transform(fitting, lambda r: F.struct(F.char_length(r["rule"]).alias("length"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target, weight): distinct edges between different hosts, with the number of links."""
    found = pages.where(F.col(html).contains("://")).select(
        host_of(F.col(url)).alias("source"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("link")).where("link <> ''")
    edges = found.select("source", host_of(F.col("link")).alias("target")).where("source <> '' and target <> '' and source <> target")
    return edges.groupBy("source", "target").agg(F.count("*").cast("double").alias("weight"))


def _flows(edges: DataFrame, kind: str, start: str, end: str) -> DataFrame:
    """Edges along which a value flows, with the share of it, in blocks by their start."""
    rows = edges.select(F.lit(kind).alias("kind"), F.col(start).alias("start"), F.col(end).alias("end"), "weight")
    totals = rows.groupBy("start").agg(F.sum("weight").alias("total"), (F.floor(F.count("*") / BLOCK) + 1).cast("int").alias("blocks"))
    rows = rows.join(totals, "start").withColumn("share", F.col("weight") / F.col("total"))
    return rows.select("kind", "start", F.pmod(F.xxhash64("end"), "blocks").cast("int").alias("block"), "end", "share", "blocks")


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from the ``trust`` and ``distrust`` of seed hosts: each round a host has its own seed and the
    damped shares that flow in, trust along the edges and distrust against them."""
    own = materialise(
        seeds.select(F.col("host"), F.inline(F.array(
            F.struct(F.lit("trust").alias("kind"), F.col("trust").alias("value")), F.struct(F.lit("distrust").alias("kind"), F.col("distrust").alias("value")))))
        .where("value > 0"), "url-seeds")
    flows = materialise(_flows(edges, "trust", "source", "target").unionByName(_flows(edges, "distrust", "target", "source")), "url-flows")
    # How many copies of its value a host sends: one for each of its blocks.
    copies = materialise(flows.groupBy("kind", F.col("start").alias("host")).agg(F.max("blocks").alias("blocks")), "url-blocks")
    values = own
    if not flows.isEmpty():
        for _ in range(rounds):
            sent = values.join(copies, ["kind", "host"]).select(
                "kind", F.col("host").alias("start"), "value", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
            inflow = flows.join(sent, ["kind", "start", "block"]).select("kind", F.col("end").alias("host"), (damping * F.col("share") * F.col("value")).alias("value"))
            values = materialise(own.unionByName(inflow).groupBy("kind", "host").agg(F.sum("value").alias("value")), "url-round")

    def of(kind: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("value"))), F.lit(0.0)).alias(kind)

    return values.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: Sequence[Rule] | DataFrame, key: str = "page_id", url: str = "url", html: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """(key, host, path, rule, verdict, trust, distrust): one row for each page."""
    spark = pages.sparkSession
    listed = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), "verdict string, host string, path string")
    urls = materialise(pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")), "url-pages")
    known = materialise(rules_of_hosts(urls.select("host").distinct(), listed), "url-rules")
    # Few distinct (host, rule) are left of the pages before anything is dealt by host.
    ruled = urls.join(known, "host", "left").select("key", "host", "path", _longest(F.col("path"), F.col("rules")).alias("found"))
    ruled = materialise(ruled.select("key", "host", "path", "found.rule", "found.verdict"), "url-ruled")

    def share(verdict: str) -> Column:
        return F.avg(F.when(F.col("verdict") == verdict, 1.0).otherwise(0.0))

    seeds = ruled.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    standing = propagate(seeds, materialise(links(pages, url, html), "url-links"))
    # Only hosts of some standing are joined; all others are allowed.
    standing = materialise(standing.where("trust > 0 or distrust > 0"), "url-standing")
    judged = ruled.join(standing, "host", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})
    by_host = F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow")
    return judged.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("verdict", by_host).alias("verdict"), "trust", "distrust")

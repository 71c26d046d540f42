"""Verdicts on URLs: rules on hosts and paths, and for all other URLs trust spread over the graph of hosts.

Hosts whose pages are mostly allowed hand on trust to the hosts they link to; hosts whose pages are mostly
blocked hand on distrust to the hosts that link to them. Both are personalised PageRank over the same edges, the second with
the edges reversed. A host whose distrust exceeds its trust, and the least that counts, is blocked.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.session import materialise

DAMPING = 0.85
#: Least distrust of a blocked host; a seed has 1, and each link passes on 0.85 shared among a host's links.
LEAST_DISTRUST = 0.01
TOLERANCE = 1e-6
ROUNDS = 100
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^/?#"'<>\s]+)"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` for URLs on ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, ascii_uppercase, ascii_lowercase)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, html``; both empty where the URL is null or has no ``://``."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id", lower_ascii(F.regexp_extract(url, _URL, 1)).alias("host"),
        F.regexp_extract(url, _URL, 2).alias("path"), "html",
    )


def judged_by(rules: list[Rule]) -> Column:
    """Struct of the longest fitting rule's text and verdict, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        own = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(F.col("host"), F.col("path")), own).otherwise(found)
    return found


def host_edges(hosts: DataFrame) -> DataFrame:
    """``src, dst, n``: pages of one host that link to another, from the links that name a host.

    Links of a page to one host count once; links within a host and pages without host are left out.
    """
    links = F.array_distinct(F.transform(
        F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), lambda x: lower_ascii(F.regexp_extract(x, r"//(.*)$", 1))
    ))
    return (
        hosts.where("host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("dst"))
        .where("src <> dst and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def spread_trust(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """``host, trust, distrust`` of every host that either reaches, for ``seeds(host, trusted, blocked)``.

    A seed starts with 1. A host hands on ``damping`` of what it has, shared by the weights of its edges;
    what reaches a host without edges ends there. Rounds go on until what still moves is below TOLERANCE of
    the seeds, at most ROUNDS. A round is one join of the hosts with their edges, cut by a checkpoint.
    """
    edges = materialise(edges)
    start = materialise(
        seeds.where("trusted").select(F.lit(0).alias("side"), "host", F.lit(1.0).alias("x"))
        .union(seeds.where("blocked").select(F.lit(1), "host", F.lit(1.0)))
    )
    ways = edges.select(F.lit(0).alias("side"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").union(
        edges.select(F.lit(1), "dst", "src", "n")
    )
    totals = ways.groupBy("side", "host").agg(F.sum("n").alias("total"))
    ways = materialise(
        ways.join(totals, ["side", "host"]).select("side", "host", "to", (F.col("n") / F.col("total") * damping).alias("share"))
    )
    total, moving = start, start
    mass = start.agg(F.coalesce(F.sum("x"), F.lit(0.0))).first()[0]
    left = mass
    for _ in range(ROUNDS):
        if left <= TOLERANCE * mass:
            break
        moving = materialise(
            moving.join(ways, ["side", "host"])
            .groupBy("side", F.col("to").alias("host")).agg(F.sum(F.col("x") * F.col("share")).alias("x"))
        )
        left = moving.agg(F.coalesce(F.sum("x"), F.lit(0.0))).first()[0]
        total = materialise(total.union(moving).groupBy("side", "host").agg(F.sum("x").alias("x")))
    amount = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("x"))), F.lit(0.0))
    return total.groupBy("host").agg(amount(0).alias("trust"), amount(1).alias("distrust"))


def judge_urls(pages: DataFrame, rules: list[Rule], least: float = LEAST_DISTRUST, damping: float = DAMPING) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row of ``pages(page_id, url, html)``.

    The longest fitting rule decides; without one the host's trust and distrust do. A host that no seed
    reaches has neither and is allowed, as is a URL without a host. Hosts of whose pages rules allow more than
    half are trusted seeds, and those of whose pages they block more than half are blocked seeds. Null html
    has no links. Repeated rows are kept.
    """
    hosts = with_host_and_path(pages).withColumn("by", judged_by(rules))
    seeds = (
        hosts.where("host <> ''").groupBy("host")
        .agg(*[(2 * F.count_if(F.col("by.verdict") == verdict) > F.count("*")).alias(name)
               for verdict, name in (("allow", "trusted"), ("block", "blocked"))])
        .where("trusted or blocked")
    )
    known = spread_trust(host_edges(hosts), seeds, damping)
    scored = hosts.drop("html").join(known, "host", "left").withColumns({
        "trust": F.coalesce("trust", F.lit(0.0)), "distrust": F.coalesce("distrust", F.lit(0.0)),
    })
    against = (F.col("distrust") >= least) & (F.col("distrust") > F.col("trust"))
    method = F.when(against, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id", "host", "path", F.col("by.rule").alias("rule"),
        F.coalesce(F.col("by.verdict"), method).alias("verdict"), "trust", "distrust",
    )

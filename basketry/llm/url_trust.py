"""Verdicts on urls: rules first, then trust and distrust that spread over the links between hosts.

Rules name a host with its subdomains and a beginning of the path; the longest that fits decides. Hosts with pages that
a rule allows are trusted seeds, hosts with blocked pages are distrusted seeds, each by the number of such pages.
Personalised PageRank carries trust along the links; distrust runs against them, to the hosts that link to bad ones.
Where no rule fits, a host is blocked if its distrust is at least ``BLOCK_SHARE`` of both, else allowed.

Hosts, links and scores stay in tables; each round is written to the shared folder. Links are summed per pair of hosts
before they are shuffled, so the work of a round grows with the pairs of hosts. Rounds go on until the scores of all
hosts together change by less than ``TOLERANCE``; the damping bounds their number (``most_rounds``).

Defined results: a null url, and one without ``://``, has empty host and path and is judged by the method like a host
without links (allowed, unless it is a seed). Null or empty html has no links; links that name no host stay on theirs
and say nothing. Repeated rows are kept and count each; extra columns are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import input_columns, table, written

DAMPING = 0.85
TOLERANCE = 1e-6
BLOCK_SHARE = 2 / 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: F.Column) -> F.Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: F.Column) -> F.Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def decided(rules: tuple[Rule, ...], value) -> F.Column:
    """``value`` of the longest rule that fits the columns host and path; null if none does."""
    choice = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        host = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
        fits = host & F.col("path").startswith(rule.path)
        choice = F.when(fits, F.lit(value(rule))) if choice is None else choice.when(fits, F.lit(value(rule)))
    return choice if choice is not None else F.lit(None).cast("string")


def host_links(pages: DataFrame) -> DataFrame:
    """Links between different hosts, summed: src, dst, n. ``pages``: host, html."""
    targets = F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))
    # a link may leave its scheme out
    named = F.transform(targets, lambda x: F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).otherwise(x))
    links = pages.select(F.col("host").alias("src"), F.explode(named).alias("link"))
    links = links.select("src", host_of(F.col("link")).alias("dst"))
    return links.filter((F.col("src") != F.col("dst")) & (F.col("dst") != "") & (F.col("src") != "")).groupBy("src", "dst").agg(F.count("*").alias("n"))


def most_rounds(damping: float, tolerance: float) -> int:
    """Rounds after which the change, at most 2 for each kind and less by the damping each round, is below the tolerance."""
    return 2 + max(0, math.ceil(math.log(tolerance / 4) / math.log(damping)))


def spread(links: DataFrame, seeds: DataFrame, damping: float, tolerance: float, rounds: int | None = None) -> DataFrame:
    """host, kind, score: trust along the links, distrust against them. ``seeds``: host, kind, share (1 in all a kind)."""
    along = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    against = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    edges = along.unionByName(against)
    degree = edges.groupBy("kind", "host").agg(F.sum("n").alias("all"))
    edges = written(
        edges.join(degree, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("weight")), "trust-edges"
    )
    scores = seeds.select("kind", "host", F.col("share").alias("score"))
    if seeds.isEmpty() or edges.isEmpty():
        return scores
    for _ in range(most_rounds(damping, tolerance) if rounds is None else rounds):
        moved = scores.join(edges, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), (damping * F.col("score") * F.col("weight")).alias("got"), F.lit(0.0).alias("share"), F.lit(0.0).alias("old")
        )
        base = seeds.select("kind", "host", F.lit(0.0).alias("got"), "share", F.lit(0.0).alias("old"))
        before = scores.select("kind", "host", F.lit(0.0).alias("got"), F.lit(0.0).alias("share"), F.col("score").alias("old"))
        summed = moved.unionByName(base).unionByName(before).groupBy("kind", "host")
        summed = written(summed.agg(*(F.sum(name).alias(name) for name in ("got", "share", "old"))), "trust-round")
        # what did not travel on, from hosts without links too, goes back to the seeds
        kept = {row.kind: 1.0 - row.got for row in summed.groupBy("kind").agg(F.sum("got").alias("got")).collect()}
        back = F.lit(0.0)
        for kind, rest in kept.items():
            back = F.when(F.col("kind") == kind, F.lit(rest)).otherwise(back)
        now = summed.select("kind", "host", (F.col("got") + back * F.col("share")).alias("score"), "old")
        change = now.agg(F.sum(F.abs(F.col("score") - F.col("old")))).first()[0]
        scores = now.select("kind", "host", "score").filter(F.col("score") > 0)
        if change < tolerance:
            return scores
    raise RuntimeError(f"trust still changes by {change} after the last round; give it more rounds or a larger tolerance")


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    rounds: int | None = None,
    damping: float = DAMPING,
    block_share: float = BLOCK_SHARE,
) -> DataFrame:
    """A row per page: page_id, host, path, rule, verdict, host_trust, host_distrust.

    ``rounds``: a limit below that of the damping; it is an error if the scores have not settled by then.
    """
    rows = input_columns(pages, page_id=page_id, url=url, html=html)
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = rows.withColumns({"rule": decided(rules, lambda r: r.name), "ruled": decided(rules, lambda r: r.verdict)})
    counts = ruled.filter(F.col("ruled").isNotNull()).groupBy("host", "ruled").agg(F.count("*").alias("n"))
    counts = written(counts.select("host", F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind"), "n"), "trust-seeds")
    totals = {row.kind: row.n for row in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    total = F.lit(0)
    for kind, n in totals.items():
        total = F.when(F.col("kind") == kind, F.lit(n)).otherwise(total)
    seeds = counts.select("host", "kind", (F.col("n") / total).alias("share"))
    scores = spread(host_links(rows), seeds, damping, TOLERANCE, rounds)
    # in pages instead of shares, so that trust and distrust of a host can be compared
    mass = scores.select("host", "kind", (F.col("score") * total).alias("mass"))
    hosts = mass.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("mass")).otherwise(0.0)).alias("host_trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("mass")).otherwise(0.0)).alias("host_distrust"),
    )
    hosts = hosts.withColumn("blocked", F.col("host_distrust") >= block_share * (F.col("host_trust") + F.col("host_distrust")))
    judged = ruled.drop("html").join(hosts, "host", "left")
    by_host = F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"),
        F.coalesce("host_trust", F.lit(0.0)).alias("host_trust"), F.coalesce("host_distrust", F.lit(0.0)).alias("host_distrust"),
    )


def op1(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))

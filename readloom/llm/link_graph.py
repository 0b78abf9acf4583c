"""URL verdicts by rules, and by trust and distrust that travel along links between hosts.

Trust is personalised PageRank from trusted hosts along links; distrust is the same from
blocked hosts against the links (who links to bad hosts is distrusted). Only DataFrame
functions are used.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"


RULES = (Rule("allow", "com"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
#: A host is a seed if rules decide alike on this share of its pages at least.
SEED_SHARE = 0.9
DAMPING, ROUNDS, TOLERANCE = 0.85, 30, 1e-6
#: Rounds after which ranks are compared with the round before.
COMPARED_ROUNDS = 3

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(after, "^[^/?#]*", 0), _CAPITALS, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(after, "^[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """A host without user and port, by which pages and links are the same node of the graph."""
    return F.regexp_replace(host, r"^[^@]*@|:[0-9]*$", "")


def _first_fitting(rules: tuple[Rule, ...], host: Column, path: Column, value) -> Column:
    out = F.lit(None).cast("string")
    for r in sorted(rules[::-1], key=lambda r: len(r.host + r.path)):  # the longest is asked first, of equals the first
        out = F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(value(r))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, n: how many absolute links the pages of a host have to another host, both without user and port."""
    links = pages.select(site_of(host_of(F.col(url))).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), 1)).alias("link"))
    links = links.select("src", site_of(F.translate("link", _CAPITALS, _SMALL)).alias("dst"))
    return links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagated(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind, host, rank of seeds(kind trust or distrust, host, weight) along edges(src, dst, n).

    Of each kind ranks sum up to 1. Mass at hosts without a way on goes back to the seeds.
    Ranks are sums over pre-aggregated edges; a host with many links is split by the join.
    What a round moves is one staged table, so no plan holds more than a round. Without
    seeds there are no ranks; seeds and edges without a host are left out.
    """
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    seeds = staged(seeds.join(total, "kind").select("kind", "host", (F.col("weight") / F.col("total")).alias("weight")), "seeds")
    ways = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"))
    ways = staged(ways.join(ways.groupBy("kind", "host").agg(F.sum("n").alias("all")), ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("share")), "ways")
    rank = seeds.select("kind", "host", F.col("weight").alias("rank"))
    if ways.isEmpty():
        return rank
    moved = None
    for k in range(rounds):
        before, moved = moved, staged(rank.join(ways, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg((F.sum(F.col("rank") * F.col("share")) * DAMPING).alias("rank")), "moved")
        back = moved.groupBy("kind").agg(F.sum("rank").alias("gone"))  # two rows
        home = seeds.join(F.broadcast(back), "kind", "left").select("kind", "host", (F.col("weight") * (1 - F.coalesce("gone", F.lit(0.0)))).alias("rank"))
        rank = moved.unionByName(home).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if before is not None and k % COMPARED_ROUNDS == COMPARED_ROUNDS - 1:
            change = moved.join(before.withColumnRenamed("rank", "old"), ["kind", "host"], "full").agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0]
            if (change or 0) < TOLERANCE:
                break
    return rank


def judged(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    The longest rule that fits decides. Other pages are blocked if their host's distrust is
    above its trust, else allowed; hosts that neither reaches are allowed. Ports and users make no
    other host in the graph. Null urls and urls
    without :// have an empty host and are allowed; null html has no links; repeated rows
    are judged alike. Of rules as long as each other that fit the first in `rules` decides; equal trust
    and distrust allow. An empty table gives none.
    """
    found = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule = _first_fitting(rules, F.col("host"), F.col("path"), lambda r: r.host + r.path)
    ruled = found.withColumn("rule", rule).withColumn("ruled", _first_fitting(rules, F.col("host"), F.col("path"), lambda r: r.verdict))
    ruled = ruled.withColumn("site", site_of(F.col("host")))
    share = ruled.where("site <> ''").groupBy(F.col("site").alias("host")).agg(F.count("*").alias("n"), F.sum(F.when(F.col("ruled") == "allow", 1).otherwise(0)).alias("allowed"), F.sum(F.when(F.col("ruled") == "block", 1).otherwise(0)).alias("blocked"))
    kind = F.when(F.col("allowed") >= SEED_SHARE * F.col("n"), "trust").when(F.col("blocked") >= SEED_SHARE * F.col("n"), "distrust")
    seeds = share.select(kind.alias("kind"), "host", F.col("n").cast("double").alias("weight")).where("kind is not null")
    ranks = propagated(host_edges(pages, url, html), seeds)
    rank = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    blocked = ranks.groupBy("host").agg(rank("trust").alias("trust"), rank("distrust").alias("distrust")).where("distrust > trust").select(F.col("host").alias("site"), F.lit("block").alias("own"))
    return ruled.join(blocked, "site", "left").select("page_id", "host", "path", "rule", F.coalesce("ruled", "own", F.lit("allow")).alias("verdict"))

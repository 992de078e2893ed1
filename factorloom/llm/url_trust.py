"""URL filters: host and path rules, and trust that spreads over the graph of hosts.

A rule fits a host and its subdomains where the path starts with the rule's path; the longest
rule decides.  For pages no rule fits, links decide: personalised PageRank from the hosts of
allowed pages follows the links (trust), from the hosts of blocked pages it follows them
backwards (distrust); a host with more distrust than trust is blocked.  For that every seed page
weighs the same, and the difference is taken as a share of the sum: pages that do not reach a host
change nothing for it, however many they are.

Links are the absolute links of a page; a link without a host stays on its own.  A
host also links with its parent domain, both ways, as sites of one owner, and so on down to two
labels, whether or not a page is on the parent.  Edges are counted per pair of hosts before
anything moves, so a busy host is a row per neighbour.

Nulls, empties and repeats: a null url, or one without ``://``, has an empty host and path, and
an empty host takes no part in the graph; null html has no links; a null or repeated id is
kept as it is, pages with equal urls get equal verdicts.  Very long pages are read whole and a tag
once; only the three columns named are read, others may have any name.  An empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.llm.frames import stored
from factorloom.session import small_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROUNDS = 10
DAMPING = 0.85
# Characters of a host name, by the rules of the DNS.
MAX_HOST = 253


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of an url; both empty without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return (F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER),
            F.regexp_extract(url, pattern, 2))


def best_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest fitting rule as (size, rule, verdict); null where none fits."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"),
                            F.lit(r.verdict).alias("verdict"))) for r in rules]
    return F.array_max(F.array(*fits))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links): counted links between different hosts of ``pages`` (host, html).

    Tags are found first, each read once, then the link inside a tag.
    """
    tags = F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")),
                                F.lit(r"(?i)<a\s[^<>]*+"), F.lit(0))
    links = F.filter(F.transform(tags, lambda tag: F.regexp_extract(
        tag, r"""(?i)\shref\s*+=\s*+["']?([^"'\s]++)""", 1)), lambda u: u != "")
    absolute = F.filter(links, lambda u: u.rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//"))
    out = pages.select(F.col("host").alias("src"), F.explode(F.transform(
        absolute, lambda u: host_and_path(F.when(u.startswith("//"), F.concat(F.lit(":"), u))
                                          .otherwise(u))[0])).alias("dst"))
    return (out.where("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))


def family_edges(hosts: DataFrame, max_host: int = MAX_HOST) -> DataFrame:
    """(src, dst, links): each host and its parent domain, both ways, down to two labels.

    Parents without pages are in the chain as well.  A name of more than ``max_host`` characters,
    more than the DNS permits, links with its parent only.
    """
    labels = F.split("host", r"\.")
    n = F.size(labels)
    steps = F.when(F.length("host") <= max_host, n - 2).otherwise(F.lit(1))
    up = hosts.where(n > 2).select(F.explode(F.transform(
        F.sequence(F.lit(1), steps), lambda i: F.struct(
            F.array_join(F.slice(labels, i, n), ".").alias("src"),
            F.array_join(F.slice(labels, i + 1, n), ".").alias("dst")))).alias("edge")).select(
        "edge.src", "edge.dst", F.lit(1).cast("long").alias("links")).where(
        "src <> '' and dst <> ''").distinct()
    return up.union(up.select("dst", "src", "links"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS,
              damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) of every host reached.

    ``seeds`` has (host, way, weight), way 1 for trust along the links and -1 for distrust against
    them, weights summing to 1 per way.  Both walks share one join and one aggregate a round.
    """
    ways = edges.select(F.lit(1).alias("way"), "src", "dst", "links").union(
        edges.select(F.lit(-1), F.col("dst"), F.col("src"), "links"))
    out = ways.groupBy("way", "src").agg(F.sum("links").alias("all"))
    steps = stored(ways.groupBy("way", "src", "dst").agg(F.sum("links").alias("links"))
                   .join(out, ["way", "src"])
                   .select("way", "src", "dst", (F.col("links") / F.col("all")).alias("p")),
                   "host-steps")
    home = seeds.select("way", "host", (F.lit(1 - damping) * F.col("weight")).alias("score"))
    home = stored(home, "host-seeds")
    ranks = seeds.select("way", "host", F.col("weight").alias("score"))
    for _ in range(rounds):
        moved = ranks.join(steps, (ranks["way"] == steps["way"]) & (ranks["host"] == steps["src"])
                           ).select(steps["way"], F.col("dst").alias("host"),
                                    (F.lit(damping) * F.col("score") * F.col("p")).alias("score"))
        ranks = stored(moved.union(home).groupBy("way", "host").agg(F.sum("score").alias("score")),
                       "host-ranks")
    return ranks.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("way") == 1, F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("way") == -1, F.col("score"))), F.lit(0.0))
        .alias("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, least: float = 0.0,
          max_host: int = MAX_HOST) -> DataFrame:
    """Every page: page_id, host, path, rule, verdict, trust, distrust.

    Where no rule fits, a page is blocked if its host's trust less distrust, per seed page and
    as a share of both, to ten digits, is below ``least``.
    """
    host, path = host_and_path(F.col("url"))
    known = stored(pages.select(
        F.col("page_id"), host.alias("host"), path.alias("path"), "html")
        .select("page_id", "host", "path", "html",
                best_rule(F.col("host"), F.col("path"), rules).alias("best"))
        .select("page_id", "host", "path", "best.rule", "best.verdict",
                F.when(F.col("html").contains("//"), F.col("html")).alias("html")), "pages")
    hosts = stored(known.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").alias("allowed"),
        F.count_if(F.col("verdict") == "block").alias("blocked")), "hosts")
    seeds = hosts.select("host", F.lit(1).alias("way"), F.col("allowed").alias("n")).union(
        hosts.select("host", F.lit(-1), "blocked")).where("n > 0")
    totals = seeds.groupBy("way").agg(F.sum("n").alias("all"))
    seeds = seeds.join(F.broadcast(totals), "way").select(
        "host", "way", (F.col("n") / F.col("all")).alias("weight"))
    mass = F.broadcast(totals.agg(*[
        F.coalesce(F.max(F.when(F.col("way") == way, F.col("all"))), F.lit(0)).alias(name)
        for way, name in ((1, "allowed"), (-1, "blocked"))]))
    edges = host_edges(known).unionByName(family_edges(hosts, max_host))
    scores = propagate(edges, seeds).withColumnRenamed("host", "scored").crossJoin(mass)
    # the seeds' weights sum to 1 per way: times their number, one seed page weighs 1
    up, down = F.col("trust") * F.col("allowed"), F.col("distrust") * F.col("blocked")
    scores = scores.select("scored", "trust", "distrust", F.round(
        (up - down) / F.nullif(up + down, F.lit(0.0)), 10).alias("balance"))
    # a host with scores is one with pages; a small table of them spares moving the pages
    scores = small_side(scores.join(hosts.select(F.col("host").alias("scored")), "scored",
                                    "left_semi"))
    joined = known.drop("html").join(scores, known["host"] == scores["scored"], "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    return joined.select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.coalesce("balance", F.lit(0.0)) < least, "block")
                   .otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return result.select("page_id", "host", "path", "rule", "verdict")

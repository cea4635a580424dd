"""URL filters by link-graph propagation between hosts. Built-ins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, maybe_broadcast, written

#: (host, path, verdict); the rule's text is host + path.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
ROUNDS, DAMPING = 10, 0.85
#: A host is blocked where distrust is more than this share of trust and distrust, and at least so much: the rank of a host
#: without links of whose pages a third are blocked.
MAX_DISTRUST, MIN_DISTRUST = 0.5, 0.05


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or end, A-Z lower-cased; empty for null or without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule fits its host and all subdomains where the
    path starts with the rule's path; an empty path starts with no `/`. Equal lengths: block wins, then the text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "block", r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(src, dst, weight) between different hosts: links of pages to absolute addresses, counted before they are dealt
    out; and, of weight 1 both ways, a host's tie to the host it is a subdomain of, up to the registered name."""
    link = r"(?i)(?:href|src)\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"
    links = (
        pages.select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(link), F.lit(1))).alias("dst"))
        .withColumn("dst", F.translate("dst", UPPER, LOWER))
        .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    return links.filter((F.col("src") != F.col("dst")) & (F.col("src") != ""))


def parent_edges(hosts: DataFrame) -> DataFrame:
    up = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1).alias("dst")).filter("dst <> ''")
    return up.withColumn("weight", F.lit(1.0)).unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1.0).alias("weight")))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank of several kinds at once: (kind, host, rank) from edges (kind, src, dst, share) and seeds
    (kind, host, seed). A fixed number of rounds of rank = (1 - damping) * seed + damping * sum of share * rank over the
    edges into a host: one join and one pre-aggregated sum each. Mass of hosts without out-edges is not dealt again.
    Every fifth round's ranks are cut from their lineage by a written table."""
    start = seeds.select("kind", "host", (F.lit(1 - damping) * F.col("seed")).alias("rank"))
    rank = seeds.select("kind", "host", "seed").withColumnRenamed("seed", "rank")
    for i in range(rounds):
        flow = edges.join(rank.withColumnRenamed("host", "src"), ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.lit(damping) * F.col("share") * F.col("rank")).alias("rank"))
        rank = start.unionByName(flow).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % 5 == 4:
            rank = written(rank, "rank")
    return rank


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, rounds: int = ROUNDS, damping: float = DAMPING, max_distrust: float = MAX_DISTRUST, min_distrust: float = MIN_DISTRUST) -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, host_trust, host_distrust.

    verdict is the rule's, else the host's. Seeds are hosts with ruled pages alone: trusted ones in proportion to the
    share of their pages that rules allow, blocked ones to the share that rules block; trust runs along links, distrust
    against them (who links to a blocked host is suspect). A host is blocked where distrust / (trust + distrust) is over
    max_distrust and distrust is at least min_distrust, and allowed otherwise. Null or odd urls: empty host and path, no
    rule, and allowed, as the empty host takes no part in the graph. Null html: no links. Other columns are left out.
    """
    d = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_u"), F.col(f"`{html_col}`").alias("_h"))
    d = d.withColumn("host", host_of(F.col("_u"))).withColumn("path", path_of(F.col("_u")))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    d = d.withColumn("rule", rule).withColumn("_said", said)

    share = lambda v: F.avg((F.col("_said").eqNullSafe(v)).cast("double"))
    judged = d.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")).filter("host <> ''")
    judged = written(judged, "seeds")
    edges = written(host_edges(d, "host", "_h").unionByName(parent_edges(judged)).groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "edges")
    turned = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(turned)
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("w"))
    both = written(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("w")).alias("share")), "shares")
    seeds = judged.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "seed")).filter("seed > 0")
    ranks = propagate(both, seeds, rounds, damping)
    bad = ranks.groupBy(F.col("host").alias("_host")).agg(*[F.sum(F.when(F.col("kind") == k, F.col("rank")).otherwise(0.0)).alias(f"host_{k}") for k in ("trust", "distrust")])
    bad = written(bad, "verdicts")
    out = d.drop("_h", "_u").join(maybe_broadcast(bad), F.col("host") == F.col("_host"), "left")
    blocked = (F.col("host_distrust") > max_distrust * (F.col("host_trust") + F.col("host_distrust"))) & (F.col("host_distrust") >= min_distrust)
    return out.select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce(F.col("_said"), F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("host_trust", F.lit(0.0)).alias("host_trust"), F.coalesce("host_distrust", F.lit(0.0)).alias("host_distrust"),
    )

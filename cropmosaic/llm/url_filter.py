"""URL filters: host and path rules, and trust carried over the link graph of hosts."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmosaic.llm.common import stored, with_size_hint

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Part of the rank that goes on over links; rounds at most; change at which to stop.
DAMPING, ROUNDS, TOLERANCE = 0.85, 30, 1e-6
#: A host whose distrust exceeds its trust is blocked if rules block this share of its pages, or if the distrust
#: that links bring it, beyond its own blocked pages, comes to this share of its pages.
BLOCK_SHARE, LINK_SHARE = 0.5, 0.1
#: Absolute or protocol-relative targets of links.
LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    """allow or block a host with its subdomains, where the path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands after :// up to /, ?, # or the end, A-Z lower-cased; '' without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url.cast("string"), r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #; '' without ://."""
    return F.coalesce(F.regexp_extract(url.cast("string"), r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, else NULL. Equal lengths: the greater name.

    The rules are a parameter of bounded number; they are looked up by each suffix of the host.
    """
    if not rules:
        return F.lit(None).cast("struct<name:string,verdict:string>")
    by_host: dict[str, list[Rule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    entry = lambda r: F.struct(
        F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path")
    )
    table = F.create_map(*[c for h, own in by_host.items() for c in (F.lit(h), F.array(*[entry(r) for r in own]))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    found = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(table, s), F.array().cast(
        "array<struct<length:int,name:string,verdict:string,path:string>>"))))
    fits = F.array_max(F.filter(found, lambda r: F.startswith(path, r["path"])))
    return F.when(fits.isNotNull(), F.struct(fits["name"].alias("name"), fits["verdict"].alias("verdict")))


def host_links(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(src, dst, n): links between different hosts, counted; copies of a link are added up before the shuffle."""
    targets = F.regexp_extract_all(F.col(html).cast("string"), F.lit(LINK), F.lit(1))
    links = pages.filter(F.contains(F.col(html).cast("string"), F.lit("//"))).select(
        F.col(host).alias("src"), F.explode(F.transform(targets, lambda t: F.translate(t, UPPER, LOWER))).alias("dst")
    )
    links = links.filter((F.col("src") != "") & (F.col("src") != F.col("dst")))
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, rank): personalised PageRank of the hosts (host, seed) over links (src, dst, n).

    rank = (1 - d) * seed + d * (what links bring, by their weight); seeds are scaled to sum 1,
    and what hosts without links would pass on returns to the seeds. Rounds end when the ranks
    change by less than TOLERANCE in all. Each round is written to the shared folder.
    """
    total = seeds.agg(F.coalesce(F.sum("seed"), F.lit(0.0))).first()[0]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("rank"))
    seeds = stored(seeds.select("host", (F.col("seed") / F.lit(total)).alias("seed")))
    out = links.groupBy("src").agg(F.sum("n").alias("out"))
    share = stored(links.join(out, "src").select("src", "dst", (F.col("n") / F.col("out")).alias("share")))
    known = stored(seeds.join(out.select(F.col("src").alias("host"), F.lit(1).alias("links")), "host", "left"))
    ranks = known.withColumn("rank", F.col("seed"))
    for _ in range(rounds):
        lost = ranks.filter("links IS NULL").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        moved = ranks.join(share, ranks["host"] == share["src"]).groupBy("dst").agg(F.sum(F.col("rank") * F.col("share")).alias("moved"))
        new = ranks.join(moved, ranks["host"] == moved["dst"], "left")
        rank = F.lit(1 - damping + damping * lost) * F.col("seed") + F.lit(damping) * F.coalesce("moved", F.lit(0.0))
        new = stored(new.select("host", "seed", "links", F.col("rank").alias("old"), rank.alias("rank")))
        change = new.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
        ranks = new.drop("old")
        if change < TOLERANCE:
            break
    return ranks.select("host", "rank")


def host_trust(pages: DataFrame, links: DataFrame) -> DataFrame:
    """(host, pages, blocked, trust, distrust) from pages (host, verdict by rule or NULL) and host links.

    Trust flows along links from hosts with allowed pages; distrust flows against them, to those
    that link to hosts with blocked pages; each judged page is a seed of equal weight. Both are in
    pages: all trust adds up to the allowed pages, all distrust to the blocked ones, and a host has
    no less of either than rules judge of its own. Hosts only known as targets have 0 pages.
    """
    counts = pages.filter("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked")
    )
    hosts = counts.select("host").union(links.select("src")).union(links.select("dst")).distinct().join(counts, "host", "left")
    hosts = stored(hosts.na.fill(0, ["pages", "allowed", "blocked"]))
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    out = hosts
    for judged, name, edges in (("allowed", "trust", links), ("blocked", "distrust", against)):
        total = hosts.agg(F.coalesce(F.sum(judged), F.lit(0))).first()[0]
        ranks = propagate(hosts.select("host", F.col(judged).cast("double").alias("seed")), edges)
        ranks = ranks.select("host", (F.col("rank") * F.lit(float(total))).alias("_pages"))
        out = out.join(ranks, "host").withColumn(name, F.greatest(F.col(judged).cast("double"), "_pages")).drop("_pages")
    return out.select("host", "pages", "blocked", "trust", "distrust")


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """pages with host, path, rule, verdict in place of any columns of those names.

    The longest fitting rule decides; else the host's trust: block if its distrust is more than
    its trust and large for its pages (BLOCK_SHARE, LINK_SHARE), so that a large host is not
    blocked for a few links; allow otherwise and for hosts that neither reaches. A NULL url or one without :// has empty
    host and path, which no rule fits and no link reaches: allow. Repeated rows get equal
    verdicts and their links count again.
    """
    names = [f"_c{i}" for i in range(len(pages.columns))]
    rows = pages.toDF(*names)
    link, body = F.col(names[pages.columns.index(url)]), names[pages.columns.index(html)]
    rows = rows.withColumn("host", host_of(link)).withColumn("path", path_of(link))
    rows = rows.withColumn("_rule", best_rule(F.col("host"), F.col("path"), rules))
    links = stored(host_links(rows, "host", body))
    trust = host_trust(rows.select("host", F.col("_rule")["verdict"].alias("verdict")), links)
    ruled = F.col("blocked") >= F.lit(BLOCK_SHARE) * F.col("pages")
    brought = F.col("distrust") - F.col("blocked") >= F.lit(LINK_SHARE) * F.col("pages")
    bad = (F.col("distrust") > F.col("trust")) & (ruled | brought)
    bad = stored(trust.filter(bad).select(F.col("host").alias("_bad")))
    rows = rows.join(with_size_hint(bad, bad.count(), 128), F.col("host") == F.col("_bad"), "left")
    verdict = F.coalesce(F.col("_rule")["verdict"], F.when(F.col("_bad").isNotNull(), "block").otherwise("allow"))
    kept = [F.col(n).alias(c) for n, c in zip(names, pages.columns) if c not in ("host", "path", "rule", "verdict")]
    return rows.select(*kept, "host", "path", F.col("_rule")["name"].alias("rule"), verdict.alias("verdict"))

"""URL filter: rules for hosts and paths, then trust and distrust over the link graph of hosts.

Rules decide the urls they fit.  The share of a host's urls that rules allow is
its trust seed, the share that they block its distrust seed.  Trust spreads
along links by personalised PageRank from the trusted seeds; distrust spreads
against them, from a blocked host to the hosts that link to it.

That mass is divided among linkers and leaves its seeds, so it ranks hosts but
does not judge them.  A url without a rule is judged by shares between 0 and 1:
where a surfer stops who stays at a host with the share of its urls that rules
decide, and else follows one of its links (distrust) or goes back along one that
leads to it (trust).  It is blocked if the distrusted share exceeds the trusted
one by a margin.  Links within a host say nothing of it and are left out.

Mass is not scaled to one, so a host without links keeps exactly its seeds.
Links are counted per pair of hosts where the pages are read; each round is a
join and a partial sum over those pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.util import broadcast_if_small, shared_folder, stored, table


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains and paths with a prefix."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
DAMPING = 0.85
#: Distrusted less trusted share from which on a host is blocked.
MARGIN = 0.5
ROUNDS = 60
#: Rounds end when the change in a round is below this share of the seeds.
TOLERANCE = 1e-9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path; both are empty for null or without ``://``."""
    after = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits as (rule, verdict), or null; of equal lengths a block, then by text."""
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        pair = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        chosen = F.when(fits, pair).otherwise(chosen)
    return chosen


def judged_by_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, html, host, path, rule, rule_verdict) of every row."""
    host, path = split_url(F.col("url"))
    parts = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"),
        host.alias("host"), path.alias("path"),
    )
    matched = matching_rule(F.col("host"), F.col("path"), rules)
    return parts.withColumn("_m", matched).select(
        "page_id", "html", "host", "path", F.col("_m.rule").alias("rule"), F.col("_m.verdict").alias("rule_verdict")
    )


def host_links(judged: DataFrame) -> DataFrame:
    """(src, dst, links): how often pages of one host link to another; relative links stay on the host.

    Links are ``href`` and ``src`` values with or without quotes.  Values with
    another scheme, such as mail addresses, are no links.
    """
    values = F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(r"""(?i)\s(?:href|src)\s*=\s*["']?\s*([^"'\s>]+)""")
    )
    link = F.col("link")
    absolute = F.regexp_extract(link, r"^(?i:https?:)?//([^/?#\s]*)", 1)
    other = F.regexp_like(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")) & (absolute == "")
    target = F.when(absolute != "", F.translate(absolute, UPPER, LOWER)).when(~other, F.col("host"))
    return (
        judged.where("host <> ''").select("host", F.explode(values).alias("link"))
        .select(F.col("host").alias("src"), target.alias("dst"))
        .where("dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("links"))
    )


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from (host, trust_seed, distrust_seed) and (src, dst, links).

    Both are PageRank with a restart at the seeds: trust over links, distrust
    over reversed links.  The mass of a host without links in the wanted direction restarts.
    Hosts that are only linked to take part with seeds of zero.
    """
    spark = seeds.sparkSession
    folder = shared_folder(spark, "hosts")
    out = links.groupBy("src").agg(F.sum("links").alias("n"))
    into = links.groupBy("dst").agg(F.sum("links").alias("n"))
    forward = links.join(out, "src").select(
        F.col("src").alias("from"), F.col("dst").alias("host"), (F.col("links") / F.col("n")).alias("t"), F.lit(0.0).alias("d")
    )
    backward = links.join(into, "dst").select(
        F.col("dst").alias("from"), F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("links") / F.col("n")).alias("d")
    )
    # one edge table for both directions: a host passes on trust by t and distrust by d
    steps = forward.unionByName(backward).groupBy("from", "host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
    steps = stored(steps, folder, "steps")
    nodes = seeds.unionByName(
        steps.select("host", F.lit(0.0).alias("trust_seed"), F.lit(0.0).alias("distrust_seed")).distinct()
    ).groupBy("host").agg(F.sum("trust_seed").alias("trust_seed"), F.sum("distrust_seed").alias("distrust_seed"))
    ends = steps.groupBy(F.col("from").alias("host")).agg((F.sum("t") > 0).alias("passes_t"), (F.sum("d") > 0).alias("passes_d"))
    nodes = stored(
        nodes.join(ends, "host", "left").select(
            "host", "trust_seed", "distrust_seed",
            F.coalesce("passes_t", F.lit(False)).alias("passes_t"), F.coalesce("passes_d", F.lit(False)).alias("passes_d"),
        ),
        folder, "nodes",
    )
    mass = nodes.agg(F.sum("trust_seed"), F.sum("distrust_seed")).first()
    trust_mass, distrust_mass = (float(m or 0.0) for m in mass)
    state = stored(nodes.withColumn("trust", F.col("trust_seed")).withColumn("distrust", F.col("distrust_seed")), folder, "round-0")
    for number in range(1, rounds + 1):
        lost = state.agg(
            F.sum(F.when(~F.col("passes_t"), F.col("trust"))), F.sum(F.when(~F.col("passes_d"), F.col("distrust")))
        ).first()
        lost_t, lost_d = (float(x or 0.0) for x in lost)
        arrived = (
            steps.join(state.select(F.col("host").alias("from"), "trust", "distrust"), "from")
            .groupBy("host").agg(F.sum(F.col("trust") * F.col("t")).alias("in_t"), F.sum(F.col("distrust") * F.col("d")).alias("in_d"))
        )
        again_t = 1 - damping + damping * (lost_t / trust_mass if trust_mass else 0.0)
        again_d = 1 - damping + damping * (lost_d / distrust_mass if distrust_mass else 0.0)
        new = state.join(arrived, "host", "left").select(
            "host", "trust_seed", "distrust_seed", "passes_t", "passes_d",
            (F.col("trust_seed") * again_t + damping * F.coalesce("in_t", F.lit(0.0))).alias("trust"),
            (F.col("distrust_seed") * again_d + damping * F.coalesce("in_d", F.lit(0.0))).alias("distrust"),
            (F.abs(F.col("trust_seed") * again_t + damping * F.coalesce("in_t", F.lit(0.0)) - F.col("trust"))
             + F.abs(F.col("distrust_seed") * again_d + damping * F.coalesce("in_d", F.lit(0.0)) - F.col("distrust"))).alias("change"),
        )
        new = stored(new, folder, f"round-{number}")
        change = float(new.agg(F.sum("change")).first()[0] or 0.0)
        state = new.drop("change")
        if change <= TOLERANCE * max(trust_mass + distrust_mass, 1e-300):
            break
    return state.select("host", "trust", "distrust")


def judged_shares(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, good, bad) from (host, trust_seed, distrust_seed) and (src, dst, links).

    ``bad`` is a host's own distrust seed, and for the share of it that no seed
    decides, the damped mean of ``bad`` over its outgoing links.  ``good`` is the
    same with trust over its incoming links.  Neither depends on how many others
    link to the same host, and no host falls below its own seed.
    """
    folder = shared_folder(seeds.sparkSession, "shares")
    out = links.groupBy("src").agg(F.sum("links").alias("n"))
    into = links.groupBy("dst").agg(F.sum("links").alias("n"))
    follow = links.join(out, "src").select(
        F.col("dst").alias("from"), F.col("src").alias("host"), F.lit(0.0).alias("g"), (F.col("links") / F.col("n")).alias("b")
    )
    back = links.join(into, "dst").select(
        F.col("src").alias("from"), F.col("dst").alias("host"), (F.col("links") / F.col("n")).alias("g"), F.lit(0.0).alias("b")
    )
    steps = follow.unionByName(back).groupBy("from", "host").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))
    steps = stored(steps, folder, "steps")
    nodes = seeds.unionByName(
        steps.select("host", F.lit(0.0).alias("trust_seed"), F.lit(0.0).alias("distrust_seed")).distinct()
    ).groupBy("host").agg(F.sum("trust_seed").alias("trust_seed"), F.sum("distrust_seed").alias("distrust_seed"))
    state = nodes.withColumn("good", F.col("trust_seed")).withColumn("bad", F.col("distrust_seed"))
    state = stored(state, folder, "round-0")
    undecided = damping * F.greatest(F.lit(0.0), 1 - F.col("trust_seed") - F.col("distrust_seed"))
    for number in range(1, rounds + 1):
        arrived = (
            steps.join(state.select(F.col("host").alias("from"), "good", "bad"), "from")
            .groupBy("host").agg(F.sum(F.col("good") * F.col("g")).alias("in_g"), F.sum(F.col("bad") * F.col("b")).alias("in_b"))
        )
        good = F.col("trust_seed") + undecided * F.coalesce("in_g", F.lit(0.0))
        bad = F.col("distrust_seed") + undecided * F.coalesce("in_b", F.lit(0.0))
        new = state.join(arrived, "host", "left").select(
            "host", "trust_seed", "distrust_seed", good.alias("good"), bad.alias("bad"),
            F.greatest(F.abs(good - F.col("good")), F.abs(bad - F.col("bad"))).alias("change"),
        )
        new = stored(new, folder, f"round-{number}")
        change = float(new.agg(F.max("change")).first()[0] or 0.0)
        state = new.drop("change")
        if change <= TOLERANCE:
            break
    return state.select("host", "good", "bad")


def filter_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    margin: float = MARGIN,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row.

    ``trust`` and ``distrust`` are the host's PageRank masses; ``margin`` is for the shares of judged_shares().
    A null url, or one without ``://``, has an empty host: no rule fits, it takes no part in the graph, and
    it is allowed with trust and distrust of zero.  A null html has no links;
    repeated rows count as often as they come; an empty table gives no rows;
    other columns are ignored.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "urls")
    judged = judged_by_rules(pages, rules)
    share = lambda v: F.avg(F.when(F.col("rule_verdict") == v, 1.0).otherwise(0.0))
    seeds = stored(
        judged.where("host <> ''").groupBy("host").agg(share("allow").alias("trust_seed"), share("block").alias("distrust_seed")),
        folder, "seeds",
    )
    links = stored(host_links(judged).where("src <> dst"), folder, "links")
    ranks = propagate(seeds, links, damping, rounds)
    scores = stored(ranks.join(judged_shares(seeds, links, damping, rounds), "host"), folder, "scores")
    method = F.when(F.col("bad") - F.col("good") >= margin, "block").otherwise("allow")
    return judged.drop("html").join(broadcast_if_small(scores), "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))

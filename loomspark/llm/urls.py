"""URL filters: rules by host and path, and trust and distrust propagated over links between hosts.

Rules decide where one fits: its host or a subdomain of it, and a path that starts with the rule's;
the longest rule wins. For other urls the host is judged. Hosts of whose pages more are allowed than
blocked by rules are trusted seeds; hosts with more than half of their pages blocked are blocked
seeds. So are hosts that are linked to but own no page, if rules decide all their urls alike. Trust is
a personalised PageRank from trusted seeds along links between hosts, distrust one from blocked seeds
against the links (who links to the blocked is distrusted). A host passes its rank on in proportion
to its number of links; what a host without links holds goes back to the seeds. Ranks are in units of
one seed. A host is blocked if its distrust is at least MIN_SCORE of a seed, and if its share of all
distrust is above its share of all trust: neither depends on how many seeds a corpus has. Ranks grow
from below until all that is still to move, over all hosts, is at most TOLERANCE of a seed.

Rank that goes back to the seeds adds to every seed alike, so it makes the same ranks larger by one
factor: propagation leaves it out, and the ranks of a kind are scaled to as many as it has seeds.

Only DataFrame functions are used. Links are counted by host before they meet any rank, both
propagations run in one loop, sums are combined on the map side, and joins are ones that adaptive
execution splits when a host is hot. Blocked hosts are counted; while they are few they go to the
pages, which then need no shuffle. Lineage is cut every CUT_EVERY rounds. Rules are few and
compiled into one expression; MAX_RULES bounds them.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule and is
allowed; null html has no links; links within a host and relative links move nothing; repeated rows
are repeated in the result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import cut, sent_if_small

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MAX_RULES = 500
DAMPING = 0.85
CUT_EVERY = 4
MIN_SCORE = 1e-3
TOLERANCE = MIN_SCORE / 100
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    which = verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        which, verdict = F.when(fits, F.lit(rule)).otherwise(which), F.when(fits, F.lit(kind)).otherwise(verdict)
    return which, verdict


def rule_of_all(host: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The verdict that rules give to every url of a host, whatever its path; null if there is none."""
    verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = (host == name) | host.endswith(f".{name}")
        # A longer rule for some paths leaves the verdict of all as it is, or takes it away.
        verdict = F.when(fits if not rest else fits & (verdict != kind), F.lit(None if rest else kind)).otherwise(verdict)
    return verdict


def links(pages: DataFrame) -> DataFrame:
    """src, dst and n, the number of links between two different hosts, from pages (host, html)."""
    found = pages.where(F.contains("html", F.lit("//"))).select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
    found = found.select("src", F.translate("dst", string.ascii_uppercase, string.ascii_lowercase).alias("dst"))
    return found.where((F.col("src") != F.col("dst")) & (F.col("src") != "")).groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """kind, host, settled rank, from edges (kind, src, dst, part) and seeds (kind, host, seed).

    A round adds at most damping times what the one before it added, so CUT_EVERY rounds that added
    some leave no more than rest times that for all rounds to come, whichever host it goes to.
    """
    total = lambda ranks: ranks.agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
    rest = damping**CUT_EVERY / (1 - damping**CUT_EVERY)
    start = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))
    ranks, before, left = start, total(start), float("inf")
    while left > tolerance:
        for _ in range(CUT_EVERY):
            moved = edges.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("part") * damping).alias("rank"))
            ranks = start.union(moved).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = cut(ranks)
        now = total(ranks)
        before, left = now, (now - before) * rest
    return ranks


def host_scores(pages: DataFrame, tolerance: float = TOLERANCE, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """host, distrust (in units of one seed), and the shares of all trust and distrust of the hosts that any reaches.

    pages has host, html and verdict (the rules').
    """
    counted = pages.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked"), F.count("*").alias("n")
    )
    kind = F.when(F.col("allowed") > F.col("blocked"), "trust").when(2 * F.col("blocked") > F.col("n"), "distrust")
    there = cut(links(pages))
    target = there.select(F.col("dst").alias("host"), F.replace(F.replace(rule_of_all(F.col("dst"), rules), F.lit("allow"), F.lit("trust")), F.lit("block"), F.lit("distrust")).alias("kind"))
    unseen = target.where("kind is not null").distinct().join(counted.select("host"), "host", "left_anti")
    seeds = counted.select(kind.alias("kind"), "host").where("kind is not null").union(unseen.select("kind", "host"))
    seeds = cut(seeds.withColumn("seed", F.lit(1.0)))
    both = there.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(there.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    both = cut(both)
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("of"))
    edges = cut(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("of")).alias("part")))
    # Scaling makes ranks larger by 1 / (1 - damping) at most, and what is still to move with them.
    ranks = propagate(edges, seeds, tolerance * (1 - DAMPING))
    # One row for each of the two kinds.
    n = F.broadcast(seeds.groupBy("kind").agg(F.count("*").alias("n")).join(ranks.groupBy("kind").agg(F.sum("rank").alias("mass")), "kind"))
    total = lambda k, c: F.coalesce(F.sum(F.when(F.col("kind") == k, c)), F.lit(0.0))
    share = F.col("rank") / F.col("mass")
    return ranks.join(n, "kind").groupBy("host").agg(
        total("distrust", share * F.col("n")).alias("distrust"), total("trust", share).alias("trust_share"), total("distrust", share).alias("distrust_share")
    )


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, tolerance: float = TOLERANCE, min_score: float = MIN_SCORE) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of pages (page_id, url, html)."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.withColumn("rule", rule).withColumn("verdict", verdict)
    scores = host_scores(parts, tolerance, rules)
    bad = scores.where((F.col("distrust") >= min_score) & (F.col("distrust_share") > F.col("trust_share"))).select("host", F.lit("block").alias("host_verdict"))
    joined = parts.drop("html").join(sent_if_small(bad), "host", "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("verdict", "host_verdict", F.lit("allow")).alias("verdict"))

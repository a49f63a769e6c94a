"""URL filter: rules by host and path, and link-graph propagation for the rest.

A rule (``block net/``) names a host and a path prefix.  It fits its host and
all subdomains of it if the URL's path begins with the rule's; the longest
fitting rule decides.

Pages that no rule fits are judged by their host.  Hosts form a graph: a host
has an edge to each host that its pages link to (absolute and ``//`` links in
``href`` and ``src``; relative links stay on the host), weighted by the number
of links, and one to and from its parent domain, weighted ``PARENT_WEIGHT``,
since names under one domain have one owner.  Trust is personalised PageRank
along the edges from the hosts of pages that a rule allows; distrust is the
same against the edges from the hosts of pages that a rule blocks, so whoever
links to blocked hosts receives it.  Seeds weigh by their pages.  A host is
blocked where distrust / (trust + distrust) is above ``BLOCK_ABOVE`` and its
distrust above what an even spread of seeds would give each host by itself;
hosts that neither reaches are allowed.

After k steps a score is off by at most DAMPING^k times the largest share of a
host's neighbours that flows into it: all the mass that is still to move at a
step is DAMPING^k, and no more than that share of it can arrive.  So each
host's error is known, and the iteration ends as soon as no host's verdict can
change any more; where scores are too close to be told apart, it ends where
every error is below ``TOLERANCE`` of the even spread of one host.  A
comparison that is closer than that may fall on either side.

Pages are parsed once, into a stored table of hosts, rules and linked hosts.
Links are counted per pair of hosts within each task before any shuffle, and
only the host graph is iterated: ``STEPS_AT_ONCE`` steps are one plan, in which
the edges are shuffled once and each step adds one aggregate whose result
stays partitioned for the next join.  The scores are written after each such
plan and the ones before removed.

A null URL, or one without ``://``, has an empty host and path and fits no
rule; it is allowed.  Null html has no links.  Repeated rows count as pages
each.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import UPPER, broadcast_if_small, materialized, removed

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
DAMPING = 0.85
#: Error that a score may keep, as a share of what an even spread of seeds gives each host.
TOLERANCE = 0.01
#: Steps in one plan, between two stored tables of scores.
STEPS_AT_ONCE = 8
PARENT_WEIGHT = 0.5
BLOCK_ABOVE = 0.5
#: Hosts (some 100 bytes each) up to this number are broadcast to the pages.
MAX_BROADCAST_HOSTS = 100_000


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(name of the longest fitting rule, its verdict); nulls where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, by_rule, linked (the hosts of links, as they are written)."""
    links = F.regexp_extract_all(
        F.coalesce("html", F.lit("")),
        F.lit(r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""), F.lit(1))
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                         links.alias("linked"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return parts.select("page_id", "host", "path", name.alias("rule"), verdict.alias("by_rule"), "linked")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts: links, and parent domains both ways."""
    return edges_of(judged(pages))


def edges_of(rows: DataFrame) -> DataFrame:
    """``host_edges`` from pages that are judged already."""
    links = rows.select(F.col("host").alias("src"), F.explode("linked").alias("dst"))
    links = links.select("src", F.translate("dst", UPPER, UPPER.lower()).alias("dst"))
    links = links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(
        F.count(F.lit(1)).cast("double").alias("weight"))
    hosts = rows.select("host").where("host <> ''").distinct()
    hosts = hosts.unionByName(links.select(F.col("dst").alias("host"))).distinct()
    # Each name above the host that still has a dot: a.b.example.com, b.example.com, example.com.
    labels = F.split("host", r"\.")
    up = hosts.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda k: F.struct(F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("child"),
                           F.array_join(F.slice(labels, k + 1, F.size(labels)), ".").alias("parent")))).alias("e"))
    up = up.select("e.*").where("parent like '%.%'").distinct()
    tree = up.select(F.col("child").alias("src"), F.col("parent").alias("dst")).unionByName(
        up.select(F.col("parent").alias("src"), F.col("child").alias("dst"))).withColumn("weight", F.lit(PARENT_WEIGHT))
    return links.unionByName(tree).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def seed_mass(rows: DataFrame) -> DataFrame:
    """(side, host, mass): hosts of the pages that a rule decided, by pages; each side adds up to 1."""
    own = materialized(rows.where("by_rule is not null and host <> ''").groupBy(
        F.when(F.col("by_rule") == "allow", "trust").otherwise("distrust").alias("side"), "host").agg(
        F.count(F.lit(1)).cast("double").alias("pages")), "host-seeds")
    whole = own.groupBy("side").agg(F.sum("pages").alias("whole"))  # two rows
    return materialized(own.join(F.broadcast(whole), "side").select(
        "side", "host", (F.col("pages") / F.col("whole")).alias("mass")), "host-seeds")


def advanced(share: DataFrame, seeds: DataFrame, scores: DataFrame, steps: int, damping: float) -> DataFrame:
    """``scores`` after ``steps`` more steps, as one plan."""
    restart = seeds.select("side", "host", (F.col("mass") * (1.0 - damping)).alias("x"))
    for _ in range(steps):
        moved = share.join(scores, ["side", "host"]).select(
            "side", F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("x"))
        scores = moved.unionByName(restart).groupBy("side", "host").agg(F.sum("x").alias("score"))
    return scores


def shares(edges: DataFrame) -> DataFrame:
    """(side, host, dst, share): what part of a host's mass each of its edges takes; stored."""
    out = edges.groupBy("side", "src").agg(F.sum("weight").alias("whole"))
    return materialized(edges.join(out, ["side", "src"]).select(
        "side", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("whole")).alias("share")), "host-shares")


def pagerank(edges: DataFrame, seeds: DataFrame, steps: int | None = None, damping: float = DAMPING,
             error: float = 1e-6, settled: Callable[[DataFrame, int], bool] | None = None) -> DataFrame:
    """(side, host, score): personalised PageRank of ``seeds(side, host, mass)`` over ``edges(side, src, dst, weight)``.

    All sides advance together, for exactly ``steps`` steps where given, else until no score is off by more than ``error``
    or ``settled(scores, steps done)`` says so.  Mass at a host without outgoing edges ends there.
    """
    share = shares(edges)
    scores = seeds.select("side", "host", F.col("mass").alias("score"))
    # After k steps the scores of a side differ from the final ones by damping^k in sum at most.
    most = steps if steps is not None else max(1, math.ceil(math.log(max(error, 1e-15)) / math.log(damping)))
    done, before = 0, None
    while done < most:
        k = min(STEPS_AT_ONCE, most - done)
        scores = materialized(advanced(share, seeds, scores, k, damping), "host-scores")
        done += k
        if before is not None:
            removed(before)
        before = scores
        if steps is None and settled is not None and settled(scores, done):
            break
    return scores


def side_by_side(scores: DataFrame) -> DataFrame:
    """(host, trust, distrust) from scores by side."""
    return scores.groupBy("host").agg(*[
        F.coalesce(F.sum(F.when(F.col("side") == s, F.col("score"))), F.lit(0.0)).alias(s)
        for s in ("trust", "distrust")])


def scored_hosts(rows: DataFrame, steps: int | None = None, block_above: float = BLOCK_ABOVE) -> DataFrame:
    """(host, trust, distrust, even) of every host of the judged ``rows`` that either side has reached."""
    edges = materialized(edges_of(rows), "host-edges")
    sides = materialized(edges.withColumn("side", F.lit("trust")).unionByName(edges.select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", F.lit("distrust").alias("side"))), "host-sides")
    hosts = rows.select("host").distinct().count()
    even = (1.0 - DAMPING) / max(hosts, 1)
    out = sides.groupBy("side", "src").agg(F.sum("weight").alias("whole"))
    inflow = materialized(sides.join(out, ["side", "src"]).groupBy(F.col("dst").alias("host")).agg(
        F.max(F.col("weight") / F.col("whole")).alias("most")), "host-inflow")

    def settled(scores: DataFrame, done: int) -> bool:
        # A seed without edges into it keeps its own restart mass, which is exact.
        off = F.lit(DAMPING ** done) * F.coalesce("most", F.lit(0.0))
        keep, part = 1.0 - block_above, block_above
        lead = keep * F.col("distrust") - part * F.col("trust")  # blocked where it and distrust - even are above 0
        blocked = (lead - off > 0) & (F.col("distrust") - off > even)
        allowed = (lead + off <= 0) | (F.col("distrust") + off <= even)
        return side_by_side(scores).join(inflow, "host", "left").where(~(blocked | allowed)).isEmpty()

    scores = pagerank(sides, seed_mass(rows), steps, error=TOLERANCE * even, settled=settled)
    return side_by_side(scores).withColumn("even", F.lit(even))


def host_scores(pages: DataFrame, rules=RULES, steps: int | None = None) -> DataFrame:
    """(host, trust, distrust, even) of every host that either has reached; even is a host's part of evenly spread seeds."""
    return scored_hosts(materialized(judged(pages, rules), "judged-pages"), steps)


def url_verdicts(pages: DataFrame, rules=RULES, steps: int | None = None, block_above: float = BLOCK_ABOVE) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust per page."""
    pages = materialized(judged(pages, rules), "judged-pages")
    scores = materialized(scored_hosts(pages, steps, block_above).withColumnRenamed("host", "known_host"), "host-verdicts")
    rows = pages.join(broadcast_if_small(scores, MAX_BROADCAST_HOSTS), F.col("host") == F.col("known_host"), "left")
    blocked = F.coalesce((F.col("distrust") > block_above * (F.col("trust") + F.col("distrust")))
                         & (F.col("distrust") > F.col("even")), F.lit(False))
    return rows.select("page_id", "host", "path", "rule",
                       F.coalesce("by_rule", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
                       F.coalesce("trust", F.lit(0.0)).alias("trust"),
                       F.coalesce("distrust", F.lit(0.0)).alias("distrust"))

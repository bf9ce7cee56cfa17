"""URL filters: host rules, and trust and distrust spread over the host graph, without Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, stored

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Absolute and scheme-less links in a page.
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^\s/?#"'<>]+)"""
#: Labels of a registered name: hosts below one (www.a.example.com) are tied to it (a.example.com), names up to it are not.
REGISTERED = 3
#: Characters of a host name; what is longer is none and tied to nothing.
LONGEST = 253
#: Rounds of one job, between two written states.
ROUNDS = 8
#: Links and hosts that a task passes on in a round: a round leaves files for every task, however few rows it has.
ROWS_PER_TASK = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://`` with A-Z lower-cased; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits host (or a parent domain) and path; else null.

    Longest: by host, then by path.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0]), len(r[1]))):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, registered: int | None = REGISTERED) -> DataFrame:
    """``src, dst, weight``: links between different hosts, counted; and each host with its parent domains, weight 1 per level.

    ``pages`` has host and html. Links are combined before the shuffle; a host is tied, both ways, to its parent domains
    of ``registered`` labels or more, so that mirrors of one site share evidence. None: only links count.
    """
    links = (
        pages.where("host != ''")
        .select(F.col("host").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("dst"))
        .select("src", F.translate("dst", _UPPER, _LOWER).alias("dst"))
        .where("src != dst and dst != ''")
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    )
    if registered is None:
        return links
    # Below a registered name only: www.a.example.com and a.example.com belong together, a.example.com and b.example.com do not.
    known = links.select(F.col("src").alias("h")).union(links.select("dst")).union(pages.where("host != ''").select("host")).distinct()
    labels = F.split("h", r"\.")
    up = known.where((F.size(labels) > registered) & (F.length("h") <= LONGEST)).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels) - 1),
                lambda k: F.struct(
                    F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("a"),
                    F.array_join(F.slice(labels, k + 1, F.size(labels)), ".").alias("b"),
                ),
            )
        ).alias("x")
    ).select("x.*").where(F.size(F.split("b", r"\.")) >= registered).distinct()
    tree = up.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(up.select("b", "a"))
    return links.union(tree.withColumn("weight", F.lit(1.0))).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-9) -> DataFrame:
    """``side, host, rank``: personalised PageRank from ``seeds`` (side, host, mass) along ``edges`` (side, src, dst, weight), all sides at once.

    A row holds a host's rank so far and the change of the last round. A round passes on ``damping`` of the changes along the
    edges and keeps the ranks, by one join whose edges hold a loop for every host; hosts without a change pass on nothing.
    It ends when what all further rounds could add, on any side, is at most ``tolerance``; ``rounds`` sets a
    number instead. Changes shrink by ``damping`` every round, so this ends whatever the graph. The state is a
    written table every few rounds: a join and a sum a round, and one shuffle of the edges for each written table. A round
    runs in as many tasks as it has ``ROWS_PER_TASK`` links, at most one a shuffle partition.
    Hubs are joined by equi joins that adaptive execution splits; in-links are summed before the shuffle. What
    hosts without outgoing edges hold returns to the seeds by normalising at the end. Hosts no seed reaches are absent.
    """
    out = edges.groupBy("side", "src").agg(F.sum("weight").alias("all"))
    links = edges.join(out, ["side", "src"]).select("side", "src", "dst", (F.col("weight") / F.col("all") * damping).alias("share"))
    loops = edges.select("side", F.col("src").alias("h")).union(edges.select("side", "dst")).union(seeds.where("mass > 0").select("side", "host")).distinct()
    share = stored(links.union(loops.select("side", "h", "h", F.lit(None).cast("double"))), "host-links")
    tasks = 1 + share.count() // ROWS_PER_TASK
    total = seeds.groupBy("side").agg(F.sum("mass").alias("total"))
    given = seeds.where("mass > 0").groupBy("side", "host").agg(F.sum("mass").alias("mass")).join(total, "side")
    state = stored(given.select("side", "host", F.lit(0.0).alias("rank"), (F.col("mass") / F.col("total") * (1 - damping)).alias("change")), "host-ranks")
    done = 0
    while done != rounds:
        for _ in range(ROUNDS if rounds is None else min(ROUNDS, rounds - done)):
            done += 1
            keep = F.col("share").isNull()
            moved = state.join(share.hint("merge").withColumnRenamed("src", "host"), ["side", "host"]).where(keep | (F.col("change") > 0)).select(
                "side", F.col("dst").alias("host"),
                F.when(keep, F.col("rank") + F.col("change")).otherwise(0.0).alias("rank"), F.when(keep, 0.0).otherwise(F.col("change") * F.col("share")).alias("change"),
            )
            state = moved.coalesce(tasks).groupBy("side", "host").agg(F.sum("rank").alias("rank"), F.sum("change").alias("change"))
        state = stored(state.coalesce(tasks), "host-ranks")
        left = state.groupBy("side").agg(F.sum("change").alias("left")).agg(F.max("left")).first()[0] or 0.0
        if rounds is None and left / (1 - damping) <= tolerance:
            break
    ranks = state.select("side", "host", (F.col("rank") + F.col("change") / (1 - damping)).alias("rank"))
    whole = ranks.groupBy("side").agg(F.sum("rank").alias("whole"))
    return ranks.join(whole, "side").select("side", "host", (F.col("rank") / F.col("whole")).alias("rank"))


def pagerank(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-9) -> DataFrame:
    """``host, rank`` for one side: ``seeds`` (host, mass) along ``edges`` (src, dst, weight); see ``spread``. Without seeds: no rows."""
    one = F.lit(0).alias("side")
    return spread(edges.select(one, "src", "dst", "weight"), seeds.select(one, "host", "mass"), damping, rounds, tolerance).select("host", "rank")


def judge_urls(
    pages: DataFrame, rules=RULES, threshold: float = 0.5, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-4, registered: int | None = REGISTERED
) -> DataFrame:
    """Adds ``host, path, rule, verdict, bad_share, good_share``; every row and column is kept.

    A rule that fits decides. Elsewhere the host does: pages that rules allow are trusted seeds, pages they block
    are blocked seeds, each with the number of its pages. Trust follows links, distrust runs against them. A rank times
    the seeds' mass over the host's pages is the share of the host's pages held good or bad; a host is blocked if
    its bad share is above ``threshold`` and above its good share. Hosts without evidence are allowed. Ranks are iterated
    until no share can be off by more than ``tolerance``, whatever the number of seed pages.

    Null urls and urls without ``://`` have empty host and path, no rule and are allowed. Null html has no links.
    Repeated rows get equal answers and count as often. An empty table gives an empty one. Columns that are named
    like the new ones are replaced.
    """
    new = ("host", "path", "rule", "verdict", "bad_share", "good_share")
    kept = [c for c in pages.columns if c.lower() not in new]
    host, path = url_parts(F.col("url"))
    parts = pages.select(*kept, host.alias("host"), path.alias("path"))
    found = free_name([*kept, *new], "_found")
    ruled = parts.withColumn(found, rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.col(f"{found}.verdict")
    hosts = stored(
        ruled.where("host != ''").groupBy("host").agg(
            F.count("*").alias("pages"),
            F.sum(F.when(verdict == "allow", 1.0).otherwise(0.0)).alias("good"),
            F.sum(F.when(verdict == "block", 1.0).otherwise(0.0)).alias("bad"),
        ),
        "hosts",
    )
    edges = stored(host_edges(parts.select("host", F.coalesce("html", F.lit("")).alias("html")), registered), "host-edges")
    both = edges.select(F.lit(0).alias("side"), "src", "dst", "weight").union(edges.select(F.lit(1), "dst", "src", "weight"))
    seeds = hosts.select(F.lit(0).alias("side"), "host", F.col("good").alias("mass")).union(hosts.select(F.lit(1), "host", "bad"))
    mass = hosts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()  # two numbers
    # Ranks are divided by their sum, 1 - damping at least, and multiplied by the mass. Below 1e-14 rounding has its say.
    tolerance = max(tolerance * (1 - damping) / (2 * max(1.0, *[x or 0.0 for x in mass])), 1e-14)
    ranks = spread(both, seeds, damping, rounds, tolerance)
    sides = ranks.groupBy("host").agg(*[F.sum(F.when(F.col("side") == n, F.col("rank"))).alias(x) for n, x in ((0, "g"), (1, "b"))])
    scores = hosts.join(sides, "host", "left").select(
        F.col("host").alias("_host"),
        F.coalesce(F.col("g") * F.lit(mass["good"]) / F.col("pages"), F.lit(0.0)).alias("good_share"),
        F.coalesce(F.col("b") * F.lit(mass["bad"]) / F.col("pages"), F.lit(0.0)).alias("bad_share"),
    )
    worse = (F.col("bad_share") > threshold) & (F.col("bad_share") > F.col("good_share"))
    scores = scores.select("_host", "good_share", "bad_share", F.when(worse, "block").otherwise("allow").alias("_own"))
    scores = scores.select(F.struct(*scores.columns).alias((held := free_name([*kept, *new, found], "_held"))))
    joined = ruled.join(scores, ruled["host"] == F.col(f"{held}._host"), "left")
    return joined.select(
        *kept, "host", "path", F.col(f"{found}.rule").alias("rule"),
        F.coalesce(verdict, F.col(f"{held}._own"), F.lit("allow")).alias("verdict"),
        F.coalesce(F.col(f"{held}.bad_share"), F.lit(0.0)).alias("bad_share"), F.coalesce(F.col(f"{held}.good_share"), F.lit(0.0)).alias("good_share"),
    )

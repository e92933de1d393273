"""URL filters: allow and block rules, and trust and distrust propagated over links between hosts.

Pages that a rule allows make their host a trusted seed, pages that a rule blocks a blocked one. Trust
runs along links by personalised PageRank from the trusted seeds, distrust against them from the
blocked seeds (who links to a blocked host is suspect). A host's threshold decides its other pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import Stored, join_counted, stored
from playmart.session import small_table

DAMPING = 0.85
# What all scores together still move falls by the damping every round: this many settle 10**10 hosts.
ROUNDS = 200
# Rounds end when no host's score moves by more than this.
STILL = 1e-3
# A host is blocked if its distrust reaches this and exceeds its trust: what a host gets that links to
# a blocked host alone (damping * (1 - damping)) is just enough.
THRESHOLD = 0.1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def host_of(url: Column) -> Column:
    """Behind the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def host_rules(hosts: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """host and rules: those that fit it or a domain above it, longest first.

    `rules`: (verdict, "host/path") pairs, or a frame of verdict, rule.
    """
    if not isinstance(rules, DataFrame):
        rules = small_table(hosts.sparkSession, list(rules), "verdict string, rule string")
    table = rules.select(
        F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("suffix"), "rule", "verdict",
        F.expr("substring(rule, locate('/', rule))").alias("path"), F.char_length("rule").alias("length"))
    return (
        hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("suffix")).join(table, "suffix")
        .groupBy("host").agg(F.sort_array(F.collect_set(F.struct("length", "rule", "verdict", "path")), asc=False).alias("rules"))
    )


def judged(pages: DataFrame, ruled: DataFrame, n: int) -> DataFrame:
    """pages (with host and path) and the longest fitting rule as a struct, else null."""
    fitting = F.filter(F.col("rules"), lambda r: F.startswith(F.col("path"), r["path"]))
    return join_counted(pages, ruled, "host", "left", n).withColumn("rule", F.get(fitting, F.lit(0))).drop("rules")


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, n: links from pages of one host to another or itself, counted. Fragments don't count."""
    target = F.coalesce(F.nullif("a", F.lit("")), F.nullif("b", F.lit("")), F.nullif("c", F.lit("")))
    found = F.arrays_zip(*[F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(i)).alias(x) for i, x in enumerate("abc", 1)])
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(found).alias("link")).select("src", "link.*").select(
        "src", target.alias("to"))
    absolute = F.when(F.startswith("to", F.lit("//")), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))
    dst = F.when(absolute.rlike(r"(?i)\Ahttps?://"), host_of(absolute)).when(~absolute.rlike(r"(?i)\A([a-z][a-z0-9+.-]*:|#)"), F.col("src"))
    return (
        links.filter("src != '' and to is not null").select("src", dst.alias("dst")).filter("dst != ''")
        .groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, still: float = STILL) -> Stored:
    """host, trust, distrust of every host with a page or a link.

    seeds: host, trusted, blocked (shares from 0 to 1). A score is (1 - damping) * seed + damping *
    what flows in; a host without links in the direction of the flow keeps its score, so none is lost.
    Each round is one join and one aggregation over the edges, stored in the shared folder. They end
    when no score moves by more than `still`; scores that still move after `rounds` raise. With a
    negative `still` all rounds are run.
    """
    nodes = seeds.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    seeds = stored(
        nodes.join(seeds, "host", "left").select("host", F.coalesce("trusted", F.lit(0.0)).alias("trusted"),
                                                 F.coalesce("blocked", F.lit(0.0)).alias("blocked")), "host-seeds").rows
    ways = edges.select(F.lit(True).alias("forth"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").union(
        edges.select(F.lit(False), F.col("dst"), F.col("src"), F.col("n")))
    out = ways.groupBy("forth", "host").agg(F.sum("n").alias("all"))
    flows = ways.join(out, ["forth", "host"]).select("forth", "host", "to", (F.col("n") / F.col("all")).alias("share"))
    ends = [
        seeds.join(out.filter(F.col("forth") == forth).select("host"), "host", "left_anti")
        .select(F.lit(forth).alias("forth"), "host", F.col("host").alias("to"), F.lit(1.0).alias("share"))
        for forth in (True, False)
    ]
    flows = stored(flows.union(ends[0]).union(ends[1]), "host-flows").rows
    now = stored(seeds.select("host", F.col("trusted").alias("trust"), F.col("blocked").alias("distrust")), "host-scores")
    for _ in range(rounds):
        carried = flows.join(now.rows, "host").groupBy(F.col("to").alias("host")).agg(
            F.sum(F.when(F.col("forth"), F.col("share") * F.col("trust"))).alias("trust_in"),
            F.sum(F.when(~F.col("forth"), F.col("share") * F.col("distrust"))).alias("distrust_in"))
        moved = seeds.join(carried, "host", "left").join(now.rows, "host").select(
            "host", *[((1 - damping) * F.col(s) + damping * F.coalesce(f"{x}_in", F.lit(0.0))).alias(x)
                      for s, x in (("trusted", "trust"), ("blocked", "distrust"))],
            F.col("trust").alias("t"), F.col("distrust").alias("d"))
        new = stored(moved, "host-scores")
        step = new.rows.agg(F.max(F.greatest(F.abs(F.col("trust") - F.col("t")), F.abs(F.col("distrust") - F.col("d"))))).first()[0]
        now.drop()
        now = Stored(new.rows.select("host", "trust", "distrust"), new.path)
        if step is None or step <= still:
            return now
    if still >= 0:
        raise RuntimeError(f"scores of hosts have not settled after {rounds} rounds")
    return now


def judge_pages(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame, page_id: str = "page_id", url: str = "url",
                html: str = "html", threshold: float = THRESHOLD, **how) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page.

    verdict is the longest fitting rule's; without one it is `block` where the host's distrust reaches
    `threshold` and exceeds its trust, else `allow`. A null url or one without `://` has an empty host
    and path, no rule and no links, and is allowed. Repeated rows give repeated rows.
    """
    named = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    hosts = named.filter("host != ''").select("host").distinct()
    ruled = stored(host_rules(hosts, rules), "host-rules").rows
    n = ruled.count()
    with_rule = judged(named, ruled, n)
    share = lambda verdict: F.avg(F.when(F.col("rule.verdict") == verdict, 1.0).otherwise(0.0))
    seeds = with_rule.filter("host != ''").groupBy("host").agg(share("allow").alias("trusted"), share("block").alias("blocked"))
    edges = stored(host_links(pages, url, html), "host-links").rows
    scores = propagate(stored(seeds, "host-shares").rows, edges, **how).rows
    done = join_counted(with_rule, scores, "host", "left", scores.count())
    suspect = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return done.select(
        "page_id", "host", "path", F.col("rule.rule").alias("rule"),
        F.coalesce(F.col("rule.verdict"), F.when(suspect, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "trust", "distrust")

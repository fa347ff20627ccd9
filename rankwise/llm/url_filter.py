"""URL filters: rules first, then link-graph propagation for what they leave open.

A rule (host, path, verdict) fits its host and all subdomains when the
path starts with the rule's; the longest fitting rule wins.  Hosts most of
whose pages a rule allows (blocks) are the trusted (blocked) seeds.  Trust is
a personalised PageRank from the trusted seeds along host links; distrust is
one from the blocked seeds against the links, as who links to a blocked
host is suspect.  A page without a rule is blocked when distrust makes up
more than ``max_spam`` of the mass of its host, and allowed otherwise.

Links are counted per (host, host) before anything is shuffled by one key;
the ranks are one row per host, joined to edges by inner joins that adaptive
execution can split, and cut from their lineage by written tables every few
rounds.  Nothing but one number per round reaches the driver.

Defined cases: a null url, or one without ``://``, has an empty host and
path.  Two fitting rules of one length: the longer host wins, then block.  A
null html has no links.  Repeated rows give repeated results; an empty table
gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize
from rankwise.llm.tables import pick

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def fit_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, rule_verdict for every distinct (host, path) that a rule fits."""
    labels = F.size(F.split("rule_host", r"\."))
    known = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"),
                         F.col("verdict").alias("rule_verdict"))
    deepest = known.agg(F.max(labels)).first()[0] or 0
    parts = F.split("host", r"\.")
    n = F.size(parts)
    # only suffixes as long as some rule's host can fit
    suffix = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(max(1, deepest)))),
                         lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    fits = (places.select("host", "path").distinct()
            .withColumn("suffix", F.explode(suffix))
            .join(known, F.col("suffix") == F.col("rule_host"))
            .filter(F.col("path").startswith(F.col("rule_path"))))
    order = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"),
                     (F.col("rule_verdict") == "block").alias("b"),
                     F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"))
    best = fits.groupBy("host", "path").agg(F.max(order).alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, links between different hosts, from the absolute links of the pages."""
    target = F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(_LINK), F.lit(1))))
    return (pages.select(F.col("host").alias("src"), target.alias("dst"))
            .withColumn("dst", F.translate("dst", _UPPER, _LOWER))
            .filter((F.col("src") != F.col("dst")) & (F.col("src") != "") & (F.col("dst") != ""))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))


def propagate(hosts: DataFrame, links: DataFrame, damping: float = 0.85, rounds: int = 30,
              tolerance: float = 1e-4, cut_every: int = 5) -> DataFrame:
    """host, trust, distrust from (host, trusted, blocked) seeds of mass 1 each.

    A round adds what flows over the edges; it stops when a round moves less
    than ``tolerance`` of the seeds' mass.
    """
    out = links.groupBy("src").agg(F.sum("links").alias("total"))
    back = links.groupBy("dst").agg(F.sum("links").alias("back_total"))
    edges = materialize(
        links.join(out, "src").join(back, "dst")
        .select(F.col("src").alias("from"), F.col("dst").alias("to"), (F.col("links") / F.col("total")).alias("w"),
                F.lit(True).alias("forward"), (F.col("links") / F.col("back_total")).alias("v")), "url-links")
    # trust goes src -> dst, distrust dst -> src: one edge table with both directions
    both = edges.select("from", "to", "w", "forward").unionAll(
        edges.select(F.col("to").alias("from"), F.col("from").alias("to"), F.col("v").alias("w"), F.lit(False).alias("forward")))
    ends = both.select(F.col("to").alias("host"))
    seeds = materialize(hosts.select("host", F.col("trusted").cast("double").alias("seed_trust"),
                                     F.col("blocked").cast("double").alias("seed_distrust"))
                        .unionAll(ends.select("host", F.lit(0.0), F.lit(0.0)))
                        .groupBy("host").agg(F.max("seed_trust").alias("seed_trust"),
                                             F.max("seed_distrust").alias("seed_distrust")), "url-seeds")
    mass, ranks = seeds.agg(F.sum(F.col("seed_trust") + F.col("seed_distrust"))).first()[0] or 0.0, seeds.select(
        "host", F.col("seed_trust").alias("trust"), F.col("seed_distrust").alias("distrust"))
    if edges.isEmpty():
        return ranks
    for k in range(1, rounds + 1):
        flow = (both.join(ranks.withColumnRenamed("host", "from"), "from")
                .groupBy(F.col("to").alias("host"))
                .agg(F.sum(F.when(F.col("forward"), F.col("w") * F.col("trust"))).alias("in_trust"),
                     F.sum(F.when(~F.col("forward"), F.col("w") * F.col("distrust"))).alias("in_distrust")))
        moved = lambda seed, part: ((1 - damping) * F.col(seed)
                                    + damping * F.coalesce(F.col(part), F.lit(0.0)))
        new = seeds.join(flow, "host", "left").select(
            "host", moved("seed_trust", "in_trust").alias("trust"), moved("seed_distrust", "in_distrust").alias("distrust"))
        if k % cut_every and k < rounds:
            ranks = new
            continue
        new = materialize(new, "url-ranks")
        old = ranks.select("host", F.col("trust").alias("t0"), F.col("distrust").alias("d0"))
        change = new.join(old, "host").agg(
            F.sum(F.abs(F.col("trust") - F.col("t0")) + F.abs(F.col("distrust") - F.col("d0")))).first()[0] or 0.0
        ranks = new
        if change <= tolerance * max(mass, 1.0):
            break
    return ranks


def judge(pages: DataFrame, rules: DataFrame, seed_share: float = 0.5, max_spam: float = 0.5,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust: one row per input row."""
    located = pick(pages, page_id=id_col, url=url_col, html=html_col).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    places = located.select("page_id", "host", "path")
    ruled = places.join(fit_rules(places, rules), ["host", "path"], "left")
    share = lambda verdict: F.avg((F.coalesce(F.col("rule_verdict"), F.lit("")) == verdict).cast("double"))
    hosts = ruled.groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("banned")).select(
        "host", (F.col("allowed") - F.col("banned") > seed_share).alias("trusted"),
        (F.col("banned") - F.col("allowed") > seed_share).alias("blocked"))
    ranks = propagate(hosts, host_links(located))
    spam = F.coalesce(F.col("distrust") / F.nullif(F.col("trust") + F.col("distrust"), F.lit(0.0)), F.lit(0.0))
    verdict = F.coalesce(F.col("rule_verdict"), F.when(spam > max_spam, "block").otherwise("allow"))
    return ruled.join(ranks, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                                                    "trust", "distrust")

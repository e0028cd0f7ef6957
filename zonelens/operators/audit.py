"""Name-server apex audit: concentration of new domains per NS apex, split
into apexes a provider rule covers and those none does.

Skew: one apex may hold a large share of all delegations.  The distinct
counts run as Spark's two-stage plan (shuffle on (apex, value), then a
partial count per apex), and the five sample domains use a ranked filter
that Spark evaluates as a per-partition group limit before the shuffle, so
no task receives more than five candidates per apex from each map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonelens.functions.names import ns_apex, strip_leading_dot
from zonelens.operators.catalogue import TOPIC, pinned
from zonelens.operators.joins import BROADCAST_MAX_ROWS, broadcast_if_small
from zonelens.operators.parking import active_suffixes

WINDOW = "window_end_ms"


def ns_base(obs: DataFrame) -> DataFrame:
    b = obs.filter((F.col("k") == "ns") & F.col("s").isNotNull() & F.col("d").isNotNull())
    return b.select("d", "s", ns_apex("s").alias("ns_apex"))


def first_n_per_group(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """WIN-1: the n smallest `order` values per group, as a sorted list."""
    w = Window.partitionBy(group).orderBy(order)
    r = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return r.groupBy(group).agg(F.sort_array(F.collect_list(order)).alias("_firstn"))


def ns_audit_topk(obs: DataFrame, k: int = 500, samples: int = 5, topic: str | None = TOPIC) -> DataFrame:
    """JOB-8 / AGG-12 / TOP-1: top-K NS apexes by distinct new domains (S6),
    over the rows of one topic (registered domains; None: all).

    Distinct (apex, domain) pairs feed the domain count and the five sample
    domains; distinct (apex, host) pairs give the host count and the sample
    host (smallest name, a fixed choice for the reference's arbitrary one).
    Each pair set is shuffled on the pair, and the per-apex counts carry one
    partial row per map task and apex, so a hot apex is spread over all
    reducers.  The scans read only (k, d, s) with `k = 'ns'` pushed down.
    """
    b = ns_base(pinned(obs, topic))
    return audit_of_sets(b.select("ns_apex", "d").distinct(), b.select("ns_apex", "s").distinct(), k, samples)


def audit_of_sets(doms: DataFrame, hosts: DataFrame, k: int = 500, samples: int = 5) -> DataFrame:
    """The top-K table from the distinct (ns_apex, d) and (ns_apex, s) sets."""
    per_host = hosts.groupBy("ns_apex").agg(F.count(F.lit(1)).alias("distinct_ns_hosts"), F.min("s").alias("sample_ns_host"))
    counts = doms.groupBy("ns_apex").agg(F.count(F.lit(1)).alias("new_domains"))
    top = counts.join(per_host, "ns_apex").orderBy(F.desc("new_domains"), "ns_apex").limit(k)
    # the samples are wanted for the top apexes only; the limit itself proves their number
    names = top.select("ns_apex")
    of_top = doms.join(F.broadcast(names) if k <= BROADCAST_MAX_ROWS else names, "ns_apex", "left_semi")
    sample = first_n_per_group(of_top, "ns_apex", "d", samples).withColumnRenamed("_firstn", "sample_domains")
    return (top.join(sample, "ns_apex", "left")
            .select("ns_apex", "new_domains", "distinct_ns_hosts", "sample_ns_host", "sample_domains"))


def top_asn_per_apex(obs: DataFrame, topic: str | None = TOPIC) -> DataFrame:
    """The origin AS that hosts most domains of each name-server apex: (ns_apex, top_asn,
    asn_domains, n_asns, hosted_domains); ties to the smallest AS.

    The mode is taken in two stages: domains per (apex, AS), a count that is combined before
    its shuffle and spreads a hot apex over its ASs, then the best of an apex's counts, combined
    likewise.  A domain that two ASs host counts for both.
    """
    o = pinned(obs, topic)
    doms = ns_base(o).select("ns_apex", "d").distinct()
    hosted = o.filter((F.col("k") == "ip") & F.col("d").isNotNull() & F.col("a").isNotNull()).select("d", "a").distinct()
    per = doms.join(hosted, "d").groupBy("ns_apex", "a").agg(F.count(F.lit(1)).alias("n"))
    # the largest count first, of equal ones the smallest AS
    best = per.groupBy("ns_apex").agg(F.min(F.struct((-F.col("n")).alias("m"), "a")).alias("b"),
                                      F.count(F.lit(1)).alias("n_asns"), F.sum("n").alias("hosted_domains"))
    return best.select("ns_apex", F.col("b.a").alias("top_asn"), (-F.col("b.m")).alias("asn_domains"), "n_asns", "hosted_domains")


def surge_report(counts: DataFrame, n: int = 14, factor: float = 3.0, least: int = 5) -> DataFrame:
    """Windows in which a provider has far more domains than in its last `n` windows.

    `counts`: provider, window_end_ms, domains, gap-filled (a row per window).  The baseline is
    the median and the spread the median distance from it (as a standard deviation, 1 at
    least), so that an earlier surge does not hide the next.  `n` bounds the list a frame holds.
    """
    frame = Window.partitionBy("provider").orderBy(WINDOW).rowsBetween(-n, -1)

    def median(xs: Column) -> Column:
        s = F.sort_array(xs)
        size = F.size(xs)
        low, high = (F.element_at(s, (i / 2).cast("int") + 1) for i in (size - 1, size))
        return (low + high) / F.lit(2.0)
    x = counts.withColumn("last", F.collect_list("domains").over(frame)).filter(F.size("last") == n)
    x = x.withColumn("baseline", median(F.col("last")))
    x = x.withColumn("spread", F.greatest(F.lit(1.0), F.lit(1.4826) * median(
        F.transform("last", lambda v: F.abs(v - F.col("baseline"))))))
    surge = (F.col("domains") >= least) & (F.col("domains") > F.col("baseline") + factor * F.col("spread"))
    return x.filter(surge).select("provider", WINDOW, "domains", "baseline", "spread")


def provider_windows(obs_archive: DataFrame, suffixes: DataFrame, windows: DataFrame) -> DataFrame:
    """Distinct domains per provider and window over every window of `windows` (window_end_ms),
    those without a row as zero.  `obs_archive` carries window_end_ms."""
    from zonelens.operators.parking import match_providers, ns_rows
    hits = match_providers(ns_rows(obs_archive), suffixes)
    seen = (hits.select("provider", WINDOW, "d").distinct().groupBy("provider", WINDOW)
            .agg(F.count(F.lit(1)).alias("domains")))
    names = [r.provider for r in suffixes.select("provider").distinct().collect()]          # configuration rows
    grid = windows.select(WINDOW).distinct().withColumn("provider", F.explode(F.array(*[F.lit(p) for p in names]).cast("array<string>")))
    return (grid.join(seen, ["provider", WINDOW], "left")
            .select("provider", WINDOW, F.coalesce("domains", F.lit(0).cast("long")).alias("domains")))


def configured_apexes(providers: DataFrame) -> DataFrame:
    """Active suffixes without their leading dot ('.x.com' -> 'x.com')."""
    return active_suffixes(providers).select(strip_leading_dot("suffix").alias("ns_apex")).distinct()


def audit_unhandled(topk: DataFrame, providers: DataFrame, threshold: int = 1000, limit: int = 50) -> DataFrame:
    """JOIN-10 / PRJ-20: high-volume apexes no active provider rule covers."""
    conf = broadcast_if_small(configured_apexes(providers))
    return (topk.filter(F.col("new_domains") >= threshold).join(conf, "ns_apex", "left_anti")
            .orderBy(F.desc("new_domains"), "ns_apex").limit(limit))


def audit_configured(topk: DataFrame, providers: DataFrame, threshold: int = 1000, limit: int = 30) -> DataFrame:
    """JOIN-10 / TOP-5: high-volume apexes a rule covers (sanity check)."""
    conf = broadcast_if_small(configured_apexes(providers))
    return (topk.filter(F.col("new_domains") >= threshold).join(conf, "ns_apex", "left_semi")
            .select("ns_apex", "new_domains", "distinct_ns_hosts")
            .orderBy(F.desc("new_domains"), "ns_apex").limit(limit))


def recent(obs_archive: DataFrame, today: str, days: int = 30) -> DataFrame:
    """FN-11 / PRJ-15: the windows dated within the last `days` days before `today`.

    `date` is the archive's partition column, so this is a directory prune.
    """
    from zonelens.functions.timefmt import cutoff_date
    return obs_archive.filter(F.col("date") >= cutoff_date(today, days))

"""Measurement flattening, answer classification and the observation rollup.

Plan shape of `rollup_observations` at scale: scan -> project (codegen) ->
partial aggregate per map task (combines the 10-300 repeats of a key before
the shuffle) -> shuffle on the observation key -> final aggregate.  A key
that holds a third of all answers is combined map-side, so only one partial
row per map task reaches its reducer.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.functions.names import is_primary, strip_dots, topic_tag
from zonelens.schemas import OBS_COLUMNS

ANSWER_COLUMNS = [
    "query_type", "query_name", "timestamp", "status_code", "response_ttl", "ip4_address",
    "ip6_address", "as", "country", "ip_prefix", "ns_address", "mx_address", "mx_preference", "rtt",
]
OBS_KEY = ["k", "topic", "d", "s", "m", "q", "ip", "pr", "rc"]


def flatten_measurements(envelopes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Envelope + decoded measurement -> one row per answer, order kept in `pos`.

    Expects columns `topic` (long or short name), `partition` (0 where there is none),
    `offset` and a struct `measurement` (id, resultList).  A NULL or empty list yields no rows.
    """
    m = F.col("measurement")
    part = F.col("partition") if "partition" in envelopes.columns else F.lit(0)
    x = envelopes.select(
        topic_tag("topic").alias("topic"), part.alias("partition"), "offset", *keep, m.getField("id").alias("id"),
        F.posexplode(m.getField("resultList")).alias("pos", "r"))
    return x.select("partition", "offset", "pos", "topic", *keep, "id",
                    *[F.col("r").getField(c).alias(c) for c in ANSWER_COLUMNS])


def classify_answers(answers: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Answer rows -> keyed observation rows (k, topic, d, s, m, q, ip, pr, rc, ...).

    Rules: trailing dots stripped; empty measured id dropped; A / AAAA become
    `ip` (query name is the measured domain) or `ns_ip` (any other name);
    NS and MX rows count only for the measured domain and need a non-empty
    target; every other row is dropped.
    """
    dom = strip_dots("id")
    qn = strip_dots("query_name")
    part = F.col("partition") if "partition" in answers.columns else F.lit(0)
    x = answers.select(
        *keep, part.alias("partition"), "offset", "pos", "topic", dom.alias("dom"), qn.alias("qn"),
        F.col("query_type").alias("qt"), F.col("timestamp").alias("ts"),
        F.coalesce(F.col("status_code").cast("bigint"), F.lit(0).cast("bigint")).alias("rc"),
        F.col("response_ttl").cast("bigint").alias("tl"),
        F.coalesce(F.nullif(F.col("ip4_address"), F.lit("")), F.col("ip6_address")).alias("ipv"),
        strip_dots("ns_address").alias("nsv"), strip_dots("mx_address").alias("mxv"),
        F.col("mx_preference").cast("bigint").alias("prv"),
        F.col("as").alias("asv"), F.col("country").alias("ccv"), F.col("ip_prefix").alias("pv"),
    ).filter(F.col("dom") != "")
    qt, prim = F.col("qt"), is_primary("qn", "dom")
    is_ip = qt.isin("A", "AAAA") & F.col("ipv").isNotNull()
    is_ns = (qt == "NS") & prim & (F.col("nsv") != "")
    is_mx = (qt == "MX") & prim & (F.col("mxv") != "")
    k = (F.when(is_ip & prim, "ip").when(is_ip, "ns_ip").when(is_ns, "ns").when(is_mx, "mx"))
    y = x.withColumn("k", k).filter(F.col("k").isNotNull())
    kc = F.col("k")
    ipk = kc.isin("ip", "ns_ip")
    return y.select(
        *keep, "partition", "offset", "pos", "ts", "k", "topic",
        F.when(kc != "ns_ip", F.col("dom")).alias("d"),
        F.when(kc == "ns_ip", F.col("qn")).when(kc == "ns", F.col("nsv")).alias("s"),
        F.when(kc == "mx", F.col("mxv")).alias("m"),
        F.when(ipk, qt).alias("q"),
        F.when(ipk, F.col("ipv")).alias("ip"),
        F.when(kc == "mx", F.col("prv")).alias("pr"),
        "rc", "tl",
        F.when(ipk, F.col("asv")).alias("a"),
        F.when(ipk, F.col("ccv")).alias("c"),
        F.when(ipk, F.col("pv")).alias("p"),
    )


def rollup_observations(answers: DataFrame, window_cols: Sequence[str] = ()) -> DataFrame:
    """AGG-1: one row per (window, kind key) with fs / ls / n and first-arrival attributes.

    `tl, a, c, p` come from the lowest (partition, offset, pos), not the lowest time;
    a NULL of that first arrival is kept.  A NULL time is ignored by the
    min / max and still counted.
    """
    return finish_rollup(partial_rollup(answers, window_cols), window_cols)


def partial_rollup(answers: DataFrame, window_cols: Sequence[str] = ()) -> DataFrame:
    """The rollup of some of a window's answers in a form that merges: one row per (window, key)
    with fs / ls / n, the first arrival `f` and its place in the order of arrival `ord`."""
    c = classify_answers(answers, keep=window_cols).withColumn("_ord", arrival("partition", "offset", "pos"))
    # the raw answers are combined by hash: every buffer of this step has a fixed width
    v = c.groupBy(*window_cols, *OBS_KEY, "a", "c", "p").agg(
        F.min("ts").alias("fs"), F.max("ts").alias("ls"), F.count(F.lit(1)).alias("n"),
        F.min_by("tl", "_ord").alias("tl"), F.min("_ord").alias("_ord"))
    # then the few variants of a key are put together
    return v.groupBy(*window_cols, *OBS_KEY).agg(
        F.min("fs").alias("fs"), F.max("ls").alias("ls"), F.sum("n").alias("n"),
        F.min_by(F.struct("tl", "a", "c", "p"), "_ord").alias("f"), F.min("_ord").alias("ord"))


def merge_partials(partials: DataFrame, window_cols: Sequence[str] = ()) -> DataFrame:
    """Partial rollups of the same windows put together, in the same form."""
    return partials.groupBy(*window_cols, *OBS_KEY).agg(
        F.min("fs").alias("fs"), F.max("ls").alias("ls"), F.sum("n").alias("n"),
        F.min_by("f", "ord").alias("f"), F.min("ord").alias("ord"))


def arrival(partition: str, offset: str, pos: str):
    """Order of arrival as one number: the partition (offsets are counted per partition), the
    offset, then the place in the message."""
    at = lambda c, places: F.coalesce(F.col(c), F.lit(0)).cast(f"decimal({places},0)")
    return ((at(partition, 10) * F.lit(str(1 << 94)).cast("decimal(29,0)")
             + at(offset, 20) * F.lit(1 << 31).cast("decimal(10,0)")) + at(pos, 10)).cast("decimal(38,0)")


def rollup_aggregates():
    """The per-key aggregates of AGG-1 in one step, as the streaming rollup keeps them."""
    first = F.min_by(F.struct("tl", "a", "c", "p"), F.struct("partition", "offset", "pos"))
    return [F.min("ts").alias("fs"), F.max("ts").alias("ls"), F.count(F.lit(1)).alias("n"), first.alias("f")]


def finish_rollup(g: DataFrame, window_cols: Sequence[str] = ()) -> DataFrame:
    out = {
        "rc": F.nullif(F.col("rc"), F.lit(0).cast("bigint")).alias("rc"),
        "tl": F.col("f.tl").alias("tl"), "a": F.col("f.a").alias("a"),
        "c": F.col("f.c").alias("c"), "p": F.col("f.p").alias("p"),
    }
    return g.select(*window_cols, *[out.get(n, F.col(n)) for n in OBS_COLUMNS])


def rollup_measurements(envelopes: DataFrame, window_cols: Sequence[str] = ()) -> DataFrame:
    """JOB-1: decoded measurement envelopes -> observation table."""
    return rollup_observations(flatten_measurements(envelopes, keep=window_cols), window_cols)


def extract_rows(answers: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """JOB-2 (legacy form): one row per usable answer, no rollup; keeps rtt and raw rcode."""
    dom = strip_dots("id")
    qn = strip_dots("query_name")
    x = answers.select(
        *keep, "offset", "pos", "topic", dom.alias("dom"), qn.alias("qn"), F.col("query_type").alias("qt"),
        F.col("timestamp").alias("ts"), F.col("status_code").cast("bigint").alias("rcode"),
        F.col("response_ttl").cast("bigint").alias("ttl"),
        F.coalesce(F.nullif(F.col("ip4_address"), F.lit("")), F.col("ip6_address")).alias("ipv"),
        strip_dots("ns_address").alias("nsv"), strip_dots("mx_address").alias("mxv"),
        F.col("mx_preference").cast("bigint").alias("prv"), "as", "country", "ip_prefix", "rtt",
    ).filter(F.col("dom") != "")
    qt, prim = F.col("qt"), is_primary("qn", "dom")
    is_ip = qt.isin("A", "AAAA") & F.col("ipv").isNotNull()
    is_ns = (qt == "NS") & prim & (F.col("nsv") != "")
    is_mx = (qt == "MX") & prim & (F.col("mxv") != "")
    kind = F.when(is_ip & prim, "ip").when(is_ip, "ns_ip").when(is_ns, "ns").when(is_mx, "mx")
    y = x.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    kc = F.col("kind")
    ipk = kc.isin("ip", "ns_ip")
    return y.select(
        *keep, "offset", "pos", "kind", "ts", "topic",
        F.when(kc != "ns_ip", F.col("dom")).alias("domain"),
        F.when(kc == "ns_ip", F.col("qn")).when(kc == "ns", F.col("nsv")).alias("ns"),
        F.when(kc == "mx", F.col("mxv")).alias("mx"),
        F.when(kc == "mx", F.col("prv")).alias("preference"),
        F.when(ipk, qt).alias("qtype"), F.when(ipk, F.col("ipv")).alias("ip"),
        F.when(ipk, F.col("as")).alias("as"), F.when(ipk, F.col("country")).alias("country"),
        F.when(ipk, F.col("ip_prefix")).alias("prefix"),
        "ttl", F.when(ipk, F.col("rtt")).alias("rtt"), "rcode",
    )

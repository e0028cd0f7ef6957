"""Parking-provider delta: which domains were newly delegated to known
parking name servers in one window, against a permanent first-seen state.

Plan notes (per window, about 10^8 NS rows at full scale):
* The suffix rule `ends_with(s, suffix)` is a theta join; Spark would run it
  as a nested loop.  `match_providers` instead explodes each host into its
  dot-led suffixes and equi-joins them with the (size-checked, broadcast)
  suffix table: one scan, a hash join, the same multiset of matches.
* The certificate side is first reduced at its scan by a digest of today's
  domains, then by a semi join on them, then aggregated per apex (combined map-side), then left-joined, instead of
  joining raw certificate names and grouping by list columns afterwards.
* The anti join with the seen state is an equi join on (provider, domain);
  the state is the large side and is shuffled / sort-merged, never broadcast
  unless AQE measures it small at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.functions.bitmaps import key_digest, maybe_in
from zonelens.functions.names import apex_of, label_suffixes, target_url
from zonelens.operators.joins import broadcast_if_small


def active_suffixes(providers: DataFrame) -> DataFrame:
    """(provider, suffix) of active providers; accepts the config form
    (name, active, ns_suffix[]) or the one-row-per-suffix form."""
    cols = set(providers.columns)
    if "ns_suffix" in cols:
        p = providers.filter(F.col("active")).select(
            F.col("name").alias("provider"), F.explode("ns_suffix").alias("suffix"))
    else:
        p = providers.filter(F.col("active")).select("provider", "suffix")
    return p


def active_provider_names(providers: DataFrame) -> DataFrame:
    cols = set(providers.columns)
    name = "name" if "name" in cols else "provider"
    return providers.filter(F.col("active")).select(F.col(name).alias("provider")).distinct()


def ns_rows(obs: DataFrame) -> DataFrame:
    """NS delegations usable for matching."""
    return obs.filter((F.col("k") == "ns") & F.col("s").isNotNull() & F.col("d").isNotNull())


def match_providers(ns: DataFrame, providers: DataFrame, method: str = "labels") -> DataFrame:
    """JOIN-1: NS rows x active suffixes where `s` ends with the suffix.

    A row matching two suffixes of a provider appears twice, as in a
    UNION ALL of one filter per suffix.  `method='theta'` runs the literal
    ends_with join (nested loop) and exists to check the rewrite.
    """
    suf = active_suffixes(providers)
    if method == "theta":
        s = broadcast_if_small(suf)
        return ns.join(s, ns["s"].endswith(s["suffix"])).drop("suffix")
    dotted = broadcast_if_small(suf.filter(F.col("suffix").startswith(".")))
    x = ns.withColumn("suffix", F.explode(label_suffixes("s"))).join(dotted, "suffix").drop("suffix")
    # suffixes without a leading dot (outside the config rules) can end inside a
    # label; the few of them, if any, are matched literally (an empty side costs nothing)
    o = broadcast_if_small(suf.filter(~F.col("suffix").startswith(".") | F.col("suffix").isNull()))
    return x.unionByName(ns.join(o, ns["s"].endswith(o["suffix"])).drop("suffix"))


def parking_today(obs: DataFrame, providers: DataFrame, method: str = "labels") -> DataFrame:
    """JOB-4 / AGG-7: per (provider, domain) in one window: NS set, topics, first / last time, count."""
    m = match_providers(ns_rows(obs), providers, method)
    return (m.groupBy("provider", F.col("d").alias("domain"))
            .agg(F.sort_array(F.collect_set("s")).alias("ns_set"),
                 F.sort_array(F.collect_set("topic")).alias("source_topics"),
                 F.min("fs").alias("first_ms"), F.max("ls").alias("last_ms"),
                 F.sum("n").alias("observations")))


def seen_before(seen: DataFrame, snap: str) -> DataFrame:
    """State entries from earlier windows only: re-running a window is idempotent."""
    return seen.filter(F.col("first_snap") < F.lit(snap)).select("provider", "domain")


def parking_new(today: DataFrame, seen: DataFrame | None, snap: str) -> DataFrame:
    """JOIN-2: drop (provider, domain) pairs first seen in an earlier window."""
    if seen is None:
        return today
    return today.join(seen_before(seen, snap), ["provider", "domain"], "left_anti")


def ct_names(certs: DataFrame) -> DataFrame:
    """GEN-2 / FN-1: certificate list form -> (apex, source, fingerprint), one row per name."""
    x = certs.filter(F.col("domain_list").isNotNull()).select(
        "source", "fingerprint", F.explode("domain_list").alias("name"))
    raw = F.lower(F.rtrim(F.col("name"), F.lit(".")))
    return x.filter(raw != "").select(apex_of("name").alias("apex"), "source", "fingerprint")


def _nonempty(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def wanted_names(certs: DataFrame, wanted: DataFrame) -> DataFrame:
    """JOIN-3: the certificate names whose apex is a `domain` of `wanted`.

    The names are tested against a digest of the wanted domains while the log is scanned (its
    size is bounded, see `functions.bitmaps`), so what is shuffled for the exact join follows
    the matches, not the log.
    """
    apexes = wanted.select(F.col("domain").alias("apex")).distinct()
    names = maybe_in(ct_names(certs), "apex", key_digest(apexes, "apex"))
    return names.join(apexes, "apex", "left_semi")


def ct_signal(today_new: DataFrame, certs: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """JOIN-3 / AGG-8: attach sorted distinct CT sources / fingerprints by apex.

    The lists are NULL when no certificate name has the domain as apex.
    `wanted` (a `domain` column, default: today_new's domains) reduces the
    certificate side before its aggregation; any superset of today_new's
    domains gives the same result.
    """
    per_apex = (wanted_names(certs, wanted if wanted is not None else today_new).groupBy("apex")
                .agg(F.sort_array(F.collect_set("source")).alias("ct_sources"),
                     F.sort_array(F.collect_set("fingerprint")).alias("ct_fingerprints")))
    j = today_new.join(per_apex, today_new["domain"] == per_apex["apex"], "left")
    return j.select(*[today_new[c] for c in today_new.columns],
                    _nonempty(F.col("ct_sources")).alias("ct_sources"),
                    _nonempty(F.col("ct_fingerprints")).alias("ct_fingerprints"))


def ct_signal_rows(today_new: DataFrame, certs: DataFrame) -> DataFrame:
    """The certificate signal in normalised form: one row per (provider, domain, source,
    fingerprint).  Same content as the list columns of `ct_signal`, for consumers that
    must not hold every fingerprint of a heavily certified apex in one row."""
    names = ct_names(certs).filter(F.col("fingerprint").isNotNull() | F.col("source").isNotNull())
    wanted = today_new.select("provider", F.col("domain").alias("apex"))
    return (names.join(wanted, "apex").select("provider", F.col("apex").alias("domain"), "source", "fingerprint")
            .distinct())


CHUNK = 10_000               # values in one list of `ct_signal_chunks`, about
SALTS = 4096                 # parts that an apex's values are dealt to, by their digest


def ct_signal_chunks(today_new: DataFrame, certs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """AGG-8 for apexes of any size: the distinct fingerprints of each domain in numbered lists
    of about `chunk` values: (domain, chunk, n_chunks, n_values, ct_fingerprints), every one kept.

    Values are dealt, counted and joined by (apex, part of the digest), never by the apex alone,
    so an apex with a third of all certificates is spread over all tasks.  What meets the wanted
    domains and is summed per apex is one row per part.  A value's chunk follows from its own
    digest, so no task holds or numbers a whole apex.
    """
    apexes = today_new.select(F.col("domain").alias("apex")).distinct()
    once = certs.withColumn("domain_list", F.array_distinct(F.transform("domain_list", apex_of)))       # an apex once per certificate
    names = maybe_in(ct_names(once), "apex", key_digest(apexes, "apex")).filter(F.col("fingerprint").isNotNull())
    place = F.conv(F.substring(F.md5(F.col("fingerprint").cast("binary")), 1, 8), 16, 10).cast("long")
    # the same filters on all uses, so that they share one scan and one exchange
    values = (names.select("apex", "fingerprint", (place % SALTS).alias("salt"))
              .filter(F.col("apex").isNotNull() & F.col("salt").isNotNull()).repartition("apex", "salt"))
    parts = values.distinct().groupBy("apex", "salt").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    sizes = (parts.groupBy("apex").agg(F.ceil(F.sum("n") / chunk).cast("long").alias("n_chunks"))
             .join(apexes, "apex", "left_semi"))
    # merge joins: neither side has a size that a broadcast could count on
    keys = parts.hint("merge").join(sizes, "apex")
    rows = values.join(keys.hint("merge"), ["apex", "salt"])
    lists = (rows.groupBy(F.col("apex").alias("domain"), F.pmod(place, F.col("n_chunks")).alias("chunk"), "n_chunks")
             .agg(F.sort_array(F.collect_set("fingerprint")).alias("ct_fingerprints")))
    return lists.select("domain", "chunk", "n_chunks", F.size("ct_fingerprints").cast("long").alias("n_values"), "ct_fingerprints")


def parking_delta(obs: DataFrame, certs: DataFrame, providers: DataFrame,
                  seen: DataFrame | None, snap: str, method: str = "labels") -> DataFrame:
    """JOB-5: the S4 delta of one window.

    Certificates are reduced by the domains of *today* (before the anti join),
    so the seen state is joined once and not again for the reduction.
    """
    today = parking_today(obs, providers, method)
    return ct_signal(parking_new(today, seen, snap), certs, wanted=today)


def delta_counts(delta: DataFrame, providers: DataFrame) -> DataFrame:
    """AGG-13 / JOIN-12 / AGG-9: new and with-CT counts for every active provider (zero-filled)."""
    c = delta.groupBy("provider").agg(
        F.count(F.lit(1)).alias("new_domains"),
        F.count_if(F.col("ct_sources").isNotNull() & (F.size("ct_sources") > 0)).alias("ct_signal_count"))
    names = broadcast_if_small(active_provider_names(providers))
    return (names.join(c, "provider", "left")
            .select("provider", F.coalesce("new_domains", F.lit(0).cast("bigint")).alias("new_domains"),
                    F.coalesce("ct_signal_count", F.lit(0).cast("bigint")).alias("ct_signal_count")))


def delta_manifest(counts: DataFrame, snap: str, config_version: int) -> DataFrame:
    """SNK-6: one manifest row; providers ordered by count desc (name breaks ties)."""
    entry = F.struct(F.col("new_domains"), F.col("provider").alias("name"), F.col("ct_signal_count"))
    return counts.agg(F.sort_array(F.collect_list(entry), asc=False).alias("p")).select(
        F.lit(snap).alias("snap_tag"), F.lit(config_version).alias("config_version"),
        F.transform("p", lambda e: F.struct(e["name"].alias("name"), e["new_domains"].alias("new_domains"),
                                            e["ct_signal_count"].alias("ct_signal_count"))).alias("providers"))


def merge_seen(seen: DataFrame | None, delta: DataFrame, snap: str) -> DataFrame:
    """JOB-6 / AGG-10: new state = old state + this window's pairs, earliest wins.

    `first_snap` is taken from the row with the lowest first_ms (the tag
    breaks ties, so the result does not depend on row order).
    """
    new = delta.select("provider", "domain", F.lit(snap).alias("first_snap"), "first_ms")
    u = new if seen is None else new.unionByName(seen.select("provider", "domain", "first_snap", "first_ms"))
    best = F.min(F.struct("first_ms", "first_snap"))
    return (u.groupBy("provider", "domain").agg(best.alias("b"))
            .select("provider", "domain", F.col("b.first_snap").alias("first_snap"),
                    F.col("b.first_ms").alias("first_ms")))


def _union_sets(c: str) -> Column:
    merged = F.sort_array(F.array_distinct(F.flatten(F.collect_list(c))))
    return _nonempty(merged)


def day_rollup(*deltas: DataFrame) -> DataFrame:
    """SET-5: calendar-day view = union of adjacent window deltas, regrouped by (provider, domain).

    Each pair occurs at most once per window, so a group holds at most as
    many rows as there are windows in the day.
    """
    u = deltas[0]
    for d in deltas[1:]:
        u = u.unionByName(d)
    return (u.groupBy("provider", "domain")
            .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ns_set")))).alias("ns_set"),
                 F.sort_array(F.array_distinct(F.flatten(F.collect_list("source_topics")))).alias("source_topics"),
                 F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"),
                 F.sum("observations").alias("observations"),
                 _union_sets("ct_sources").alias("ct_sources"),
                 _union_sets("ct_fingerprints").alias("ct_fingerprints")))


def archive_candidates(delta: DataFrame, limit: int | None = None, provider: str | None = None) -> DataFrame:
    """PRJ-16 / PRJ-17: newly seen apexes from the registered-domains topic, with their page address;
    of one provider when given, so that the limit holds per provider."""
    if provider is not None:
        delta = delta.filter(F.col("provider") == provider)
    c = (delta.filter(F.array_contains("source_topics", "domains"))
         .select("domain", "provider", target_url("domain").alias("url")).orderBy("domain", "provider"))
    return c.limit(limit) if limit else c


def archive_summary(results: DataFrame) -> DataFrame:
    """AGG-20: outcome counts per status, plus how many hit the rate limit (HTTP 429)."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(F.col("error"), F.lit("")).startswith("http_429")).alias("rate_429"))

"""User-level jobs: one window's ingest, certificates, parking delta and monthly audit.

Each job is a handful of DataFrame actions.  The delta is written once, as its
Parquet output, and read back for its other consumers (JSON copy, counts,
manifest and the new state), so the plan is not run again.  Outputs of a window are overwritten as a whole.
The state is either layered (`SeenLayers`: the window's pairs are appended) or a table that is written whole
to a new path, which the caller swaps in afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonelens.operators import audit as A
from zonelens.operators import certs as CT
from zonelens.operators import parking as K
from zonelens.operators.rollup import rollup_measurements
from zonelens.operators.seen_layers import SeenLayers
from zonelens.session import checkpoint_root
from zonelens.sinks import writers as W


def run_ingest(envelopes: DataFrame, out_root: str, window_cols=("date", "hour")) -> DataFrame:
    """JOB-1 + SNK-1 / SNK-7: rollup of decoded messages, written per window (dynamic overwrite)."""
    obs = rollup_measurements(envelopes, window_cols=list(window_cols))
    W.write_observations(obs, out_root, partition_cols=list(window_cols), bloom=True)
    return obs


def _ingest_certificates(envelopes: DataFrame, rows_path: str, stats_path: str) -> None:
    counted = Observation("certificates")
    rows = CT.ingest_rows(envelopes).observe(counted, *CT.ingest_metrics())
    W.write_ingest(rows, rows_path)
    stats = tuple(counted.get.get(c) for c in StructType.fromDDL(CT.METRICS).names)
    envelopes.sparkSession.createDataFrame([stats], CT.METRICS).write.mode("overwrite").parquet(stats_path)


def run_certificates(envelopes: DataFrame, out_root: str) -> dict:
    """JOB-3: one topic's certificate messages in one pass over the input.

    The rows are written once, split into certificates and rejects; the ingest statistics are
    counted while they are written (`Observation`), and drift is read from the written rows.
    """
    out = out_root.rstrip("/")
    _ingest_certificates(envelopes, f"{out}/rows", f"{out}/stats")
    return {"rows": f"{out}/rows", "stats": f"{out}/stats"}


def run_certificate_stream(stream: DataFrame, out_root: str, checkpoint: str, timeout_s: int | None = None) -> dict:
    """`run_certificates` over a stream: each micro-batch is written and counted in one pass, into
    folders of its own that a replay overwrites, so no message is counted twice."""
    from zonelens.streaming.budget import finish
    out = out_root.rstrip("/")

    def write(batch: DataFrame, epoch_id: int) -> None:
        _ingest_certificates(batch, f"{out}/rows/batch={epoch_id:08d}", f"{out}/stats/batch={epoch_id:08d}")
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finish(q, timeout_s)
    return {"rows": f"{out}/rows", "stats": f"{out}/stats"}


class IncompleteWindow(RuntimeError):
    """The window lacks shard files; its delta would miss domains for good."""


def run_delta(obs_window: DataFrame, certs: DataFrame, providers: DataFrame, seen: DataFrame | SeenLayers | None,
              snap: str, out_root: str, seen_out: str | None = None, config_version: int = 1,
              missing: DataFrame | None = None) -> dict:
    """JOB-5 / JOB-6 / JOB-7 with sinks SNK-4, SNK-5, SNK-6, SNK-8.

    `seen` as `SeenLayers`: the window's pairs are appended to that state as a run.  As a
    table: the state is merged with them and written whole to `seen_out`.

    `missing` (`housekeeping.missing_shards` of the window) is the completeness
    gate: with any row in it nothing is written.  The delta is written once;
    its JSON copy, counts, manifest and the new state are derived from the files.
    """
    spark = obs_window.sparkSession
    checkpoint_root(spark)
    if missing is not None:
        some = [f"{r['topic']} {r['date']} {r['hour']} shard {r['shard']}" for r in missing.limit(5).collect()]
        if some:
            raise IncompleteWindow(f"{snap}: missing {', '.join(some)}")
    out = out_root.rstrip("/")
    state = seen.read() if isinstance(seen, SeenLayers) else seen
    delta = K.parking_delta(obs_window, certs, providers, state, snap)
    W.write_per_provider(delta, f"{out}/delta", "parquet")
    delta = spark.read.schema(delta.schema).parquet(f"{out}/delta").select(*delta.columns)
    W.write_per_provider(delta, f"{out}/delta_jsonl", "json")
    counts = K.delta_counts(delta, providers).checkpoint(eager=True)     # one row per active provider
    W.write_csv(counts.orderBy(F.desc("new_domains"), "provider"), f"{out}/counts")
    # every active provider gets a Parquet file, also without new domains (the
    # partitioned writer creates no directory for them); a loop over config rows
    empty = delta.limit(0).drop("provider")
    for r in counts.filter(F.col("new_domains") == 0).select("provider").collect():
        empty.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/delta/provider={r.provider}")
    K.delta_manifest(counts, snap, config_version).coalesce(1).write.mode("overwrite").json(f"{out}/manifest")
    if isinstance(seen, SeenLayers):
        seen.append(delta, snap)
        seen.compact()
        seen_out = seen.root
    else:
        W.write_seen_state(K.merge_seen(seen, delta, snap), seen_out)
    return {"delta": f"{out}/delta", "counts": f"{out}/counts", "manifest": f"{out}/manifest", "seen": seen_out}


def run_audit(obs: DataFrame, providers: DataFrame, out_root: str, k: int = 500, threshold: int = 1000,
              topic: str | None = "domains"):
    """JOB-8 + SNK-9: top-K table (Parquet + CSV) and the configured / unhandled split of one topic."""
    topk = A.ns_audit_topk(obs, k, topic=topic).checkpoint(eager=True)
    W.write_audit(topk, out_root)
    return topk, A.audit_unhandled(topk, providers, threshold), A.audit_configured(topk, providers, threshold)

"""spark-submit entry points (K6): the streaming job, reports and table maintenance.

    spark-submit releaseflow/jobs.py stream --bootstrap-servers kafka:29092 --root s3a://bucket/releases
    spark-submit releaseflow/jobs.py stream --landing /data/bus --root /data/releases
    spark-submit releaseflow/jobs.py surprise --root /data/releases [--out /data/reports/surprise]
    spark-submit releaseflow/jobs.py sql --root /data/releases --query "SELECT * FROM surprise_leaderboard"
    spark-submit releaseflow/jobs.py optimize --root /data/releases
    spark-submit releaseflow/jobs.py leaderboard --root /data/releases --optimized
    spark-submit releaseflow/jobs.py retention --root /data/releases --retain-hours 168

Reports print a bounded preview (``--n`` rows) or, with ``--out``, are written
in full as Parquet by the executors; nothing unbounded is collected.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from releaseflow.operators import maintenance as M  # noqa: E402
from releaseflow.operators import reports as R  # noqa: E402
from releaseflow.schema import RETENTION_HOURS, TRIGGER_INTERVAL  # noqa: E402
from releaseflow.session import build_session, shared_dir  # noqa: E402
from releaseflow.sources.table import VersionedTable  # noqa: E402

REPORTS = {
    "latest": lambda df, a: R.latest_releases(df, a.n),
    "latest_by_indicator": lambda df, a: R.latest_by_indicator(df),
    "high_impact": lambda df, a: R.high_impact_events(df, a.since_days, a.as_of),
    "recent_high_impact": lambda df, a: R.recent_high_impact(df, a.since_days, a.as_of),
    "surprise": lambda df, a: R.surprise_analysis(df),
    "leaderboard": lambda df, a: R.surprise_leaderboard(df),
    "fomc": lambda df, a: R.fomc_decision_history(df),
    "fomc_history": lambda df, a: R.fomc_rate_change(df),
    "anomalies": lambda df, a: R.anomaly_summary(df),
    "freshness": lambda df, a: R.freshness(df),
}


def _credentials(a: argparse.Namespace) -> dict[str, str]:
    """JDBC properties; the password comes from a file, not from the command line that others can list."""
    out = {"user": a.serving_user} if a.serving_user else {}
    if a.serving_password_file:
        with open(a.serving_password_file, encoding="utf-8") as f:
            out["password"] = f.read().strip()
    return out


def stop_after_batch(queries: list, wait: float = 300.0) -> None:
    """Stop queries once their running micro-batch has ended; after ``wait`` seconds stop them anyway.

    A batch that is interrupted replays at the next start."""
    end = time.monotonic() + wait
    for q in queries:
        while q.isActive and q.status["isTriggerActive"] and time.monotonic() < end:
            time.sleep(0.1)
        q.stop()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="releaseflow jobs")
    p.add_argument("action", choices=["stream", "optimize", "retention", "history", "sql", *REPORTS])
    p.add_argument("--query", default=None, help="sql: statement over releases_enriched and the serving views")
    p.add_argument("--root", help="folder holding releases_enriched/ (default: <checkpoint dir>/releaseflow)")
    p.add_argument("--n", type=int, default=20)
    p.add_argument("--since-days", type=int, default=90)
    p.add_argument("--as-of", default=None, help="report clock (default: now)")
    p.add_argument("--version", type=int, default=None, help="read the table as of this version")
    p.add_argument("--timestamp", default=None, help="read the table as of this time")
    p.add_argument("--out", default=None, help="write the full report here (Parquet)")
    p.add_argument("--optimized", action="store_true",
                   help="reports: read the copy that optimize wrote, and the batches since")
    p.add_argument("--z-order", default=",".join(M.ZORDER_COLUMNS), help="optimize: columns, comma-separated")
    p.add_argument("--retain-hours", type=int, default=RETENTION_HOURS)
    p.add_argument("--bootstrap-servers", default=None)
    p.add_argument("--landing", default=None, help="stream: folder of landed bus files instead of Kafka")
    p.add_argument("--checkpoints", default=None)
    p.add_argument("--max-offsets", type=int, default=None, help="stream: Kafka offsets per trigger (default: all)")
    p.add_argument("--max-files", type=int, default=None, help="stream: landed files per trigger (default: all)")
    p.add_argument("--trigger", default=TRIGGER_INTERVAL, help="stream: processing interval")
    p.add_argument("--serving-url", default=None, help="stream: JDBC URL of the serving table")
    p.add_argument("--serving-table", default="streaming.releases_enriched")
    p.add_argument("--serving-user", default=None, help="stream: JDBC user")
    p.add_argument("--serving-password-file", default=None, help="stream: file that holds the JDBC password")
    p.add_argument("--allow-data-loss", action="store_true",
                   help="stream: go on where Kafka offsets have expired (counted in the progress log)")
    p.add_argument("--stop-wait", type=float, default=300.0,
                   help="stream: seconds that SIGTERM waits for the running micro-batch")
    p.add_argument("--serving-path", default=None, help="stream: Parquet folder of serving rows instead of JDBC")
    p.add_argument("--available-now", action="store_true")
    a = p.parse_args(argv)

    spark = build_session()
    root = (a.root or f"{shared_dir(spark)}/releaseflow").rstrip("/")
    table = VersionedTable(spark, f"{root}/releases_enriched")
    optimized = VersionedTable(spark, f"{root}/releases_enriched_compacted")

    if a.action == "stream":
        from releaseflow.streaming.job import StreamConfig, file_bus, kafka_bus, start
        from releaseflow.streaming.sinks import JdbcServingTarget, ParquetServingTarget
        bus = (kafka_bus(spark, a.bootstrap_servers, max_offsets_per_trigger=a.max_offsets,
                         fail_on_data_loss=not a.allow_data_loss) if a.bootstrap_servers
               else file_bus(spark, a.landing, max_files_per_trigger=a.max_files))
        serving = (JdbcServingTarget(a.serving_url, a.serving_table, _credentials(a)) if a.serving_url
                   else ParquetServingTarget(a.serving_path) if a.serving_path else None)
        cfg = StreamConfig(root=root, checkpoint_root=a.checkpoints or f"{root}/_checkpoints",
                           bootstrap_servers=a.bootstrap_servers, serving=serving,
                           trigger={"availableNow": True} if a.available_now else
                           {"processingTime": a.trigger})
        qs = start(spark, bus, cfg)

        def _stop(signum, frame):
            stop_after_batch(qs["queries"], a.stop_wait)

        import signal
        try:
            signal.signal(signal.SIGTERM, _stop)
        except ValueError:  # not the main thread (embedded use): the caller owns shutdown
            pass
        if a.available_now:
            for q in qs["queries"]:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
        qs["listener"].flush()
        return
    if a.action == "optimize":
        target = M.zorder(table, optimized.root, tuple(a.z_order.split(",")))
        print(f"rewritten in Z-order of {a.z_order} into {target.root}")
        return
    if a.action == "retention":
        old = M.retention_candidates(table, a.retain_hours, a.as_of)
        if a.out:
            old.write.mode("overwrite").parquet(a.out)
        else:
            old.orderBy("batch_id").show(a.n, truncate=False)
        return
    if a.action == "history":
        table.history(a.n).show(truncate=False)
        return

    df = M.with_newer_batches(table, optimized) if a.optimized else table.scan()
    if a.version is not None:
        df = df.filter(F.col("batch_id") <= a.version)
    elif a.timestamp:
        df = df.filter(F.col("batch_id") <= table.version_at(a.timestamp).scalar())
    if a.action == "sql":
        from releaseflow.plans.views import register_views
        register_views(spark, df, as_of=a.as_of, recent_days=a.since_days)
        report = spark.sql(a.query)
    else:
        report = REPORTS[a.action](df, a)
    if a.out:
        report.write.mode("overwrite").parquet(a.out)
    else:
        report.show(a.n, truncate=False)


if __name__ == "__main__":
    main()

"""The spark-submit entry: stream a landed bus into a root, then run reports and maintenance."""

from pyspark.sql import functions as F

from releaseflow import jobs
from releaseflow.plans.common import releases
from releaseflow.sources.events import bus_rows
from releaseflow.sources.table import VersionedTable

from conftest import SF_SMALL


def test_cli_stream_report_maintain(spark, workdir, capsys):
    bus = bus_rows(releases(spark, SF_SMALL)).drop("seq")
    bus.filter("timestamp < '2024-01-15'").coalesce(1).write.parquet(f"{workdir}/landing/a")
    bus.filter("timestamp >= '2024-01-15'").coalesce(1).write.parquet(f"{workdir}/landing/b")
    root = f"{workdir}/root"
    jobs.main(["stream", "--landing", f"{workdir}/landing/*", "--root", root, "--available-now",
               "--max-files", "1", "--serving-path", f"{root}/serving"])
    assert spark.read.parquet(f"{root}/serving").count() == VersionedTable(
        spark, f"{root}/releases_enriched").scan().count()
    t = VersionedTable(spark, f"{root}/releases_enriched")
    assert t.scan().count() > 900
    jobs.main(["surprise", "--root", root, "--out", f"{workdir}/surprise"])
    groups = t.scan().filter("surprise_pct IS NOT NULL").select("release_name", "source").distinct()
    assert spark.read.parquet(f"{workdir}/surprise").count() == groups.count() >= 13
    jobs.main(["history", "--root", root, "--n", "5"])
    jobs.main(["sql", "--root", root, "--query", "SELECT * FROM surprise_leaderboard",
               "--out", f"{workdir}/leaderboard"])
    assert spark.read.parquet(f"{workdir}/leaderboard").count() == groups.count()
    jobs.main(["optimize", "--root", root])
    c = VersionedTable(spark, f"{root}/releases_enriched_compacted")
    assert c.scan().count() == t.scan().count()
    rows = t.scan().count()
    jobs.main(["leaderboard", "--root", root, "--optimized", "--out", f"{workdir}/leaderboard_optimized"])
    assert spark.read.parquet(f"{workdir}/leaderboard_optimized").count() == groups.count()
    jobs.main(["retention", "--root", root, "--retain-hours", "1", "--as-of", "2100-01-01 00:00:00"])
    assert "num_rows" in capsys.readouterr().out
    assert t.scan().count() == rows
    assert t.scan().filter(F.col("is_anomaly")).count() == \
        VersionedTable(spark, f"{root}/anomalies").scan().count()


def test_stop_waits_for_the_running_batch():
    class Query:
        isActive = True

        def __init__(self, busy):
            self.busy, self.stopped_after = busy, None

        @property
        def status(self):
            self.busy -= 1
            return {"isTriggerActive": self.busy > 0}

        def stop(self):
            self.stopped_after = self.busy

    idle, busy, stuck = Query(0), Query(5), Query(10 ** 9)
    jobs.stop_after_batch([idle, busy], 60)
    assert idle.stopped_after <= 0 and busy.stopped_after == 0
    jobs.stop_after_batch([stuck], 0.3)
    assert stuck.stopped_after > 0


def test_credentials_come_from_a_file(workdir):
    import argparse
    with open(f"{workdir}/secret", "w") as f:
        f.write("pw\n")
    a = argparse.Namespace(serving_user="u", serving_password_file=f"{workdir}/secret")
    assert jobs._credentials(a) == {"user": "u", "password": "pw"}
    assert jobs._credentials(argparse.Namespace(serving_user=None, serving_password_file=None)) == {}

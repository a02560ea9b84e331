"""Sending the package to executors that don't have it installed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make ``releaseflow`` importable in Python workers, once per application."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if sc.applicationId in _sent or not root.is_dir():
        return
    _sent.add(sc.applicationId)
    tmp = tempfile.mkdtemp(prefix="releaseflow-code-")  # the driver serves the archive from here until it ends
    atexit.register(shutil.rmtree, tmp, ignore_errors=True)
    copy = Path(tmp, "src", root.name)
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(Path(tmp, f"{root.name}-code")), "zip", copy.parent))

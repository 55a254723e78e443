"""Lets Python workers that share this file system import the package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = str(Path(__file__).resolve().parents[1])


def ship(spark: SparkSession) -> None:
    """Add the package's folder to the workers' path; on other clusters ship it with --py-files."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *parts])

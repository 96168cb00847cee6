"""Sessions."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def findable(spark: SparkSession) -> None:
    """Let the workers of a local session import this package from where the driver has it."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))

"""What a session needs before Python workers can import this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def prepare(spark: SparkSession) -> SparkSession:
    """The session in UTC, which texts of times assume, and with the repository on its workers' Python path.

    That holds for workers that have it at the same place; elsewhere use --py-files.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark

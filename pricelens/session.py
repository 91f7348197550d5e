"""SparkSession factory with the settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "pricelens", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; a repeated map key keeps its last value.

    ``master`` is left to spark-submit unless given. ``conf`` overrides any default (dots written as ``__``).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app).config(map=settings)
    if master or "SPARK_MASTER" in os.environ:
        builder = builder.master(master or os.environ["SPARK_MASTER"])
    return builder.getOrCreate()

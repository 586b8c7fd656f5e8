"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def build_session(app: str = "footfall", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution.

    Nothing about cluster size is fixed here: shuffle partitions, executor memory and
    the shared checkpoint folder come from spark-submit or from ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # one state row per (user, open session) and task instead of one per event
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _single_machine_root() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the cluster's shared ``spark.checkpoint.dir``.

    Only a single-machine session may fall back to a temporary folder: on a cluster,
    executors could neither see it nor survive the loss of the machine that has it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = _single_machine_root()
    return f"{root.rstrip('/')}/footfall/{spark.conf.get('spark.app.id', 'app')}/{name}-{uuid.uuid4().hex}"

"""Session for local runs. On a cluster, pass the session you already have."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "tallychain", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("TALLYCHAIN_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what runs in this block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of a write in this block go when it ends.

    Else they stay until the driver happens to collect its garbage, beside those of the next write.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir.

    Only a session that runs in one process, as in tests, may do without that
    setting; it then sets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tallychain-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

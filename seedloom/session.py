"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"


def build_session(app: str = "seedloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call sites of column functions in error messages cost more than the functions.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, as in tests, may go without that setting; it then
    gets one temporary folder of its own.
    """
    root = spark.conf.get(SCRATCH_CONF, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError(f"set {SCRATCH_CONF} to a folder all executors share")
        app = spark.conf.get("spark.app.id", "")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

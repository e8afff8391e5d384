"""Session set-up and the shared folder every job writes its working tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: A side may be broadcast only below this many rows (checked by counting).
BROADCAST_ROWS = 100_000


def build_session(app: str = "orderweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; every one can be overridden."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Times are rendered in UTC whatever zone the session was started with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own: on a cluster such a
    folder would exist on one machine alone.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="orderweave-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, reader: SparkSession | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends at files that outlive executors.

    ``reader`` is the session to go on with, by default that of ``df``.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, label: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A join side that is expected to be tiny: computed once, counted, and broadcast only if it really is.

    It is written first, so that counting it and joining it do not run its plan twice. Above ``max_rows`` there is
    no hint and the join is left to AQE.
    """
    written = materialize(df, label)
    return F.broadcast(written) if written.count() <= max_rows else written

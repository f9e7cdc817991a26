"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime SQL settings that change results or plans. All can be set on a live session.
SETTINGS = {
    # Month, year and key text are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A bad strict cast must fail, not become NULL.
    "spark.sql.ansi.enabled": "true",
    # Re-plan at shuffle boundaries and split partitions that a hot key makes too large.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The default is a deprecated 96-bit form without statistics.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Steps hand rows on as files; these are a quarter smaller than with the default.
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put SETTINGS on an existing session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "incident-mart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build or get a session with SETTINGS.

    On a cluster leave ``master`` and ``shuffle_partitions`` to the submit command;
    README has the sizing rule.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Partitions so that one holds about ``target_bytes``."""
    return max(1, -(-shuffle_bytes // target_bytes))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the folder the cluster shares.

    The folder is ``spark.checkpoint.dir``. Only a local session, whose tasks all
    see this machine's disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="incident-mart-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""Session settings the operators rely on, and the option defaults they share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Option defaults that users of log shippers of this kind expect.
MAX_ITEMS = 1000
MAX_BYTES = 4 * 1024 * 1024
HOSTED_MAX_BYTES = 65536
TIMEOUT_MS = 60_000
MAX_RETRIES = 2
MIN_BACKOFF_MS = 500
MAX_BACKOFF_MS = 60_000
MAX_JITTER_MS = 500
DEFAULT_LABELS = "agent=logbarge\napp={app}\nhost={host}"
DEFAULT_METADATA = "level=%level\nthread=%thread\nlogger=%logger\n*=%%mdc\n*=%%kvp"
DEFAULT_MESSAGE = "[%thread] %logger{20} - %msg%n"

# Rows of one contiguous run of positions handled by one task (see operators/position.py).
BLOCK_ROWS = 1 << 18

_SESSION = {
    # event time is epoch based, so wall-clock columns must be read as UTC
    "spark.sql.session.timeZone": "UTC",
    # a later label of the same name replaces the value and keeps the first position
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Bytes of rows that go to a Python worker at a time; Spark's 64 MB are there several times over in each task.
_ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options every operator needs on an existing session."""
    for key, value in _SESSION.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    key, most = _ARROW_BYTES
    now = spark.conf.get(key, None)
    if now is None or not now.isdigit() or not 0 < int(now) <= most:
        spark.conf.set(key, str(most))
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "logbarge") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder


def own_shared_folder(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """For one machine: name a fresh folder where the session names none. A cluster must name its own."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        return spark
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.conf.set("spark.checkpoint.dir", folder or tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark

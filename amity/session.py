"""Spark session settings and shared paths.

Everything in ``amity.operators`` is a lazy DataFrame; this module only holds
the session knobs the operators are written against (adaptive execution, skew
splitting), which ``build_session`` sets on sessions of its own and nothing
sets on a caller's, and paths under the folder that the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written against. AQE re-plans joins at runtime
# (broadcast when a side turns out small, split skewed partitions, coalesce
# tiny ones); the skew split is what keeps a hub user or a hot business from
# landing in one task on joins we do not split by hand.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # sort-merge -> shuffled hash join only when every build partition is
    # below this size (checked at runtime from the shuffle statistics)
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "amity",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass ``master=None``
    and let spark-submit supply master, memory and partition counts."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(ADAPTIVE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``. Where it is
    missing, a local session (tests, a laptop) gets a scratch folder of its
    own; a cluster session is refused: its machines share no local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder all executors share")
        root = tempfile.mkdtemp(prefix="amity-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder. What is written there belongs to
    the caller, who removes it when the DataFrames on it are done."""
    return f"{shared_folder(spark)}/amity-{name}-{uuid.uuid4().hex}"


def write_text_lines(lines: DataFrame, path: str) -> str:
    """Write a ``value`` column as text files under ``path``; returns it."""
    lines.select("value").write.mode("error").text(path)
    return path

"""Shared helpers: input tables, written intermediate tables, temporary names.

Intermediate tables are Parquet folders under the folder the session names in
``spark.checkpoint.dir`` (a shared file system on a cluster), so a lost
executor never takes the only copy of a result with it. They are scratch: the
folder's owner sweeps them, as with Spark's own checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where the setting is missing, a
    local session (tests) gets a scratch folder of its own; a cluster session
    is refused, since a machine-local folder would lose rows there."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder all executors share")
        root = tempfile.mkdtemp(prefix="amity-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/amity-llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: the
    lineage is cut and every later branch scans only the columns it needs.
    ``options`` are the writer's (a codec, say)."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has it (Spark compares
    names without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def col_ref(name: str) -> str:
    """A column name quoted for expressions."""
    return "`" + name.replace("`", "``") + "`"

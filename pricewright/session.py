"""Session and job-hygiene helpers.

Everything here is configuration a Spark user would set; nothing replaces a
Spark component.  The cluster owns its checkpoint folder: we read
``spark.checkpoint.dir`` from the session and only invent one for local runs
(tests, the bench), never on a cluster.
"""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Row bound under which a side may be broadcast explicitly.  Anything without a
# proven bound is left to AQE, which converts a join to broadcast only after the
# runtime size of the small side is known.
BROADCAST_MAX_ROWS = 200_000


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "pricewright") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PRICEWRIGHT_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` must be set to shared storage; we
    refuse to fall back to a machine-local folder there.  In local mode (tests,
    bench) an unset value is replaced by a fresh scratch folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage (HDFS/S3/ABFS)")
    d = tempfile.mkdtemp(prefix="pricewright-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of finished jobs when the driver's garbage
    collector finds them unreachable.  Jobs of many rounds ask for that after a
    round, so that the disks hold the files of one round, not of all."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table as Parquet in the shared folder: compressed, for what is large
    or read many times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_table(df: DataFrame, row_bytes: int, part_bytes: int = 32 << 20) -> DataFrame:
    """The table that many fits read: written once to the shared folder, in
    partitions of about ``part_bytes``.  Iterative fits run a job for each step,
    so partitions far smaller than that only add task overhead."""
    out = cut_lineage(df)
    parts = max(1, -(-out.count() * row_bytes // part_bytes))
    return out if out.rdd.getNumPartitions() <= parts else cut_lineage(out.coalesce(parts))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate files."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

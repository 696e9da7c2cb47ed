"""Session defaults and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "clanweave") -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the one the cluster provides."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


#: Scratch paths made by this process, by application; ``release`` deletes them.
_MADE: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a folder of its own; on a cluster a machine-local folder
    would be lost with its executor, so an unset value is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="clanweave-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the scratch tables this process has made, at the end of a job whose results are written; returns their number."""
    made, count = _MADE.pop(spark.sparkContext.applicationId, []), 0
    for path in made:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        count += bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))
    return count


def by_key(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that grows with the input: the join deals both sides by key and never sends one through the driver.

    Spark takes the bytes of files for those in memory, so millions of packed or exploded rows would pass for a small side.
    """
    return df.hint("merge")


def materialize(df: DataFrame, tag: str = "step") -> DataFrame:
    """Write ``df`` once to the shared scratch area and continue from the files.

    Cuts the lineage, survives the loss of executors, is computed once, and gives the optimizer real
    sizes (so joins with it are broadcast only when the files are below the session's threshold).
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

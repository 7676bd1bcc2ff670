"""Session helpers: where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one machine, may fall back on a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="trasvase-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder nobody has written to yet."""
    return f"{shared_dir(spark)}/trasvase/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files, it does not recompute the chain) and gives the next
    join true sizes to choose its strategy from.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by key over as many tasks as ``spark.sql.shuffle.partitions`` says, before they are summed by these keys.

    Where keys hardly repeat, sums before the exchange hold every row and save none. And tasks of few packed bytes are put
    together by adaptive execution, however much their sums take in memory, unless their number is given.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)

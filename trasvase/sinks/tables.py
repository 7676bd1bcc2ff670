"""Writing: full refresh, history of moves, delimited exports, one output per store."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trasvase.schemas import MOVIMIENTOS, MOVIMIENTOS_HISTORICO, TABLES, conform
from trasvase.session import scratch_path, stored
from trasvase.sources.tables import FOLDERS_AT_ONCE, read_delimited

#: Tables written side by side in an export.
EXPORTS_AT_ONCE = 8


def refresh(df: DataFrame, root: str, table: str) -> None:
    """Replace a whole table, by column name."""
    conform(df, TABLES[table]).write.mode("overwrite").parquet(f"{root}/{table}")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty tables with the fixed schemas, where there are none yet. The move store begins with its first run."""
    for name, schema in TABLES.items():
        if name in ("movimientos", "movimientos_historico"):
            continue
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/{name}")


def published_moves(move_table: DataFrame) -> DataFrame:
    """The twelve columns of the move table that are kept for good."""
    return conform(
        move_table.withColumnsRenamed(
            {
                "NOMBRE_PRODUCTO": "NOMPRODUIT", "COLOR": "LIBCOLORIS",
                "CODIGO_PRODUCTO": "CODEPRODUIT", "CODIGO_COLOR": "CODECOLORIS",
            }
        ),
        MOVIMIENTOS,
    )


def stamped(moves: DataFrame, run_date: datetime.date) -> DataFrame:
    """Moves with the date, ISO year and ISO week they were proposed in."""
    day = F.lit(run_date)
    return moves.withColumns(
        {
            "RUN_DATE": day,
            "ANO_ISO": F.extract(F.lit("YEAROFWEEK"), day).cast("int"),
            "SEMANA": F.weekofyear(day).cast("int"),
        }
    ).select(*MOVIMIENTOS_HISTORICO.names)


def archive_moves(moves: DataFrame, root: str, run_date: datetime.date) -> None:
    """Add a run's moves to the move store. A rerun replaces the moves of its own date only.

    The run is noted in a table of its own, so that a run without moves counts as the latest one too.
    """
    partition = f"RUN_DATE={run_date.isoformat()}"
    rows = stamped(moves, run_date).drop("RUN_DATE")
    rows.write.mode("overwrite").parquet(f"{root}/movimientos_historico/{partition}")
    runs = moves.sparkSession.createDataFrame([(run_date,)], RUNS)
    runs.write.mode("overwrite").parquet(f"{root}/ejecuciones/{run_date.isoformat()}")


RUNS = "RUN_DATE date"


def _runs(spark: SparkSession, root: str) -> tuple[DataFrame, datetime.date]:
    """All runs' moves, and the date of the latest run."""
    runs = spark.read.schema(MOVIMIENTOS_HISTORICO).parquet(f"{root}/movimientos_historico")
    dates = spark.read.schema(RUNS).option("recursiveFileLookup", "true").parquet(f"{root}/ejecuciones")
    return runs, dates.agg(F.max("RUN_DATE")).first()[0]


def move_store(spark: SparkSession, root: str) -> DataFrame:
    """All runs' moves; ES_ACTUAL marks those of the latest run."""
    runs, latest = _runs(spark, root)
    return runs.withColumn("ES_ACTUAL", F.col("RUN_DATE") == F.lit(latest))


def current_moves(spark: SparkSession, root: str) -> DataFrame:
    """Moves of the latest run; reads that run's partition only."""
    runs, latest = _runs(spark, root)
    return runs.filter(F.col("RUN_DATE") == F.lit(latest)).select(*MOVIMIENTOS.names)


def moves_history(spark: SparkSession, root: str) -> DataFrame:
    """Moves of earlier runs, with the week they were proposed in."""
    runs, latest = _runs(spark, root)
    return runs.filter(F.col("RUN_DATE") < F.lit(latest))


def write_delimited(df: DataFrame, path: str) -> None:
    """``;``-separated text with a header."""
    df.write.mode("overwrite").option("sep", ";").option("header", "true").csv(path)


def _write_folders(moves: DataFrame, path: str, mode: str, last: bool) -> None:
    """One folder per sender. Folders take time, not bytes, so the number of tasks is given: adaptive execution would put these few bytes into a few tasks."""
    tasks = int(moves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        moves.withColumn("CENTRO", F.col("EMISOR"))
        .repartitionByRange(tasks, "CENTRO", "RECEPTOR", "CODIGO_PRODUCTO", "CODIGO_COLOR")
        .write.mode(mode)
        .option("sep", ";")
        .option("header", "true")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(last).lower())
        .partitionBy("CENTRO")
        .csv(path)
    )


def write_run(moves: DataFrame, root: str, run_date: datetime.date, folders_at_once: int = FOLDERS_AT_ONCE) -> None:
    """A run's move sheet under its own date, one folder per sender; sheets of earlier dates stay.

    The driver holds the folders of a job until it is committed. So senders are dealt out over as many jobs as give each about
    ``folders_at_once``; the last one marks the sheet as whole (``_SUCCESS``).
    """
    path = f"{root}/run_date={run_date.isoformat()}"
    moves = stored(moves, "sheet-moves")  # counted, sampled and written
    batches = -(-moves.select("EMISOR").distinct().count() // folders_at_once)
    if batches < 2:
        return _write_folders(moves, path, "overwrite", True)
    tasks = int(moves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = scratch_path(moves.sparkSession, "sheet-batches")
    dealt_out = moves.withColumn("TANDA", F.pmod(F.xxhash64("EMISOR"), F.lit(batches)).cast("int"))
    dealt_out.repartitionByRange(tasks, "TANDA", "EMISOR", "RECEPTOR").write.partitionBy("TANDA").parquet(apart)
    dealt_out = moves.sparkSession.read.schema(dealt_out.schema).parquet(apart)
    for batch in range(batches):
        mine = dealt_out.filter(F.col("TANDA") == batch).drop("TANDA")
        _write_folders(mine, path, "append" if batch else "overwrite", batch == batches - 1)


def write_named_lines(lines: DataFrame, folder: str, name: str, order: list[str], text: str) -> None:
    """One text file for each value of ``name``, called so, with its lines (``text``) in order.

    Spark chooses the names of the files it writes, so they are renamed in the end, by the driver, one by one.
    """
    rows = lines.repartition(name).sortWithinPartitions(name, *order)
    rows.select(name, text).write.partitionBy(name).text(f"{folder}/_written")
    jvm = lines.sparkSession._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{folder}/_written")
    files = root.getFileSystem(lines.sparkSession._jsc.hadoopConfiguration())
    for part in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/_written/{name}=*/part-*")):
        value = part.getPath().getParent().getName().partition("=")[2]
        files.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(f"{folder}/{value}"))


def write_digest(lines: DataFrame, path: str) -> None:
    """HTML lines to one folder per store. A long digest spans several files; in name order they are the page."""
    order = ["CENTRO", "OTRO", "ITEM", "LINEA"]
    (
        lines.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("CENTRO", "HTML")
        .write.mode("overwrite")
        .partitionBy("CENTRO")
        .text(path)
    )


def write_stuck(stuck: DataFrame, path: str) -> None:
    write_delimited(stuck, path)


def export_tables(spark: SparkSession, root: str) -> list[str]:
    """Every table and view of the session catalogue as ``;`` CSV, by jobs that run side by side. Returns the names.

    The driver holds the names; each table is a job of its own, so one that fails leaves the others whole and is raised in the end.
    """
    names = [entry.name for entry in spark.catalog.listTables()]
    with ThreadPoolExecutor(EXPORTS_AT_ONCE) as pool:
        jobs = [pool.submit(write_delimited, spark.table(name), f"{root}/{name}") for name in names]
    for job in jobs:
        job.result()
    return names


def exported(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """What the files of exported tables hold, one row a table: TABLA, FILAS and CELDAS (its cells that are not empty)."""
    parts = []
    for name in names:
        rows = read_delimited(spark, f"{root}/{name}")
        cells = sum((F.col(f"`{c}`").isNotNull().cast("long") for c in rows.columns), F.lit(0).cast("long"))
        parts.append(rows.agg(F.lit(name).alias("TABLA"), F.count("*").alias("FILAS"), F.coalesce(F.sum(cells), F.lit(0)).alias("CELDAS")))
    return functools.reduce(DataFrame.unionByName, parts)


def write_ordered(rows: DataFrame, path: str) -> None:
    """Rows in the order they are sorted in, as a listing whose files, by name, are the whole in order.

    A sort deals ranges out to tasks, one file each or several in a row; nothing passes through one task.
    """
    rows.write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A listing with POSICION, the place (from 1) of each row: rows of the files before, and the place in the file."""
    rows = spark.read.schema(schema).parquet(path)
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    ahead = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one number a file
    files = rows.groupBy("_file").agg(F.count("*").alias("_rows"))
    files = files.select("_file", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead"))
    return rows.join(files, "_file").withColumn("POSICION", F.col("_ahead") + F.col("_row") + 1).drop("_file", "_row", "_ahead")


def register(spark: SparkSession, root: str) -> list[str]:
    """The stored tables as temp views, for SQL text."""
    found = []
    for name in TABLES:
        try:
            table(spark, root, name).createOrReplaceTempView(name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            found.append(name)
    return found

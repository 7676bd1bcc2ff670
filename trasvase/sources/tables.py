"""Delimited files, ranking and photo sheets, remote tables, literal lists."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trasvase.schemas import FOTOS_PRODUCTOS, HOJA_MOVIMIENTOS, conform
from trasvase.session import scratch_path

# Folders of one sender each that a job writes or a table is read from, about; the driver holds them all.
FOLDERS_AT_ONCE = 10_000

# Headings of a photo sheet.
PHOTO_HEADINGS = {"EAN": "EAN", "Code Produit": "CODEPRODUIT", "Code Coloris": "CODECOLORIS",
                  "additional_image.$.url_1": "URL_FOTO"}


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """``;``-separated file with a header, matched to ``schema`` by column name."""
    raw = spark.read.option("sep", ";").option("header", "true").csv(path)
    return raw if schema is None else conform(raw, schema)


def delimited_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A ``;``-separated file as a relation SQL text can name."""
    table = spark.read.option("sep", ";").option("header", "true").csv(path)
    table.createOrReplaceTempView(name)
    return table


def stack_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column one of them lacks is null there."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def ranking_sheets(spark: SparkSession, paths: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """The ranking sheets that can be opened, and of the others RUTA and MOTIVO, the name of the error."""
    sheets, skipped = [], []
    for path in paths:
        try:
            sheets.append(spark.read.parquet(path) if path.endswith(".parquet") else read_delimited(spark, path))
        except AnalysisException as error:
            skipped.append((path, error.getCondition()))
    return sheets, spark.createDataFrame(skipped, "RUTA string, MOTIVO string")


def read_ranking(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Ranking sheets delivered as ``;`` CSV or Parquet, stacked by column name; ``ranking_sheets`` says which were skipped."""
    sheets, skipped = ranking_sheets(spark, paths)
    if not sheets:
        reasons = ", ".join(f"{row.RUTA}: {row.MOTIVO}" for row in skipped.collect())
        raise ValueError(f"no readable ranking sheet ({reasons})")
    return stack_by_name(sheets)


def _sender_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders of senders below ``path``, as the file system lists them, a page at a time where it has pages."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = []
    if files.exists(root):
        entries = files.listStatusIterator(root)
        while entries.hasNext():
            name = entries.next().getPath().getName()
            if name.startswith("CENTRO="):
                names.append(name)
    return names


def _typed_sheet(sheet: DataFrame) -> DataFrame:
    return sheet.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in HOJA_MOVIMIENTOS.fields])


def read_move_sheet(spark: SparkSession, path: str, folders_at_once: int = FOLDERS_AT_ONCE) -> DataFrame:
    """A move sheet, as written or after moves were deleted from it by hand. A value of another type is an error.

    A table keeps every file it is read from on the driver. So a sheet of more than ``folders_at_once`` folders of senders is read that many at
    a time into a table of few files; the driver holds the names of the folders only.
    """
    folders = _sender_folders(spark, path)
    if len(folders) <= folders_at_once:
        return _typed_sheet(read_delimited(spark, path))
    heads = StructType([StructField(name, StringType()) for name in read_delimited(spark, f"{path}/{folders[0]}").columns])
    whole = scratch_path(spark, "sheet-read")
    # in a session of its own, folders are not looked into by a task each (up to 10,000), and what was found in them is not kept
    apart = spark.newSession()
    apart.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.conf.get("spark.sql.shuffle.partitions"))
    apart.conf.set("spark.sql.hive.filesourcePartitionFileCacheSize", "0")
    for at in range(0, len(folders), folders_at_once):
        mine = [f"{path}/{name}" for name in folders[at : at + folders_at_once]]
        sheet = apart.read.schema(heads).option("sep", ";").option("header", "true").csv(mine)
        sheet.write.mode("append").parquet(whole)
    return _typed_sheet(spark.read.schema(heads).parquet(whole))


def read_photos(spark: SparkSession, path: str) -> DataFrame:
    """Photo sheet as ``;`` CSV: four columns by their headings, whatever their order or case."""
    sheet = read_delimited(spark, path)
    found = {name.strip().upper(): name for name in sheet.columns}
    missing = [head for head in PHOTO_HEADINGS if head.upper() not in found]
    if missing:
        raise ValueError(f"photo sheet without {', '.join(missing)}")
    chosen = [sheet[f"`{found[head.upper()]}`"].alias(name) for head, name in PHOTO_HEADINGS.items()]
    return conform(sheet.select(*chosen), FOTOS_PRODUCTOS)


def read_remote(
    spark: SparkSession,
    url: str,
    table: str,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A warehouse table over JDBC. Filters and column lists on the result are pushed to the warehouse.

    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in ``options`` read it in parallel.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {})).load()


def code_list(spark: SparkSession, codes: Iterable[str], name: str) -> DataFrame:
    """A literal list of codes as a one-column table without repeats."""
    schema = StructType([StructField(name, StringType(), False)])
    return spark.createDataFrame([(str(code),) for code in dict.fromkeys(codes)], schema)

"""Daily sales files: which to read, reading them as one table, and what could not be read."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trasvase.functions.sales import cents_to_currency, in_file_scope, sale_date, whole_number
from trasvase.schemas import VENTAS_FICHERO, conform
from trasvase.session import stored

REQUIRED_COLUMNS = ("FECHA", "HORA", "TIENDA", "IMPORTE")

#: Why a file or a line is not among the good ones, and what good lines have instead.
EMPTY, NO_COLUMNS, TWICE = "FICHERO VACIO", "FALTAN COLUMNAS", "COLUMNAS REPETIDAS"
BROKEN, UNREADABLE, GOOD = "CAMPOS DE MAS O DE MENOS", "VALOR ILEGIBLE", "CORRECTA"

#: How the cells of a line are read; the rest are text.
READERS = {
    "FECHA": sale_date, "HORA": whole_number, "FECHA_ORIG": sale_date, "HORA_ORIG": whole_number, "VENTA_DIRECTA": whole_number,
    "DEVOLUCION": whole_number, "CONFIRMACION": whole_number, "PEDIDO": whole_number, "ANULACION": whole_number, "IMPORTE": cents_to_currency,
}


@dataclass(frozen=True)
class SalesScan:
    """``files``: RUTA, ARCHIVO, CABECERA and MOTIVO, null for a file that is read. ``lines``: theirs, as text, stacked by column
    name, with the whole line in MALFORMADA if its fields are more or fewer than the header's."""

    files: DataFrame
    lines: DataFrame


def sales_file_scope(files: DataFrame, after: str, until: str, name: str = "ARCHIVO") -> DataFrame:
    """Rows of ``files`` whose file name is a dated sales file of the window: ``after`` excluded, ``until`` included."""
    return files.filter(in_file_scope(F.col(name), after, until))


def sales_files(spark: SparkSession, folders: Sequence[str], after: str, until: str) -> DataFrame:
    """RUTA, URI and ARCHIVO of the sales files of the window. Only the listing is read; a folder that does not exist is skipped."""
    found = spark.createDataFrame([], "RUTA string, URI string, ARCHIVO string")
    for folder in folders:
        try:
            listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            found = found.unionByName(
                listing.select(F.col("path").alias("RUTA"), F.col("_metadata.file_path").alias("URI"), F.col("_metadata.file_name").alias("ARCHIVO"))
            )
    return sales_file_scope(found, after, until)


def list_sales_files(spark: SparkSession, folders: Sequence[str], after: str, until: str) -> list[str]:
    """Paths of the sales files of the window."""
    return sorted(row.RUTA for row in sales_files(spark, folders, after, until).collect())


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Column names of each file (URI, CABECERA), from its first line that is not blank; no row for a file without one.

    One job for all files: the first line is the first of the block that begins a file.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("URI"), F.col("_metadata.file_block_start").alias("INICIO"),
        F.monotonically_increasing_id().alias("N"), F.regexp_replace("value", "^\ufeff", "").alias("LINEA"),
    )
    first = lines.filter((F.col("INICIO") == 0) & (F.trim("LINEA") != "")).groupBy("URI").agg(F.min_by("LINEA", "N").alias("LINEA"))
    names = F.transform(F.split("LINEA", ";", -1), lambda name: F.regexp_replace(F.trim(name), '^"|"$', ""))
    return first.select("URI", names.alias("CABECERA"))


def _why_skipped() -> Column:
    head = F.col("CABECERA")
    return (
        F.when(head.isNull(), EMPTY)
        .when(F.size(F.array_except(F.array(*map(F.lit, REQUIRED_COLUMNS)), head)) > 0, NO_COLUMNS)
        .when(F.size(F.array_distinct(head)) < F.size(head), TWICE)
    )


def scan_sales_files(spark: SparkSession, folders: Sequence[str], after: str, until: str) -> SalesScan | None:
    """The sales files of the window, with the reason for each that is skipped, and all lines of the others. None without any file.

    Files are grouped by header, and each group is one scan. The driver holds the paths, as any scan of them does.
    """
    listed = sales_files(spark, folders, after, until)
    paths = [row.RUTA for row in listed.collect()]
    if not paths:
        return None
    files = stored(listed.join(file_headers(spark, paths), "URI", "left").withColumn("MOTIVO", _why_skipped()), "sales-files")
    groups = files.filter(F.col("MOTIVO").isNull()).groupBy("CABECERA").agg(F.sort_array(F.collect_list("RUTA")).alias("RUTAS")).collect()
    shape = StructType([*VENTAS_FICHERO.fields, StructField("MALFORMADA", StringType(), True)])
    scans = [spark.createDataFrame([], shape)]
    for head, members in sorted((tuple(row.CABECERA), row.RUTAS) for row in groups):
        schema = StructType([StructField(name, StringType(), True) for name in (*head, "MALFORMADA")])
        # pruned columns would hide the fields a line has too many or too few
        reader = spark.read.option("sep", ";").option("header", "true").option("columnPruning", "false")
        scan = reader.option("columnNameOfCorruptRecord", "MALFORMADA").schema(schema).csv(members)
        scans.append(conform(scan.withColumn("ARCHIVO", F.col("_metadata.file_name")), shape))
    return SalesScan(files, functools.reduce(DataFrame.unionByName, scans))


def read_sales_files(spark: SparkSession, folders: Sequence[str], after: str, until: str) -> DataFrame | None:
    """All sales lines of the window as text columns, stacked by column name. None when there is no valid file."""
    scan = scan_sales_files(spark, folders, after, until)
    if scan is None or scan.files.filter(F.col("MOTIVO").isNull()).isEmpty():
        return None
    return scan.lines.drop("MALFORMADA")


def unreadable_cells() -> Column:
    """Cells of a line that hold something that cannot be read: COLUMNA and VALOR of each."""
    cells = [
        F.when((F.trim(name) != "") & read(F.col(name)).isNull(), F.struct(F.lit(name).alias("COLUMNA"), F.col(name).alias("VALOR")))
        for name, read in READERS.items()
    ]
    return F.array_compact(F.array(*cells))


def checked_lines(lines: DataFrame) -> DataFrame:
    """``lines`` of a scan with ILEGIBLES, their unreadable cells, and MOTIVO: whether the line is good, broken or has such a cell."""
    marked = lines.withColumn("ILEGIBLES", unreadable_cells())
    why = F.when(F.col("MALFORMADA").isNotNull(), BROKEN).when(F.size("ILEGIBLES") > 0, UNREADABLE).otherwise(GOOD)
    return marked.withColumn("MOTIVO", why)


def rejected_cells(lines: DataFrame) -> DataFrame:
    """A row for each broken line (its text) and each unreadable cell of the others: ARCHIVO, MOTIVO, COLUMNA, VALOR."""
    marked = checked_lines(lines).filter(F.col("MOTIVO") != GOOD)
    broken = F.array(F.struct(F.lit(None).cast("string").alias("COLUMNA"), F.col("MALFORMADA").alias("VALOR")))
    cells = F.when(F.col("MOTIVO") == BROKEN, broken).otherwise(F.col("ILEGIBLES"))
    return marked.select("ARCHIVO", "MOTIVO", F.explode(cells).alias("C")).select("ARCHIVO", "MOTIVO", "C.*")


def reading_summary(spark: SparkSession, scan: SalesScan) -> DataFrame:
    """Lines of every file by what became of them (ARCHIVO, MOTIVO, LINEAS); together they are all lines of all files.

    A line of a skipped file has the file's reason; its header is not counted, and an empty file has no lines.
    """
    kept = checked_lines(scan.lines).groupBy("ARCHIVO", "MOTIVO").agg(F.count("*").alias("LINEAS"))
    skipped = scan.files.filter(F.col("MOTIVO").isNotNull()).select("RUTA", "URI", "ARCHIVO", "MOTIVO")
    paths = [row.RUTA for row in skipped.select("RUTA").collect()]
    if not paths:
        return kept
    text = spark.read.text(paths).filter(F.trim("value") != "").groupBy(F.col("_metadata.file_path").alias("URI")).agg((F.count("*") - 1).alias("LINEAS"))
    whole = skipped.join(text, "URI", "left").select("ARCHIVO", "MOTIVO", F.coalesce("LINEAS", F.lit(0).cast("long")).alias("LINEAS"))
    return kept.unionByName(whole)

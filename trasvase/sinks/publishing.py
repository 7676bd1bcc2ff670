"""Publishing a run's tables as a whole, declared keys and seeds.

A run writes its tables under a folder of its own and, when all are there, one manifest file. Readers take the latest
manifest, so they see all tables of a run or all of the one before; a run that fails leaves files that nobody reads.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trasvase.schemas import TABLES, conform
from trasvase.sources.tables import read_delimited

MANIFEST = "VERSION long, TABLA string, FILAS long"

# The columns that name a row of a table once.
KEYS = {
    "centros": ("CODIGO_TIENDA",),
    "stock": ("CODEMAGASIN", "CODEINTERNEARTICLE"),
    "productos_procesar": ("CODEPRODUIT", "CODECOLORIS"),
}

#: Why a row breaks its table's key.
NO_KEY, REPEATED = "CLAVE VACIA", "CLAVE REPETIDA"


class KeysBroken(ValueError):
    """Rows without a key, or with that of another row; nothing was published."""


def key_violations(rows: DataFrame, table: str) -> DataFrame:
    """Keys of ``rows`` that are incomplete or not theirs alone: TABLA, CLAVE (its values, null as it is), FILAS and MOTIVO."""
    keys = list(KEYS[table])
    missing = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1
    why = F.when(missing, NO_KEY).when(F.col("FILAS") > 1, REPEATED)
    found = rows.groupBy(*keys).agg(F.count("*").alias("FILAS")).withColumn("MOTIVO", why).filter(F.col("MOTIVO").isNotNull())
    clave = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return found.select(F.lit(table).alias("TABLA"), clave.alias("CLAVE"), "FILAS", "MOTIVO")


def _versions(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{root}/manifests")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def current_version(spark: SparkSession, root: str) -> int | None:
    """The latest version all of whose tables are there; None before the first."""
    return _versions(spark, root).agg(F.max("VERSION")).first()[0]


def write_version(tables: Mapping[str, DataFrame], root: str, version: int) -> None:
    """The tables of a version, by column name. Nobody reads them before ``commit_version``."""
    for name, rows in tables.items():
        (conform(rows, TABLES[name]) if name in TABLES else rows).write.mode("overwrite").parquet(f"{root}/versions/{version}/{name}")


def commit_version(spark: SparkSession, root: str, version: int, names: list[str]) -> None:
    """Make a written version the current one, with one file. A broken key is an error and the version before stays."""
    counts = []
    for name in names:
        rows = version_table(spark, root, version, name)
        if name in KEYS and not (broken := key_violations(rows, name)).isEmpty():
            raise KeysBroken(f"{name}: {broken.count()} keys, such as {broken.first().CLAVE!r}")
        counts.append((version, name, rows.count()))
    spark.createDataFrame(counts, MANIFEST).coalesce(1).write.parquet(f"{root}/manifests/{version}")


def publish_version(tables: Mapping[str, DataFrame], root: str) -> int:
    """Write and commit the next version; returns its number."""
    spark = next(iter(tables.values())).sparkSession
    version = (current_version(spark, root) or 0) + 1
    write_version(tables, root, version)
    commit_version(spark, root, version, list(tables))
    return version


def version_table(spark: SparkSession, root: str, version: int, name: str) -> DataFrame:
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{root}/versions/{version}/{name}")


def current_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as of the latest whole version."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published in {root}")
    return version_table(spark, root, version, name)


def load_seeds(spark: SparkSession, files: Mapping[str, str], root: str) -> DataFrame:
    """Publish ``;`` CSV files as the first tables, by name (stores, distances, photos). Broken keys are returned as rows, and then nothing is published."""
    tables = {name: read_delimited(spark, path, TABLES[name]) for name, path in files.items()}
    broken = spark.createDataFrame([], "TABLA string, CLAVE string, FILAS long, MOTIVO string")
    for name, rows in tables.items():
        if name in KEYS:
            broken = broken.unionByName(key_violations(rows, name))
    if broken.isEmpty():
        publish_version(tables, root)
    return broken

"""The domain tables as views on the given tables (``FIXTURES.md`` has the mapping)."""

from __future__ import annotations

import datetime
import functools
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trasvase.operators.assortment import RANKING_COLUMNS, SHORT_SUPPLY
from trasvase.operators.sales import sales_between
from trasvase.operators.stock import stock_pivot, stock_position
from trasvase.plans.weekly import sales_window
from trasvase.session import stored

# Schemas of the given tables in use, so that reading one does not first open its files to infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
}

#: Day of the run: the KPIs look back from its start.
ASOF = datetime.date(2001, 10, 1)


def travel_minutes(origin: Column, destination: Column) -> Column:
    """Minutes between two stores by their codes; no route from a store to itself."""
    a, b = origin.cast("bigint"), destination.cast("bigint")
    return F.when(a != b, ((a * 37 + b * 53) % 170 + 4).cast("int"))


class Given:
    """Domain tables of one data folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def centros(self) -> DataFrame:
        nation, region = self._read("nation"), self._read("region")
        return (
            self._read("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").cast("string").alias("CODIGO_TIENDA"),
                F.col("s_name").alias("NOMBRE_TIENDA"),
                F.col("r_name").alias("CLUSTER"),
                F.expr("CASE WHEN s_acctbal >= 6000 THEN 'G' WHEN s_acctbal >= 2500 THEN 'M' ELSE 'P' END").alias("CATEGORIA"),
                (F.col("s_acctbal") >= 0).alias("TIENE_PERSONAL"),
            )
        )

    @cached_property
    def productos(self) -> DataFrame:
        return self._read("part").selectExpr(
            "'S' || CAST(p_size % 8 AS STRING) AS TEMPORADA",
            "p_brand AS COLLECTION",
            "p_type AS FAMILIA",
            "CAST(floor(p_partkey / 8) AS INT) AS CODEPRODUIT",
            "CAST(floor(p_partkey / 4) AS INT) % 2 AS CODECOLORIS",
            "'P-' || CAST(CAST(floor(p_partkey / 8) AS INT) AS STRING) AS NOMPRODUIT",
            "'C' || CAST(CAST(floor(p_partkey / 4) AS INT) % 2 AS STRING) AS LIBCOLORIS",
            "CAST(p_partkey AS STRING) AS CODEBARRES",
            "CAST(p_partkey AS STRING) AS CODEINTERNEARTICLE",
            "CASE p_partkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'M' WHEN 2 THEN 'L' ELSE 'XL' END AS TAILLE",
        )

    @cached_property
    def ventas(self) -> DataFrame:
        """All sales; a line has a quantity sold or one returned, and the other is null."""
        return self._read("lineitem").selectExpr(
            "CAST(l_suppkey AS STRING) AS CODIGO_TIENDA",
            "CAST(l_partkey AS STRING) AS EAN",
            "l_shipdate AS FECHA_HORA",
            "CASE WHEN l_returnflag <> 'R' THEN CAST(ceil(l_quantity / 10) AS INT) END AS VENTA_DIRECTA",
            "CASE WHEN l_returnflag = 'R' THEN -CAST(ceil(l_quantity / 10) AS INT) END AS DEVOLUCION",
            "round(l_extendedprice * (1 - l_discount), 2) AS IMPORTE",
        )

    @cached_property
    def recent(self) -> DataFrame:
        """Sales of the weeks the KPIs look at."""
        return sales_between(self.ventas, *sales_window(ASOF))

    @cached_property
    def ventas_raw(self) -> DataFrame:
        """Sales lines as a sales file has them: text, missing hours, impossible minutes, labels without digits."""
        returned = "l_returnflag = 'R'"
        return self._read("lineitem").selectExpr(
            "date_format(l_shipdate, 'dd/MM/yyyy') AS FECHA",
            "CASE WHEN l_linenumber <> 7 THEN CAST((l_orderkey * 7) % 24 * 100 + l_partkey % 70 AS STRING) END AS HORA",
            "CASE WHEN l_suppkey % 17 = 16 THEN 'SIN CODIGO' ELSE ' TDA ' || lpad(CAST(l_suppkey AS STRING), 5, '0') END AS TIENDA",
            "CAST(l_orderkey AS STRING) AS TALON",
            f"CASE WHEN {returned} THEN date_format(l_shipdate - INTERVAL 7 DAYS, 'dd/MM/yyyy') END AS FECHA_ORIG",
            f"CASE WHEN {returned} THEN CAST((l_orderkey * 11) % 24 * 100 + (l_partkey * 3) % 70 AS STRING) END AS HORA_ORIG",
            f"CASE WHEN {returned} THEN CAST(l_orderkey % 1000000 AS STRING) END AS TALON_ORIGINAL",
            f"CASE WHEN {returned} THEN CAST(l_suppkey % 100000 AS STRING) END AS TIENDA_ORIG",
            "CAST(l_partkey AS STRING) AS EAN",
            f"CASE WHEN NOT {returned} THEN CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING) END AS VENTA_DIRECTA",
            f"CASE WHEN {returned} THEN CAST(-CAST(ceil(l_quantity / 10) AS INT) AS STRING) END AS DEVOLUCION",
            "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) AS IMPORTE",
            "CASE WHEN l_partkey % 13 = 12 THEN 'copia_' ELSE '' END || date_format(l_shipdate, 'yyyyMMdd')"
            " || CAST(l_orderkey % 3 + 1 AS STRING) || '.csv' AS ARCHIVO",
        )

    @cached_property
    def sales_file_lines(self) -> DataFrame:
        """All sales as the lines of one file a month and kind: ARCHIVO, ORDEN (0 is the header) and LINEA.

        Files ending in 1 have one order of columns, those in 2 another without tickets, and those in 3 lack the store. Some lines have a field too many, some
        quantities and amounts are words.
        """
        shapes = {
            "1": ["FECHA", "HORA", "TIENDA", "TALON", "EAN", "VENTA_DIRECTA", "DEVOLUCION", "IMPORTE"],
            "2": ["IMPORTE", "EAN", "DEVOLUCION", "VENTA_DIRECTA", "TIENDA", "HORA", "FECHA"],
            "3": ["FECHA", "HORA", "EAN", "IMPORTE"],
        }
        rows = self._read("lineitem").selectExpr(
            "l_orderkey", "l_linenumber", "CAST(l_orderkey % 3 + 1 AS STRING) AS K", "date_format(l_shipdate, 'yyyyMM') || '01' AS MES",
            "date_format(l_shipdate, 'dd/MM/yyyy') AS FECHA", "CAST((l_orderkey * 7) % 24 * 100 + l_partkey % 60 AS STRING) AS HORA",
            "' TDA ' || lpad(CAST(l_suppkey AS STRING), 5, '0') AS TIENDA", "CAST(l_orderkey AS STRING) AS TALON", "CAST(l_partkey AS STRING) AS EAN",
            "CASE WHEN l_orderkey % 41 = 7 THEN 'dos' WHEN l_returnflag <> 'R' THEN CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING) END AS VENTA_DIRECTA",
            "CASE WHEN l_returnflag = 'R' THEN CAST(-CAST(ceil(l_quantity / 10) AS INT) AS STRING) END AS DEVOLUCION",
            "CASE WHEN l_partkey % 53 = 9 THEN 'n/d' ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) END AS IMPORTE",
            "CASE WHEN l_partkey % 37 = 5 THEN ';sobra' ELSE '' END AS SOBRA",
        )
        name = F.concat("MES", "K", F.lit(".csv")).alias("ARCHIVO")
        found = []
        for kind, columns in shapes.items():
            mine = rows.filter(F.col("K") == kind)
            line = F.concat(F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in columns]), F.col("SOBRA"))
            found.append(mine.select(name, (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ORDEN"), line.alias("LINEA")))
            found.append(mine.select(name).distinct().select("ARCHIVO", F.lit(0).cast("long").alias("ORDEN"), F.lit(";".join(columns)).alias("LINEA")))
        return functools.reduce(DataFrame.unionByName, found)

    @cached_property
    def stock_cuentas(self) -> DataFrame:
        """Stock by account; account 7 is none of those the job looks at, so some articles have no stock row."""
        return self._read("lineitem").selectExpr(
            "CAST(l_suppkey AS STRING) AS CODEMAGASIN",
            "CAST(l_partkey AS STRING) AS CODEINTERNEARTICLE",
            "CASE l_linenumber WHEN 5 THEN 7 WHEN 6 THEN 2 WHEN 7 THEN 10 ELSE 1 END AS CODECPTSTOCKMAG",
            "CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(ceil(l_quantity / 20) AS INT) AS QTEENSTOCK",
            "l_shipdate AS DATEMODIFICATION",
            "l_shipdate - make_dt_interval(l_linenumber) AS DATECREATION",
        )

    @cached_property
    def stock(self) -> DataFrame:
        """The stock table with product, colour and size of each article."""
        named = self.productos.select(
            "CODEINTERNEARTICLE", "CODEBARRES", "CODEPRODUIT", "CODECOLORIS", "NOMPRODUIT", "LIBCOLORIS", "TAILLE"
        )
        return (
            stock_position(stock_pivot(self.stock_cuentas))
            .drop("DATEMODIFICATION", "DATECREATION")
            .join(named, "CODEINTERNEARTICLE")
        )

    @cached_property
    def stored_stock(self) -> DataFrame:
        """The stock table written out, for reports that read it several times."""
        return stored(self.stock, "stock")

    @cached_property
    def ranking(self) -> DataFrame:
        held = self.stock.groupBy("CODEBARRES").agg(F.sum("TOTAL").alias("D"))
        sold = self.ventas.groupBy(F.col("EAN").alias("CODEBARRES")).agg(F.sum("VENTA_DIRECTA").alias("V"))
        totals = (
            self.productos.join(held, "CODEBARRES", "left")
            .join(sold, "CODEBARRES", "left")
            .groupBy("CODEPRODUIT", "CODECOLORIS", "NOMPRODUIT", "LIBCOLORIS")
            .agg(
                F.min("TEMPORADA").alias("TEMPORADA"),
                F.min("COLLECTION").alias("COLLECTION"),
                F.min("FAMILIA").alias("FAMILIA"),
                F.sum(F.coalesce("D", F.lit(0))).alias("disp"),
                F.sum(F.coalesce("V", F.lit(0))).alias("vendida"),
            )
        )
        return totals.selectExpr(
            "TEMPORADA", "COLLECTION", "FAMILIA", "CODEPRODUIT", "CODECOLORIS", "NOMPRODUIT", "LIBCOLORIS",
            "1 + (CODEPRODUIT * 5 + CODECOLORIS) % 8 AS SEMANAS_IMPLANTACION",
            "vendida AS CANTIDAD_VENDIDA",
            "CASE WHEN vendida = 0 THEN '#DIV/0' ELSE CAST(CAST(round(disp * 4.0 / vendida) AS INT) AS STRING) END"
            " AS SEMANAS_COBERTURA",
            "disp AS CANTIDAD_DISPONIBLE_CENTROS",
            "(CODEPRODUIT * 3) % 40 AS CANTIDAD_DISPONIBLE_ALMACENES",
            "CASE (CODEPRODUIT + CODECOLORIS) % 3 WHEN 0 THEN 'Gestion de pénurie' WHEN 1 THEN 'Rupture' ELSE 'Normal' END"
            " AS SITUACION",
        )

    @cached_property
    def ranking_sheet(self) -> DataFrame:
        """The ranking with the headings of a sheet, some with blanks around them."""
        return self.ranking.select(
            *[F.col(name).alias(f" {head} " if i % 2 else head) for i, (head, name) in enumerate(RANKING_COLUMNS.items())]
        )

    @cached_property
    def productos_procesar(self) -> DataFrame:
        """Products to process: those the ranking has as short in the depot, one row per product and colour."""
        return self.ranking.filter(F.col("SITUACION").isin(*SHORT_SUPPLY)).select(
            "TEMPORADA", "COLLECTION", "FAMILIA", "CODEPRODUIT", "CODECOLORIS", "NOMPRODUIT", "LIBCOLORIS"
        )

    @cached_property
    def fotos_productos(self) -> DataFrame:
        return self.productos.filter("CODEPRODUIT % 3 <> 0").selectExpr(
            "CODEBARRES AS EAN", "CODEPRODUIT", "CODECOLORIS",
            "'https://img.invalid/' || CAST(CODEPRODUIT AS STRING) || '-' || CAST(CODECOLORIS AS STRING) || '.jpg' AS URL_FOTO",
        )

    @cached_property
    def distancias(self) -> DataFrame:
        """Routes between stores of one cluster; between clusters there is none.

        The table has the square of the stores, so its origins are dealt out first; one file of stores would be one task.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        code = F.col("CODIGO_TIENDA")  # read as a number once a store, not once a route
        origin = self.centros.select("CLUSTER", code.alias("CODIGO_ORIGEN"), code.cast("bigint").alias("_a")).repartition(tasks, "CODIGO_ORIGEN")
        destination = self.centros.select("CLUSTER", code.alias("CODIGO_DESTINO"), code.cast("bigint").alias("_b"))
        minutes = travel_minutes(F.col("_a"), F.col("_b"))
        routes = origin.join(F.broadcast(destination), "CLUSTER").withColumn("DISTANCIA_MINUTOS", minutes)
        return routes.drop("CLUSTER", "_a", "_b").filter(F.col("DISTANCIA_MINUTOS").isNotNull())

    @cached_property
    def articles(self) -> DataFrame:
        return self._read("part").selectExpr(
            "CAST(floor(p_partkey / 8) AS INT) AS CODEPRODUIT",
            "CAST(floor(p_partkey / 4) AS INT) % 2 AS CODECOLORIS",
            "CAST(p_partkey AS STRING) AS CODEBARRES",
            "CAST(p_partkey AS STRING) AS CODEINTERNEARTICLE",
            "p_size % 3 AS CODEGRILLETAILLE",
            "CAST(p_partkey % 4 AS INT) AS INDICE",
        )

    @cached_property
    def remote_products(self) -> DataFrame:
        seasons = "array('E22','H22','E23','H23','E24','H24','E25','H25','E26','H26')"
        return (
            self._read("part")
            .groupBy(F.expr("CAST(floor(p_partkey / 8) AS INT)").alias("CODEPRODUIT"))
            .agg(F.min("p_size").alias("S"), F.min("p_type").alias("CODECLASSPROD3"))
            .selectExpr(
                "CODEPRODUIT",
                "'P-' || CAST(CODEPRODUIT AS STRING) AS NOMPRODUIT",
                f"element_at({seasons}, S % 10 + 1) AS CODESAISON",
                "CODECLASSPROD3",
            )
        )

    @cached_property
    def remote_colours(self) -> DataFrame:
        return self.productos.select("CODECOLORIS", "LIBCOLORIS").distinct()

    @cached_property
    def remote_sizes(self) -> DataFrame:
        """Size grids; grid 2 has no lines."""
        return (
            self.articles.filter("CODEGRILLETAILLE <> 2")
            .select("CODEGRILLETAILLE", "INDICE")
            .distinct()
            .withColumn("TAILLE", F.expr("element_at(array('S', 'M', 'L', 'XL'), INDICE + 1)"))
        )

    @cached_property
    def class3(self) -> DataFrame:
        """Third-level classes; type PROMO has none."""
        return (
            self._read("part")
            .select(F.col("p_type").alias("CODECLASSPROD3"))
            .distinct()
            .filter("CODECLASSPROD3 <> 'PROMO'")
            .selectExpr(
                "CODECLASSPROD3", "'Clase ' || CODECLASSPROD3 AS LIBCLASSPROD3",
                "substring(CODECLASSPROD3, 1, 1) AS CODECLASSPROD2",
            )
        )

    @cached_property
    def class2(self) -> DataFrame:
        return self.class3.selectExpr("CODECLASSPROD2", "'1' || CODECLASSPROD2 AS CODECLASSPROD1").distinct()

    @cached_property
    def class1(self) -> DataFrame:
        return self.class2.select("CODECLASSPROD1").distinct()

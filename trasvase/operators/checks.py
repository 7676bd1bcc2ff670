"""Consistency queries between sales, stock and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trasvase.functions.kpis import net_units, zero
from trasvase.operators.kpis import NAME_KEYS, product_map


def sales_totals(sales: DataFrame) -> DataFrame:
    """Units sold, returned and net per store and EAN, where the net is not 0."""
    return (
        sales.groupBy("CODIGO_TIENDA", "EAN")
        .agg(
            F.sum(zero(F.col("VENTA_DIRECTA"))).alias("VENTA_DIRECTA"),
            F.sum(zero(F.col("DEVOLUCION"))).alias("DEVOLUCION"),
        )
        .withColumn("VENTA_NETA", F.col("VENTA_DIRECTA") + F.col("DEVOLUCION"))
        .filter(F.col("VENTA_NETA") != 0)
    )


def net_totals(sales: DataFrame) -> DataFrame:
    """Net units per store and EAN, not floored."""
    return sales.groupBy("CODIGO_TIENDA", "EAN").agg(F.sum(net_units()).alias("TOTAL_VENTAS"))


def sales_without_stock(sales: DataFrame, stock: DataFrame) -> DataFrame:
    """Net sales of a store and EAN that has no stock row."""
    held = stock.select(F.col("CODEMAGASIN").alias("CODIGO_TIENDA"), F.col("CODEBARRES").alias("EAN"))
    return net_totals(sales).join(held, ["CODIGO_TIENDA", "EAN"], "left_anti")


def sales_trim_match(sales: DataFrame, stock: DataFrame) -> DataFrame:
    """Net sales and the stock rows they match once blanks around the keys are ignored."""
    held = stock.select(F.trim("CODEMAGASIN").alias("M"), F.trim("CODEBARRES").alias("B"), "CODEBARRES")
    return (
        net_totals(sales)
        .join(held, (F.trim("CODIGO_TIENDA") == F.col("M")) & (F.trim("EAN") == F.col("B")))
        .select("CODIGO_TIENDA", "EAN", "CODEBARRES", "TOTAL_VENTAS")
    )


def sales_missing_from_profile(
    sales: DataFrame, stock: DataFrame, to_process: DataFrame, profile: DataFrame
) -> DataFrame:
    """Net sales of processed products whose store and product the KPI view does not show."""
    return (
        net_totals(sales)
        .filter(F.col("TOTAL_VENTAS") != 0)
        .join(product_map(stock), "EAN")
        .join(to_process.select(*NAME_KEYS).distinct(), NAME_KEYS, "left_semi")
        .join(
            profile.select(F.col("CODEMAGASIN").alias("CODIGO_TIENDA"), *NAME_KEYS),
            ["CODIGO_TIENDA", *NAME_KEYS],
            "left_anti",
        )
        .select("CODIGO_TIENDA", "EAN", *NAME_KEYS, "TOTAL_VENTAS")
    )


def ambiguous_colours(moves: DataFrame, colour: str = "COLOR", code: str = "CODIGO_COLOR") -> DataFrame:
    """Colour names that stand for more than one colour code."""
    pairs = moves.select(colour, code).distinct()
    return pairs.groupBy(colour).agg(F.count(code).alias("CODIGOS")).filter(F.col("CODIGOS") > 1)


def ambiguous_colour_codes(moves: DataFrame, colour: str = "COLOR", code: str = "CODIGO_COLOR") -> DataFrame:
    """The codes behind each ambiguous colour name."""
    pairs = moves.select(colour, code).distinct()
    return pairs.join(ambiguous_colours(moves, colour, code).select(colour), colour, "left_semi")


def product_drilldown(stock: DataFrame, product: str, colour: str, store: str) -> DataFrame:
    """Stock rows of one product and colour in one store."""
    return stock.filter(
        (F.col("NOMPRODUIT") == product) & (F.col("LIBCOLORIS") == colour) & (F.col("CODEMAGASIN") == store)
    )


def drilldown_sales(sales: DataFrame, stock: DataFrame, product: str, colour: str, store: str) -> DataFrame:
    """Sales in one store of the EANs any store holds of one product and colour."""
    eans = stock.filter((F.col("NOMPRODUIT") == product) & (F.col("LIBCOLORIS") == colour)).select(
        F.col("CODEBARRES").alias("EAN")
    )
    return sales.filter(F.col("CODIGO_TIENDA") == store).join(eans, "EAN", "left_semi")

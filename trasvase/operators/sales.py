"""Sales: cleaning, calendar, store name, scope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trasvase.functions import sales as fx
from trasvase.schemas import VENTAS, VENTAS_FICHERO, conform


def sales_time(raw: DataFrame) -> DataFrame:
    """HHMM numbers to hour and minute, dates to DATE, and both to a timestamp, for the sale and its original."""
    return (
        raw.withColumn("MINUTO", fx.minute_of(F.col("HORA")))
        .withColumn("HORA", fx.hour_of(F.col("HORA")))
        .withColumn("MINUTO_ORIG", fx.minute_of(F.col("HORA_ORIG")))
        .withColumn("HORA_ORIG", fx.hour_of(F.col("HORA_ORIG")))
        .withColumn("FECHA", fx.sale_date(F.col("FECHA")))
        .withColumn("FECHA_ORIG", fx.sale_date(F.col("FECHA_ORIG")))
        .withColumn("FECHA_HORA", fx.sale_moment(F.col("FECHA"), F.col("HORA"), F.col("MINUTO")))
        .withColumn("FECHA_HORA_ORIG", fx.sale_moment(F.col("FECHA_ORIG"), F.col("HORA_ORIG"), F.col("MINUTO_ORIG")))
    )


def sales_calendar(timed: DataFrame) -> DataFrame:
    """Weekday number, weekday name and weekend flag of the sale and of its original."""
    return (
        timed.withColumn("DIA_SEMANA", fx.iso_weekday(F.col("FECHA_HORA")))
        .withColumn("DIA_SEMANA_NOMBRE", fx.weekday_name(F.col("DIA_SEMANA")))
        .withColumn("FIN_DE_SEMANA", fx.weekend_flag(F.col("DIA_SEMANA")))
        .withColumn("DIA_SEMANA_ORIG", fx.iso_weekday(F.col("FECHA_HORA_ORIG")))
        .withColumn("DIA_SEMANA_ORIG_NOMBRE", fx.weekday_name(F.col("DIA_SEMANA_ORIG")))
        .withColumn("FIN_DE_SEMANA_ORIG", fx.weekend_flag(F.col("DIA_SEMANA_ORIG")))
    )


def sales_store_name(sales: DataFrame, centros: DataFrame) -> DataFrame:
    """Replace the store label TIENDA by the store's code and name; a store not listed has no code."""
    stores = centros.select("CODIGO_TIENDA", "NOMBRE_TIENDA")
    return (
        sales.withColumn("TIENDA", fx.store_code(F.col("TIENDA")))
        .join(stores, F.col("TIENDA") == F.col("CODIGO_TIENDA"), "left")
        .drop("TIENDA")
        .withColumn("NOMBRE_TIENDA", F.coalesce("NOMBRE_TIENDA", F.lit(fx.UNKNOWN_STORE)))
    )


def sales_clean(raw: DataFrame, centros: DataFrame) -> DataFrame:
    """Raw sales lines (text columns, file name in ARCHIVO) to the 30-column sales table."""
    lines = sales_calendar(sales_time(conform(raw, VENTAS_FICHERO)))
    named = sales_store_name(lines, centros)
    whole = ["TALON_ORIGINAL", "TIENDA_ORIG", "VENTA_DIRECTA", "DEVOLUCION", "CONFIRMACION", "PEDIDO", "ANULACION"]
    return conform(
        named.withColumns(
            {
                "PAIS": fx.country_of_file(F.col("ARCHIVO")),
                "IMPORTE": fx.cents_to_currency(F.col("IMPORTE")),
                "FECHA": F.col("FECHA").cast("string"),
                "FECHA_ORIG": F.col("FECHA_ORIG").cast("string"),
                "FECHA_HORA": fx.moment_text(F.col("FECHA_HORA")),
                "FECHA_HORA_ORIG": fx.moment_text(F.col("FECHA_HORA_ORIG")),
                **{name: fx.whole_number(F.col(name)) for name in whole},
            }
        ),
        VENTAS,
    )


def sales_scope(sales: DataFrame, stores: DataFrame, eans: DataFrame) -> DataFrame:
    """Sales of the listed stores and EANs. A repeated entry in a list does not repeat sales."""
    return sales.join(stores.select("CODIGO_TIENDA"), "CODIGO_TIENDA", "left_semi").join(
        eans.select("EAN"), "EAN", "left_semi"
    )


def sales_between(sales: DataFrame, after: str, until: str, moment: str = "FECHA_HORA") -> DataFrame:
    """Sales of a window of days: ``after`` excluded, ``until`` included to its first moment."""
    at = F.col(moment)
    return sales.filter((at > F.lit(after).cast("timestamp_ntz")) & (at <= F.lit(until).cast("timestamp_ntz")))

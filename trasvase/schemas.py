"""Fixed table schemas. Every write selects by these names, never by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, I, L, D, B = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType()


def _struct(*fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


CENTROS = _struct(
    ("CODIGO_TIENDA", S), ("NOMBRE_TIENDA", S), ("CLUSTER", S), ("CATEGORIA", S), ("TIENE_PERSONAL", B),
    ("LAT", S), ("LON", S),
)

DISTANCIAS = _struct(("CODIGO_ORIGEN", S), ("CODIGO_DESTINO", S), ("DISTANCIA_MINUTOS", I))

PRODUCTOS = _struct(
    ("TEMPORADA", S), ("COLLECTION", S), ("FAMILIA", S), ("CODEPRODUIT", I), ("CODECOLORIS", I),
    ("NOMPRODUIT", S), ("LIBCOLORIS", S), ("CODEBARRES", S), ("CODEINTERNEARTICLE", S),
)

PRODUCTOS_PROCESAR = _struct(
    ("TEMPORADA", S), ("COLLECTION", S), ("FAMILIA", S), ("CODEPRODUIT", I), ("CODECOLORIS", I),
    ("NOMPRODUIT", S), ("LIBCOLORIS", S),
    ("SEMANAS_IMPLANTACION", I), ("CANTIDAD_VENDIDA", I), ("SEMANAS_COBERTURA", I),
    ("CANTIDAD_DISPONIBLE_CENTROS", I), ("CANTIDAD_DISPONIBLE_ALMACENES", I),
)

STOCK = _struct(
    ("CODEMAGASIN", S), ("NOMPRODUIT", S), ("CODEINTERNEARTICLE", S), ("CODEPRODUIT", I), ("LIBCOLORIS", S),
    ("CODECOLORIS", I), ("TAILLE", S), ("CODEBARRES", S),
    ("DISPONIBLE", L), ("TRANSITO", L), ("PREPARACION", L), ("TOTAL", L),
)

STOCK_CUENTAS = _struct(
    ("CODEMAGASIN", S), ("CODEINTERNEARTICLE", S), ("CODECPTSTOCKMAG", I), ("QTEENSTOCK", I),
    ("DATEMODIFICATION", TimestampNTZType()), ("DATECREATION", TimestampNTZType()),
)

FOTOS_PRODUCTOS = _struct(("EAN", S), ("CODEPRODUIT", I), ("CODECOLORIS", I), ("URL_FOTO", S))

VENTAS_FICHERO = _struct(
    ("FECHA", S), ("HORA", S), ("TIENDA", S), ("NUM_VENDEDOR", S), ("TALON", S), ("CODIGO_OPERACION", S),
    ("TALON_ORIGINAL", S), ("TIENDA_ORIG", S), ("FECHA_ORIG", S), ("HORA_ORIG", S), ("CODIGO_OPERACION_ORIG", S),
    ("EAN", S), ("VENTA_DIRECTA", S), ("DEVOLUCION", S), ("CONFIRMACION", S), ("PEDIDO", S), ("ANULACION", S),
    ("IMPORTE", S), ("ARCHIVO", S),
)

VENTAS = _struct(
    ("PAIS", S), ("CODIGO_TIENDA", S), ("NOMBRE_TIENDA", S), ("NUM_VENDEDOR", S), ("TALON", S),
    ("FECHA_HORA", S), ("FECHA", S), ("HORA", I), ("MINUTO", I),
    ("DIA_SEMANA", I), ("DIA_SEMANA_NOMBRE", S), ("FIN_DE_SEMANA", S),
    ("CODIGO_OPERACION", S), ("TALON_ORIGINAL", I), ("TIENDA_ORIG", I),
    ("FECHA_HORA_ORIG", S), ("FECHA_ORIG", S), ("HORA_ORIG", I), ("MINUTO_ORIG", I),
    ("DIA_SEMANA_ORIG", I), ("DIA_SEMANA_ORIG_NOMBRE", S), ("FIN_DE_SEMANA_ORIG", S),
    ("CODIGO_OPERACION_ORIG", S), ("EAN", S),
    ("VENTA_DIRECTA", I), ("DEVOLUCION", I), ("CONFIRMACION", I), ("PEDIDO", I), ("ANULACION", I),
    ("IMPORTE", D),
)

STOCK_VENTAS_CENTRO = _struct(
    ("CODEMAGASIN", S), ("CATEGORIA", S), ("CODEPRODUIT", I), ("CODECOLORIS", I), ("NOMPRODUIT", S),
    ("LIBCOLORIS", S),
    ("STOCK_DISPONIBLE", L), ("STOCK_TRANSITO", L), ("STOCK_PREPARACION", L), ("STOCK_TOTAL", L),
    ("VENTA_4SEMANAS", I), ("VELOCIDAD_SEMANAL_REAL", D), ("VELOCIDAD_OPERATIVA", I), ("SEMANAS_ROTACION", I),
    ("TIENE_REPOSICION", B), ("PERFIL", S),
)

MOVIMIENTOS = _struct(
    ("EMISOR", S), ("RECEPTOR", S), ("NOMPRODUIT", S), ("LIBCOLORIS", S), ("CODEPRODUIT", I), ("CODECOLORIS", I),
    ("STOCK_ANTES", L), ("APORTE", L), ("STOCK_DESPUES", L), ("COBERTURA_ANTES", I), ("COBERTURA_DESPUES", I),
    ("URL_FOTO", S),
)

HOJA_MOVIMIENTOS = _struct(
    ("EMISOR", S), ("NOMBRE_EMISOR", S), ("RECEPTOR", S), ("NOMBRE_RECEPTOR", S), ("NOMBRE_PRODUCTO", S), ("COLOR", S),
    ("TALLAS", S), ("CODIGO_PRODUCTO", I), ("CODIGO_COLOR", I), ("STOCK_INICIAL_RECEPTOR", L), ("STOCK_ANTES", L),
    ("APORTE", L), ("STOCK_DESPUES", L), ("COBERTURA_ANTES", I), ("COBERTURA_DESPUES", I), ("URL_FOTO", S),
)

MOVIMIENTOS_HISTORICO = StructType(
    [StructField("RUN_DATE", DateType(), True), StructField("ANO_ISO", I, True), StructField("SEMANA", I, True)]
    + MOVIMIENTOS.fields
)

ESTANCADOS = _struct(
    ("CODEINTERNEARTICLE", S), ("CODEMAGASIN", S), ("QTEENSTOCK", I), ("TIEMPO_ESTANCADO", I),
)

TABLES = {
    "centros": CENTROS,
    "distancias": DISTANCIAS,
    "productos": PRODUCTOS,
    "stock": STOCK,
    "fotos_productos": FOTOS_PRODUCTOS,
    "productos_procesar": PRODUCTOS_PROCESAR,
    "ventas": VENTAS,
    "stock_ventas_centro": STOCK_VENTAS_CENTRO,
    "estancados": ESTANCADOS,
    "movimientos": MOVIMIENTOS,
    "movimientos_historico": MOVIMIENTOS_HISTORICO,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order; a missing one is null, a bad value becomes null."""
    present = {name.upper(): name for name in df.columns}

    def cast(field: StructField) -> Column:
        if field.name not in present:
            value = F.lit(None).cast(field.dataType)
        else:
            value = F.col(f"`{present[field.name]}`").try_cast(field.dataType)
        return value.alias(field.name)

    return df.select(*[cast(field) for field in schema.fields])


def lost_values(df: DataFrame, schema: StructType) -> DataFrame:
    """What ``conform`` would turn to null although it holds something: COLUMNA, VALOR and how many rows (FILAS)."""
    present = {name.upper(): name for name in df.columns}
    cells = []
    for field in schema.fields:
        if field.name in present and field.dataType != S:
            value = F.col(f"`{present[field.name]}`")
            text = value.cast("string")
            lost = (F.trim(text) != "") & value.try_cast(field.dataType).isNull()
            cells.append(F.when(lost, F.struct(F.lit(field.name).alias("COLUMNA"), text.alias("VALOR"))))
    found = df.select(F.explode(F.array_compact(F.array(*cells))).alias("C")) if cells else df.limit(0).select(F.struct(F.lit("").alias("COLUMNA"), F.lit("").alias("VALOR")).alias("C"))
    return found.groupBy("C.COLUMNA", "C.VALOR").agg(F.count("*").alias("FILAS"))

"""Per-store digests of the published moves: what to send, what to receive, and both as HTML lines.

A digest is kept as ordered rows, one per item or per HTML line, so that a store with very many moves is a long run of
rows and not one huge value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trasvase.operators.lookups import NO_PHOTO

ITEM_ORDER = ["NOMBRE_PRODUCTO", "COLOR", "CODIGO_PRODUCTO", "CODIGO_COLOR"]

# Wording of the digests.
SEND_TITLE = "Traspasos a realizar para optimizar la venta."
SEND_REASON = (
    "Se ha detectado que estos productos no han tenido una buena salida en este centro y se ha recomendado su traspaso."
)
RECEIVE_TITLE = "Productos que vas a recibir."
NO_PHOTO_TEXT = "Sin foto"


def digest_send(moves: DataFrame) -> DataFrame:
    """Per sender: receivers, and under each its items, numbered."""
    items = Window.partitionBy("EMISOR", "RECEPTOR").orderBy(*ITEM_ORDER)
    return moves.select(
        "EMISOR", "NOMBRE_EMISOR", "RECEPTOR", "NOMBRE_RECEPTOR", F.row_number().over(items).alias("ITEM"),
        "NOMBRE_PRODUCTO", "CODIGO_PRODUCTO", "COLOR", "CODIGO_COLOR", "TALLAS", "URL_FOTO",
    )


def receive_totals(moves: DataFrame) -> DataFrame:
    """References and units each receiver is to get."""
    return moves.groupBy("RECEPTOR").agg(
        F.count("*").alias("REFERENCIAS"), F.sum("APORTE").alias("UNIDADES")
    )


def digest_receive(moves: DataFrame) -> DataFrame:
    """Per receiver: totals, then senders, and under each its items with units and stock after."""
    items = Window.partitionBy("RECEPTOR", "EMISOR").orderBy(*ITEM_ORDER)
    rows = moves.select(
        "RECEPTOR", "NOMBRE_RECEPTOR", "EMISOR", "NOMBRE_EMISOR", F.row_number().over(items).alias("ITEM"),
        "NOMBRE_PRODUCTO", "CODIGO_PRODUCTO", "COLOR", "CODIGO_COLOR", "TALLAS", "APORTE", "STOCK_DESPUES", "URL_FOTO",
    )
    return rows.join(receive_totals(moves), "RECEPTOR")


def _escaped(text: Column) -> Column:
    whole = F.coalesce(text.cast("string"), F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        whole = F.replace(whole, F.lit(char), F.lit(entity))
    return whole


def _photo() -> Column:
    link = F.concat(F.lit('<a class="btn" href="'), _escaped(F.col("URL_FOTO")), F.lit('">Foto</a>'))
    none = F.col("URL_FOTO").isNull() | (F.col("URL_FOTO") == NO_PHOTO)
    return F.when(none, F.lit(f'<span class="btn">{NO_PHOTO_TEXT}</span>')).otherwise(link)


def _item(*extra: tuple[str, Column]) -> Column:
    fields = [
        ("Producto", F.concat(_escaped(F.col("NOMBRE_PRODUCTO")), F.lit(" ("), _escaped(F.col("CODIGO_PRODUCTO")), F.lit(")"))),
        ("Color", F.concat(_escaped(F.col("COLOR")), F.lit(" ("), _escaped(F.col("CODIGO_COLOR")), F.lit(")"))),
        ("Tallas", _escaped(F.col("TALLAS"))),
        *extra,
    ]
    parts = [F.concat(F.lit(f"<b>{label}:</b> "), value, F.lit("<br>")) for label, value in fields]
    return F.concat(F.lit("<li>"), *parts, _photo(), F.lit("</li>"))


def _lines(items: DataFrame, store: str, other: str, head: Column, label: str, item: Column) -> DataFrame:
    """Item rows to HTML lines: an opening on a store's first item, a card around each other store, a closing."""
    cards = items.groupBy(store, other).agg(F.count("*").alias("EN_TARJETA"))
    ends = cards.groupBy(store).agg(F.min(other).alias("PRIMERO"), F.max(other).alias("ULTIMO"))
    items = items.join(cards, [store, other]).join(ends, store)
    last_of_card = F.col("ITEM") == F.col("EN_TARJETA")
    first_of_store = (F.col(other) == F.col("PRIMERO")) & (F.col("ITEM") == 1)
    last_of_store = (F.col(other) == F.col("ULTIMO")) & last_of_card
    title = F.concat(F.lit(f"<h2>{label}: "), _escaped(F.col(other)), F.lit(" - "), _escaped(F.col(f"NOMBRE_{other}")), F.lit("</h2><ul>"))
    lines = F.array_compact(
        F.array(
            F.when(first_of_store, F.concat(F.lit('<html><head><meta charset="UTF-8"></head><body>'), head)),
            F.when(F.col("ITEM") == 1, title),
            item,
            F.when(last_of_card, F.lit("</ul>")),
            F.when(last_of_store, F.lit("</body></html>")),
        )
    )
    return items.select(
        F.col(store).alias("CENTRO"), F.col(other).alias("OTRO"), "ITEM", F.posexplode(lines).alias("LINEA", "HTML")
    )


def send_html(moves: DataFrame) -> DataFrame:
    """What each sender has to send, as HTML lines in the order CENTRO, OTRO, ITEM, LINEA."""
    head = F.lit(f"<p><b>{SEND_TITLE}</b></p><p>{SEND_REASON}</p>")
    return _lines(digest_send(moves), "EMISOR", "RECEPTOR", head, "Destino", _item())


def receive_html(moves: DataFrame) -> DataFrame:
    """What each receiver is to get, as HTML lines in the order CENTRO, OTRO, ITEM, LINEA."""
    head = F.concat(
        F.lit(f"<p><b>{RECEIVE_TITLE}</b></p><p>Vas a recibir <b>"), F.col("REFERENCIAS").cast("string"),
        F.lit(" referencias</b> con un total de <b>"), F.col("UNIDADES").cast("string"), F.lit(" unidades.</b></p>"),
    )
    item = _item(
        ("Aporte", F.concat(F.col("APORTE").cast("string"), F.lit(" uds"))),
        ("Stock tras recepción", F.col("STOCK_DESPUES").cast("string")),
    )
    return _lines(digest_receive(moves), "RECEPTOR", "EMISOR", head, "Origen", item)


def digest_html(moves: DataFrame) -> DataFrame:
    """Both digests, told apart by TIPO."""
    return (
        send_html(moves).withColumn("TIPO", F.lit("ENVIAR"))
        .unionByName(receive_html(moves).withColumn("TIPO", F.lit("RECIBIR")))
    )

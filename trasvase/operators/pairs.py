"""Who can send, who needs, and every sender-receiver pair of a product and colour with its travel time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from trasvase.functions.kpis import RECEIVER, SENDER
from trasvase.session import dealt, stored

PRODUCT = ["CODEPRODUIT", "CODECOLORIS"]

# Pairs of a product and colour that one task handles, about; pairs walked for it in one round.
PAIRS_AT_ONCE = 50_000

# Travel minutes between two stores: a table (CODIGO_ORIGEN, CODIGO_DESTINO, DISTANCIA_MINUTOS), or a function of
# the two store columns giving null where there is no route.
Distance = DataFrame | Callable[[Column, Column], Column]


# Parts the receivers of a sender are dealt out in; words of 64 bits in a sender's mask.
BLOCKS, WORDS = 256, 128


@dataclass(frozen=True)
class Routes:
    """A table of travel times turned to a row for each sender and block of receivers: EMISOR, BLOQUE, and MINUTOS, the
    minutes by receiver. A row holds a 256th of a sender's ways, about."""

    minutes: DataFrame


@dataclass(frozen=True)
class Network:
    """Senders and receivers of each product and colour, stored, with the travel times between them.

    TROZOS in ``roles`` is over how many tasks the pairs of the product and colour are spread, RECEPTORES how many receivers it has.
    """

    roles: DataFrame
    distance: Routes | Callable[[Column, Column], Column]
    pairs_at_once: int


def _slot(receiver: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(receiver), F.lit(slots)).cast("int")


def _mark(receiver: Column) -> tuple[Column, Column]:
    """Where a receiver stands in a mask, by its hash: a word, and three bits of it (by chance fewer)."""
    code = F.xxhash64(receiver)
    word = (code.bitwiseAND(F.lit(WORDS - 1).cast("long"))).cast("int")
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(code, at).bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return word, bit(7).bitwiseOR(bit(13)).bitwiseOR(bit(19))


def _masks(met: DataFrame) -> DataFrame:
    """For each sender, bits of the receivers it meets, by their hash: a fixed size, whatever the number of stores."""
    word, bits = _mark(F.col("RECEPTOR"))
    words = met.select("EMISOR", word.alias("W"), bits.alias("B")).groupBy("EMISOR", "W").agg(F.bit_or("B").alias("B"))
    listed = words.groupBy("EMISOR").agg(F.map_from_entries(F.collect_list(F.struct("W", "B"))).alias("M"))
    held = lambda w: F.coalesce(F.try_element_at("M", w), F.lit(0).cast("long"))
    return listed.select("EMISOR", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), held).alias("MASCARA"))


def routes_of(distance: DataFrame, met: DataFrame | None = None) -> Routes:
    """The shortest time of each way, by sender. The table is read once and dealt out by sender.

    With ``met`` (EMISOR, RECEPTOR; repeats do no harm) ways between stores that never meet are dropped as they are read: a table
    has a row for any two stores, those that share a product are far fewer. A way whose bits are set by other receivers stays, without effect.
    """
    ways = distance.select(
        F.col("CODIGO_ORIGEN").alias("EMISOR"), F.col("CODIGO_DESTINO").alias("RECEPTOR"), F.col("DISTANCIA_MINUTOS").alias("M")
    ).filter(F.col("M").isNotNull() & F.col("RECEPTOR").isNotNull())
    if met is not None:
        word, bits = _mark(F.col("RECEPTOR"))
        # the masks are the small side, and the ways need no sort then; in the condition of the join, hashes would be taken again and again
        ways = ways.withColumns({"_word": word, "_bits": bits}).join(_masks(met).hint("shuffle_hash"), "EMISOR")
        ways = ways.filter("MASCARA[_word] & _bits = _bits").drop("MASCARA", "_word", "_bits")
    shortest = ways.groupBy("EMISOR", "RECEPTOR").agg(F.min("M").alias("M"))
    minutes = F.map_from_entries(F.collect_list(F.struct("RECEPTOR", "M"))).alias("MINUTOS")
    return Routes(stored(shortest.groupBy("EMISOR", _slot(F.col("RECEPTOR"), BLOCKS).alias("BLOQUE")).agg(minutes), "minutes"))


def available_by_size(stock: DataFrame) -> DataFrame:
    """Stock each store can give, per product, colour, article and size."""
    return (
        stock.groupBy(F.col("CODEMAGASIN").alias("EMISOR"), *PRODUCT, "CODEBARRES", "TAILLE")
        .agg(F.sum("TOTAL").alias("STOCK_DISPONIBLE"))
    )


def network_roles(kpis: DataFrame, stock: DataFrame, to_process: DataFrame | None = None) -> DataFrame:
    """Senders and receivers, and what each holds over all sizes."""
    held = stock.groupBy("CODEMAGASIN", *PRODUCT).agg(F.sum("TOTAL").alias("APORTE"))
    roles = kpis.filter(F.col("PERFIL").isin(SENDER, RECEIVER)).select(
        *PRODUCT, "NOMPRODUIT", "LIBCOLORIS", "CODEMAGASIN", "PERFIL", "STOCK_TOTAL",
        "VELOCIDAD_SEMANAL_REAL", "VELOCIDAD_OPERATIVA", "SEMANAS_ROTACION",
    )
    if to_process is not None:
        roles = roles.join(to_process.select(*PRODUCT), PRODUCT, "left_semi")
    return roles.join(held, ["CODEMAGASIN", *PRODUCT], "left").withColumn(
        "APORTE", F.coalesce("APORTE", F.lit(0).cast("long"))
    )


def with_pieces(roles: DataFrame, pairs_at_once: int) -> DataFrame:
    """Adds RECEPTORES, the receivers of a product and colour, and TROZOS, the pieces it is dealt out in so that each has about
    ``pairs_at_once`` pairs."""
    group = Window.partitionBy(*PRODUCT)
    sending = F.count_if(F.col("PERFIL") == SENDER).over(group)
    needing = F.count_if(F.col("PERFIL") == RECEIVER).over(group)
    pieces = F.least(F.ceil(sending * needing / F.lit(max(pairs_at_once, 1))), needing)
    return roles.withColumns({"TROZOS": F.greatest(pieces, F.lit(1)).cast("int"), "RECEPTORES": needing})


def network_of(roles: DataFrame, distance: Distance, pairs_at_once: int = PAIRS_AT_ONCE) -> Network:
    roles = stored(with_pieces(roles, pairs_at_once), "roles")
    if isinstance(distance, DataFrame):
        anywhere = Network(roles, lambda origin, destination: F.lit(0), pairs_at_once)
        distance = routes_of(distance, meet(senders(wanted(roles)), receivers(roles), anywhere).select("EMISOR", "RECEPTOR"))
    return Network(roles, distance, pairs_at_once)


def build_network(
    kpis: DataFrame,
    stock: DataFrame,
    distance: Distance,
    to_process: DataFrame | None = None,
    pairs_at_once: int = PAIRS_AT_ONCE,
) -> Network:
    return network_of(network_roles(kpis, stock, to_process), distance, pairs_at_once)


def senders(roles: DataFrame, *carried: str) -> DataFrame:
    return roles.filter(F.col("PERFIL") == SENDER).select(
        *PRODUCT, "TROZOS", *carried,
        F.col("CODEMAGASIN").alias("EMISOR"), F.col("STOCK_TOTAL").alias("STOCK_EMISOR"), "APORTE",
    )


def wanted(roles: DataFrame) -> DataFrame:
    """Roles in products and colours somebody needs; senders of all others meet nobody, so they are not read."""
    return roles.filter(F.col("RECEPTORES") > 0)


def receivers(roles: DataFrame) -> DataFrame:
    return roles.filter(F.col("PERFIL") == RECEIVER).select(
        *PRODUCT, "TROZOS",
        F.col("CODEMAGASIN").alias("RECEPTOR"), F.col("STOCK_TOTAL").alias("STOCK_RECEPTOR"),
        F.col("VELOCIDAD_SEMANAL_REAL").alias("VELOCIDAD_REAL_RECEPTOR"),
        F.col("VELOCIDAD_OPERATIVA").alias("VELOCIDAD_OPERATIVA_RECEPTOR"),
        F.col("SEMANAS_ROTACION").alias("COBERTURA_INICIAL"),
    )


def meet(
    giving: DataFrame, needing: DataFrame, network: Network, keep: Column | None = None, spread: bool = True
) -> DataFrame:
    """Pairs of a sender and a receiver of the same product and colour between which there is a way, with its minutes.

    With ``spread`` each receiver belongs to one of the pieces (TROZO) of its product and colour and senders are repeated for each,
    so no task gets a whole large group, and what follows per receiver needs no further exchange. ``keep`` is a
    condition on a pair, which Spark tests inside the join.
    """
    keys = list(PRODUCT)
    if spread:
        giving = giving.withColumn("TROZO", F.explode(F.sequence(F.lit(0), F.col("TROZOS") - 1)))
        needing = needing.withColumn("TROZO", F.pmod(F.xxhash64("RECEPTOR"), "TROZOS").cast("int"))
        keys.append("TROZO")
    giving, needing = giving.drop("TROZOS"), needing.drop("TROZOS")
    met = giving.join(needing, keys)
    if keep is not None:
        met = met.filter(keep)
    if isinstance(network.distance, Routes):
        # minutes come to the pairs, by sender and block; with the senders every row would carry all of a store's ways
        met = met.withColumn("BLOQUE", _slot(F.col("RECEPTOR"), BLOCKS)).join(network.distance.minutes, ["EMISOR", "BLOQUE"])
        minutes = F.try_element_at("MINUTOS", F.col("RECEPTOR"))
    else:
        minutes = network.distance(F.col("EMISOR"), F.col("RECEPTOR"))
    met = met.withColumn("DISTANCIA_MINUTOS", minutes).drop("MINUTOS", "BLOQUE")
    return met.filter(F.col("DISTANCIA_MINUTOS").isNotNull())


def pair_order() -> list[Column]:
    """Order of a receiver's pairs."""
    return [F.desc("STOCK_EMISOR"), F.asc("DISTANCIA_MINUTOS"), F.asc("EMISOR")]


def by_receiver() -> WindowSpec:
    """The pairs of a receiver, as they are dealt out."""
    return Window.partitionBy(*PRODUCT, "TROZO", "RECEPTOR")


def best_pair() -> Column:
    return F.min(F.struct((-F.col("STOCK_EMISOR")).alias("S"), F.col("DISTANCIA_MINUTOS").alias("M")))


Level = dict[str, bool]


def _sorted(level: Level) -> list[Column]:
    return [F.desc(column) if down else F.asc(column) for column, down in level.items()]


def numbered(rows: DataFrame, first: Level, second: Level, last: Level, name: str, group: list[str] = PRODUCT) -> DataFrame:
    """Numbers the rows of each group from 1 without sorting a whole group in one task. ``rows`` is read twice.

    A level is columns and whether each is descending. Rows are counted by the values of the first two levels; the counts before each value are added
    up, over the first level inside a group and over the second inside each value of the first; rows are numbered by the last level inside
    each value of both. So even rows that agree in all of the first level are spread.
    """
    def before(keys: list[str], level: Level) -> Column:
        return F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy(*_sorted(level)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    outer, inner = [*group, *first], [*group, *first, *second]
    counts = rows.groupBy(*inner).agg(F.count("*").alias("_n"))
    above = counts.groupBy(*outer).agg(F.sum("_n").alias("_n")).select(*outer, before(group, first).alias("_above"))
    offsets = counts.select(*inner, before(outer, second).alias("_before")).join(above, outer)
    place = F.row_number().over(Window.partitionBy(*inner).orderBy(*_sorted(last)))
    ranked = rows.withColumn("_place", place).join(offsets, inner)
    return ranked.withColumn(name, (F.col("_above") + F.col("_before") + F.col("_place")).cast("int")).drop("_above", "_before", "_place")


def pair_rank(
    network: Network,
    giving: Callable[[DataFrame], DataFrame] = lambda s: s,
    needing: Callable[[DataFrame], DataFrame] = lambda r: r,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Pairs with their rank in the product and colour: speed, weeks, sender stock, minutes, then store codes.

    ``giving`` and ``needing`` may add columns to the senders, which bring the ``carried`` columns of their roles, and to the receivers before
    they meet. A product and colour of one piece is numbered where its pairs are made: its senders and receivers are dealt out,
    its pairs are not. Those of several pieces are numbered in two levels.
    """
    first = {"VELOCIDAD_REAL_RECEPTOR": True, "COBERTURA_INICIAL": False, "STOCK_EMISOR": True, "DISTANCIA_MINUTOS": False}
    second, last = {"RECEPTOR": False}, {"EMISOR": False}
    roles = wanted(network.roles)
    one, several = roles.filter("TROZOS = 1"), roles.filter("TROZOS > 1")

    met = meet(giving(dealt(senders(one, *carried), *PRODUCT)), needing(receivers(one)), network, spread=False)
    whole = Window.partitionBy(*PRODUCT).orderBy(*_sorted({**first, **second, **last}))
    ranked = met.withColumn("PAIR_RANK", F.row_number().over(whole))
    if several.isEmpty():
        return ranked
    pairs = stored(meet(giving(senders(several, *carried)), needing(receivers(several)), network).drop("TROZO"), "pairs")
    return ranked.unionByName(numbered(pairs, first, second, last, "PAIR_RANK"))


def receiver_rank(ranked: DataFrame) -> DataFrame:
    """Adds the rank at which a receiver first appears among the pairs of its product and colour."""
    return ranked.withColumn("RECEIVER_RANK", F.min("PAIR_RANK").over(Window.partitionBy(*PRODUCT, "RECEPTOR")))


def _store_names(stores: DataFrame, role: str) -> DataFrame:
    return stores.select(F.col("CODIGO_TIENDA").alias(role), F.col("NOMBRE_TIENDA").alias(f"NOMBRE_{role}"))


def _product_names(roles: DataFrame) -> DataFrame:
    return roles.filter(F.col("PERFIL") == SENDER).select(*PRODUCT, "NOMPRODUIT", "LIBCOLORIS", F.col("CODEMAGASIN").alias("EMISOR"))


def with_names(pairs: DataFrame, roles: DataFrame, stores: DataFrame) -> DataFrame:
    """Adds product, colour and store names to rows with a product, colour, sender and receiver."""
    named = pairs.join(_product_names(roles), [*PRODUCT, "EMISOR"])
    return named.join(_store_names(stores, "EMISOR"), "EMISOR").join(_store_names(stores, "RECEPTOR"), "RECEPTOR")


def candidate_pairs(network: Network, stores: DataFrame) -> DataFrame:
    """Ranked pairs with store and product names, which senders and receivers bring along."""
    names = stored(stores.select("CODIGO_TIENDA", "NOMBRE_TIENDA"), "store-names")
    # a sender comes once for each name of its product, found where senders are dealt out to
    own = F.collect_list(F.struct("NOMPRODUIT", "LIBCOLORIS")).over(Window.partitionBy(*PRODUCT, "EMISOR"))
    ranked = pair_rank(
        network,
        lambda s: (
            s.withColumn("N", own)
            .drop("NOMPRODUIT", "LIBCOLORIS")
            .select("*", F.explode("N").alias("_n"))
            .select("*", "_n.*")
            .drop("N", "_n")
            .join(_store_names(names, "EMISOR"), "EMISOR")
        ),
        lambda r: r.join(_store_names(names, "RECEPTOR"), "RECEPTOR"),
        ("NOMPRODUIT", "LIBCOLORIS"),
    )
    return receiver_rank(ranked)

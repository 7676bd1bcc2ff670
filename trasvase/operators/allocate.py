"""Greedy allocation of transfers, and what it reports.

Within a product and colour, receivers are served in ranked order and each walks its senders in ranked order. A sender
gives all it holds, once. A pair is refused when the receiver would pass the limit on weeks of cover or on units.
Only that walk is sequential, so only it runs as a fold, over the pairs that could be accepted at all. Receivers are cut
into rounds by the running sum of such pairs, so that a fold is bounded however large a product and colour is; most have one
round. Refusals, log and size coverage are derived from the moves with joins and windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from trasvase.functions.kpis import RECEIVER, SENDER
from trasvase.operators.lookups import photo_lookup
from trasvase.operators.pairs import (
    PRODUCT,
    Network,
    available_by_size,
    best_pair,
    by_receiver,
    meet,
    pair_order,
    receivers,
    senders,
    wanted,
    with_names,
)
from trasvase.session import dealt, scratch_path, stored

# Reasons as users see them.
OVER_COVER = "Supera cobertura maxima"
OVER_UNITS = "Supera cantitat de producte"
FEW_SIZES = "Coberturas de tallas insuficiente"
NO_SALES = "Sin venta en las ultimas 4 semanas"

# Files the offers of one round are written to, at most.
FILES_A_ROUND = 32

# Outcomes of a pair that are not refusals.
ACCEPTED, EMPTY, NOT_SEEN = "ACEPTADO", "VACIO", "NO_EVALUADO"


@dataclass(frozen=True)
class Limits:
    max_cover: float = 8
    size_share: float = 0.75
    max_units: int = 17

    @classmethod
    def of_form(cls, cover: str | int, size_percent: str | float, units: str | int) -> Limits:
        """Limits as a form sends them: whole weeks, a percentage of sizes, whole units."""
        return cls(int(cover), float(size_percent) / 100, int(units))


@dataclass(frozen=True)
class Allocation:
    """A network with its receivers in the order they were served and its moves, stored because every report reads them."""

    network: Network
    limits: Limits
    queue: DataFrame
    moves: DataFrame


def _ceiling(limits: Limits) -> Column:
    """The most units a receiver may end up with: the largest whole number within both limits.

    Corrected by trying the division itself, so that it says the same as ``units / speed <= max_cover`` in doubles.
    """
    speed = F.col("VELOCIDAD_OPERATIVA_RECEPTOR")
    guess = F.floor(F.lit(float(limits.max_cover)) * speed)
    by_cover = (
        F.when((guess + 1) / speed <= limits.max_cover, guess + 1)
        .when(guess / speed <= limits.max_cover, guess)
        .otherwise(guess - 1)
    )
    return F.least(F.lit(limits.max_units), by_cover).cast("bigint")


def _could_accept() -> Column:
    """A pair refused against the receiver's opening stock stays refused, as that stock only grows."""
    return (F.col("APORTE") > 0) & (F.col("STOCK_RECEPTOR") + F.col("APORTE") <= F.col("TECHO"))


def _fold(pairs: DataFrame) -> DataFrame:
    """Walk the acceptable pairs of each product and colour in order. Needs ORDEN_RECEPTOR and TECHO on every pair."""
    step = F.struct(
        "ORDEN_RECEPTOR", (-F.col("STOCK_EMISOR")).alias("S"), F.col("DISTANCIA_MINUTOS").alias("M"),
        "EMISOR", "RECEPTOR", "APORTE", "STOCK_RECEPTOR", "TECHO",
        F.col("VELOCIDAD_OPERATIVA_RECEPTOR").alias("VELOCIDAD"), "COBERTURA_INICIAL",
    )
    walk = pairs.groupBy(*PRODUCT).agg(F.sort_array(F.collect_list(step)).alias("PASOS"))

    pair_type = walk.schema["PASOS"].dataType.elementType.simpleString()
    start = F.struct(
        F.lit(None).cast("string").alias("receiver"),
        F.lit(0).cast("bigint").alias("stock"),
        F.array().cast("array<string>").alias("used"),
        F.array().cast(f"array<struct<pair:{pair_type},stock:bigint>>").alias("moves"),
    )

    def visit(state: Column, pair: Column) -> Column:
        stock = F.when(state["receiver"].eqNullSafe(pair["RECEPTOR"]), state["stock"]).otherwise(pair["STOCK_RECEPTOR"])
        fits = (stock + pair["APORTE"] <= pair["TECHO"]) & ~F.array_contains(state["used"], pair["EMISOR"])
        accepted = F.struct(
            pair["RECEPTOR"].alias("receiver"),
            (stock + pair["APORTE"]).alias("stock"),
            F.array_append(state["used"], pair["EMISOR"]).alias("used"),
            F.array_append(state["moves"], F.struct(pair.alias("pair"), stock.alias("stock"))).alias("moves"),
        )
        passed = F.struct(
            pair["RECEPTOR"].alias("receiver"), stock.alias("stock"), state["used"].alias("used"),
            state["moves"].alias("moves"),
        )
        return F.when(fits, accepted).otherwise(passed)

    before, after, speed = F.col("STOCK_ANTES"), F.col("STOCK_ANTES") + F.col("APORTE"), F.col("VELOCIDAD")
    return (
        walk.select(*PRODUCT, F.aggregate("PASOS", start, visit, lambda state: state["moves"]).alias("M"))
        # explode would test the array for being empty first, which runs the whole walk once more
        .select(*PRODUCT, F.explode_outer("M").alias("M"))
        .select(*PRODUCT, "M.pair.*", F.col("M.stock").alias("STOCK_ANTES"))
        .filter(F.col("EMISOR").isNotNull())
        .select(
            *PRODUCT, "ORDEN_RECEPTOR", "EMISOR", "RECEPTOR", F.col("STOCK_RECEPTOR").alias("STOCK_INICIAL_RECEPTOR"),
            "STOCK_ANTES", "APORTE", after.alias("STOCK_DESPUES"),
            # the first move starts from the receiver's weeks of stock, later ones from the cover reached so far
            F.when(before == F.col("STOCK_RECEPTOR"), F.col("COBERTURA_INICIAL").cast("double"))
            .otherwise(before / speed)
            .alias("COBERTURA_ANTES"),
            (after / speed).alias("COBERTURA_DESPUES"),
        )
    )


def receiver_queue(network: Network, limits: Limits) -> DataFrame:
    """Receivers that have a pair: their place in their product and colour (ORDEN_RECEPTOR), the most units they may end up
    with (TECHO), their pairs (PARES), those that could be accepted (TRABAJO) and the round these are walked in (RONDA)."""
    who = receivers(network.roles).withColumn("TECHO", _ceiling(limits))
    own = ["STOCK_RECEPTOR", "VELOCIDAD_REAL_RECEPTOR", "VELOCIDAD_OPERATIVA_RECEPTOR", "COBERTURA_INICIAL", "TECHO"]
    # pairs are dealt out by receiver, so they are summed where they are
    met = meet(senders(wanted(network.roles)), who.withColumn("PIEZAS", F.col("TROZOS")), network)
    served = met.groupBy(*PRODUCT, "TROZO", "RECEPTOR").agg(
        *[F.any_value(name).alias(name) for name in [*own, "PIEZAS"]],
        best_pair().alias("MEJOR"), F.count("*").alias("PARES"), F.count_if(_could_accept()).alias("TRABAJO"),
    )
    order = [F.desc("VELOCIDAD_REAL_RECEPTOR"), "COBERTURA_INICIAL", "MEJOR.S", "MEJOR.M", "RECEPTOR"]
    line = Window.partitionBy(*PRODUCT).orderBy(*order)  # a row a store
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    room = F.when(F.col("TRABAJO") > 0, F.col("TECHO") - F.col("STOCK_RECEPTOR")).otherwise(0)
    return (
        served.withColumn("HUECO", room)
        .withColumn("ORDEN_RECEPTOR", F.row_number().over(line))
        .withColumn("RONDA", F.floor(F.coalesce(F.sum("TRABAJO").over(before), F.lit(0)) / max(network.pairs_at_once, 1)))
        .withColumn("PREVIO", F.coalesce(F.sum("HUECO").over(before), F.lit(0)))
        .select(*PRODUCT, "RECEPTOR", F.col("PIEZAS").alias("TROZOS"), *own, "ORDEN_RECEPTOR", "PARES", "TRABAJO", "RONDA", "HUECO", "PREVIO")
    )


def _round_numbers(queue: DataFrame) -> list[int]:
    """Rounds in which some product and colour has a pair to walk."""
    return sorted(row[0] for row in queue.filter(F.col("TRABAJO") > 0).select("RONDA").distinct().collect())


def rounds_of(queue: DataFrame) -> int:
    """Rounds the longest product and colour needs."""
    return (queue.filter(F.col("TRABAJO") > 0).agg(F.max("RONDA")).first()[0] or 0) + 1


def _offered() -> WindowSpec:
    """What senders holding the same amount offer a receiver, in its order."""
    return Window.partitionBy(*PRODUCT, "RECEPTOR", "APORTE").orderBy(*pair_order())


def _that_matter(offers: DataFrame) -> DataFrame:
    last = F.floor((F.col("PREVIO") + F.col("HUECO")) / F.col("APORTE"))
    return offers.withColumn("N", F.row_number().over(_offered())).filter(F.col("N") <= last)


def _write_offers(offers: DataFrame, path: str) -> None:
    """Offers of all rounds, a folder a round.

    At most PREVIO / A senders of an amount A are gone before a receiver, so those that matter to it then are among its first
    (2 PREVIO + HUECO) / A of all. Senders are counted once, however often they are listed.
    """
    last = F.floor((2 * F.col("PREVIO") + F.col("HUECO")) / F.col("APORTE"))
    near = offers.withColumn("N", F.dense_rank().over(_offered())).filter(F.col("N") <= last).drop("N")
    # a round in a bounded number of files, each with whole products
    part = F.pmod(F.xxhash64(*PRODUCT), F.lit(FILES_A_ROUND))
    dealt(near.withColumn("_part", part), "RONDA", "_part").drop("_part").write.partitionBy("RONDA").parquet(path)


def walk_rounds(network: Network, queue: DataFrame) -> DataFrame:
    """Moves of all receivers of ``queue``, which must be stored, round by round against the senders not used before.

    A round walks about ``pairs_at_once`` pairs of a product and colour. The receivers before a receiver can take at most
    PREVIO units and it can take HUECO, so among senders holding the same amount A only its first (PREVIO + HUECO) / A can
    matter; the rest are left out of the fold without effect. With several rounds, senders and receivers meet once and
    a round reads only its own offers, and the moves before it.
    """
    spark = queue.sparkSession
    root = scratch_path(spark, "rounds")  # one folder a round, read back as one table
    numbers = _round_numbers(queue)
    served = queue.filter(F.col("TRABAJO") > 0)
    offers = meet(senders(wanted(network.roles)).filter(F.col("APORTE") > 0), served, network, _could_accept(), spread=False)
    if len(numbers) < 2:
        moves = _fold(_that_matter(offers))
        moves.write.parquet(f"{root}/{0:06d}")
    else:
        apart = scratch_path(spark, "offers")
        _write_offers(offers, apart)
        schema = offers.drop("RONDA").schema
        for number in numbers:
            mine = spark.read.schema(schema).parquet(f"{apart}/RONDA={number}")
            if number != numbers[0]:
                gone = spark.read.schema(moves.schema).option("recursiveFileLookup", "true").parquet(root)
                mine = mine.join(gone.select(*PRODUCT, "EMISOR"), [*PRODUCT, "EMISOR"], "left_anti")
            moves = _fold(_that_matter(mine))
            moves.write.parquet(f"{root}/{number:06d}")
    return spark.read.schema(moves.schema).option("recursiveFileLookup", "true").parquet(root)


def allocate(network: Network, limits: Limits = Limits()) -> Allocation:
    queue = stored(receiver_queue(network, limits), "queue")
    return Allocation(network, limits, queue, walk_rounds(network, queue))


def transfer_allocation(network: Network, limits: Limits) -> DataFrame:
    """Moves: sender, receiver, amount, and the receiver's stock and cover before and after."""
    return allocate(network, limits).moves


def pair_outcomes(allocation: Allocation, only: DataFrame | None = None) -> DataFrame:
    """Every pair with what became of it, its place in its receiver's list, and the receiver's stock at that point.

    ``only`` (product, colour, RECEPTOR) leaves all other receivers out before they meet their senders.
    """
    limits, queue = allocation.limits, allocation.queue
    giving = senders(wanted(allocation.network.roles))
    if only is not None:
        queue = queue.join(only, [*PRODUCT, "RECEPTOR"], "left_semi")
        giving = giving.join(only, PRODUCT, "left_semi")
    taken = allocation.moves.select(
        *PRODUCT, "EMISOR", F.col("RECEPTOR").alias("DESTINO"), F.col("ORDEN_RECEPTOR").alias("ORDEN_DESTINO")
    )
    needing = queue.select(*PRODUCT, "TROZOS", "RECEPTOR", "ORDEN_RECEPTOR", "STOCK_RECEPTOR", "VELOCIDAD_OPERATIVA_RECEPTOR")
    pairs = meet(giving.join(taken, [*PRODUCT, "EMISOR"], "left"), needing, allocation.network)
    walk = by_receiver().orderBy(*pair_order())
    earlier = walk.rowsBetween(Window.unboundedPreceding, -1)
    mine = F.coalesce(F.col("DESTINO") == F.col("RECEPTOR"), F.lit(False))
    gone = F.coalesce(F.col("ORDEN_DESTINO") < F.col("ORDEN_RECEPTOR"), F.lit(False))
    got = F.when(mine, F.col("APORTE"))
    speed = F.col("VELOCIDAD_OPERATIVA_RECEPTOR")
    after = F.col("STOCK_ACUMULADO") + F.col("APORTE")
    return (
        pairs.withColumn("ORDEN_PAR", F.row_number().over(walk))
        .withColumn("RECIBIDO", F.sum(got).over(earlier))
        .withColumn("STOCK_ACUMULADO", F.col("STOCK_RECEPTOR") + F.coalesce("RECIBIDO", F.lit(0)))
        .withColumn(
            "RESULTADO",
            F.when(F.col("RECIBIDO").isNotNull() & (F.col("STOCK_ACUMULADO") / speed >= limits.max_cover), NOT_SEEN)
            .when((F.col("APORTE") == 0) | gone, EMPTY)
            .when(mine, ACCEPTED)
            .when(after / speed > limits.max_cover, OVER_COVER)
            .otherwise(OVER_UNITS),
        )
        .select(
            *PRODUCT, "ORDEN_RECEPTOR", "RECEPTOR", "ORDEN_PAR", "EMISOR", "APORTE", "STOCK_ACUMULADO",
            "VELOCIDAD_OPERATIVA_RECEPTOR", "RESULTADO",
        )
    )


def rejected_pairs(outcomes: DataFrame) -> DataFrame:
    """Refused pairs with the reason."""
    return outcomes.filter(F.col("RESULTADO").isin(OVER_COVER, OVER_UNITS)).select(
        *PRODUCT, "EMISOR", "RECEPTOR", F.col("RESULTADO").alias("MOTIVO")
    )


def receiver_sizes(network: Network, stock: DataFrame) -> DataFrame:
    """Stock of each receiver per article and size, before any move."""
    who = network.roles.filter(F.col("PERFIL") == RECEIVER).select(*PRODUCT, F.col("CODEMAGASIN").alias("RECEPTOR"))
    return (
        stock.select(F.col("CODEMAGASIN").alias("RECEPTOR"), *PRODUCT, "CODEBARRES", "TAILLE", "TOTAL")
        .join(who, [*PRODUCT, "RECEPTOR"], "left_semi")
        .groupBy(*PRODUCT, "RECEPTOR", "CODEBARRES", "TAILLE")
        .agg(F.sum("TOTAL").alias("STOCK_TOTAL"))
    )


def _share_of_sizes(sizes: DataFrame, name: str) -> DataFrame:
    share = F.count_if(F.col("STOCK_TOTAL") > 0) / F.count("*")
    return sizes.groupBy(*PRODUCT, "RECEPTOR").agg(share.alias(name))


def size_coverage(network: Network, stock: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """Share of its sizes each receiver has in stock; 0 for a receiver without stock rows. ``own`` are the ``receiver_sizes``, if at hand."""
    who = network.roles.filter(F.col("PERFIL") == RECEIVER).select(*PRODUCT, F.col("CODEMAGASIN").alias("RECEPTOR"))
    shares = _share_of_sizes(receiver_sizes(network, stock) if own is None else own, "COBERTURA_TALLAS")
    return who.join(shares, [*PRODUCT, "RECEPTOR"], "left").withColumn(
        "COBERTURA_TALLAS", F.coalesce("COBERTURA_TALLAS", F.lit(0.0))
    )


def _held_by(moves: DataFrame, stock: DataFrame) -> DataFrame:
    """Stock of the stores that give a product, by ``moves``."""
    keys = [*PRODUCT, "CODEMAGASIN"]
    return stock.join(moves.select(*PRODUCT, F.col("EMISOR").alias("CODEMAGASIN")), keys, "left_semi")


def receiver_final_sizes(allocation: Allocation, stock: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """Stock per article and size, after the moves, of each receiver that got any. ``own`` are the ``receiver_sizes``, if at hand."""
    got = allocation.moves.select(*PRODUCT, "RECEPTOR").distinct()
    opening = receiver_sizes(allocation.network, stock) if own is None else own
    own = opening.join(got, [*PRODUCT, "RECEPTOR"], "left_semi")
    sent = (
        available_by_size(_held_by(allocation.moves, stock))
        .join(allocation.moves.select(*PRODUCT, "EMISOR", "RECEPTOR"), [*PRODUCT, "EMISOR"])
        .select(*PRODUCT, "RECEPTOR", "CODEBARRES", "TAILLE", F.col("STOCK_DISPONIBLE").alias("STOCK_TOTAL"))
    )
    return (
        own.unionByName(sent)
        .groupBy(*PRODUCT, "RECEPTOR", "CODEBARRES", "TAILLE")
        .agg(F.sum("STOCK_TOTAL").alias("STOCK_TOTAL"))
    )


def size_coverage_flag(allocation: Allocation, stock: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """Receivers whose sizes stay too thin after their moves. Names the last sender looked at; the moves stand.

    Without ``outcomes`` only the receivers found thin meet their senders again.
    """
    own = stored(receiver_sizes(allocation.network, stock), "receiver-sizes")
    final = _share_of_sizes(receiver_final_sizes(allocation, stock, own), "COBERTURA_FINAL")
    opening = size_coverage(allocation.network, stock, own).withColumnRenamed("COBERTURA_TALLAS", "COBERTURA_INICIAL")
    low = (F.col("COBERTURA_FINAL") < allocation.limits.size_share) & (
        F.col("COBERTURA_FINAL") <= F.col("COBERTURA_INICIAL")
    )
    thin = stored(final.join(opening, [*PRODUCT, "RECEPTOR"]).filter(low), "thin")
    seen = pair_outcomes(allocation, thin.select(*PRODUCT, "RECEPTOR")) if outcomes is None else outcomes
    last = (
        seen.filter(F.col("RESULTADO") != NOT_SEEN)
        .groupBy(*PRODUCT, "RECEPTOR")
        .agg(F.max_by("EMISOR", "ORDEN_PAR").alias("EMISOR"))
    )
    return thin.join(last, [*PRODUCT, "RECEPTOR"]).select(
        *PRODUCT, "EMISOR", "RECEPTOR", "COBERTURA_INICIAL", "COBERTURA_FINAL", F.lit(FEW_SIZES).alias("MOTIVO")
    )


def stuck_products(allocation: Allocation, outcomes: DataFrame, flags: DataFrame) -> DataFrame:
    """Why stock stays where it is: refused pairs, thin sizes, and senders of products nobody can receive."""
    refused = rejected_pairs(outcomes).unionByName(flags.select(*PRODUCT, "EMISOR", "RECEPTOR", "MOTIVO"))
    paired = allocation.queue.select(*PRODUCT)
    alone = (
        senders(allocation.network.roles)
        .select(*PRODUCT, "EMISOR", F.lit(NO_SALES).alias("MOTIVO"))
        .join(paired, PRODUCT, "left_anti")
    )
    return refused.select(*PRODUCT, "EMISOR", "MOTIVO").unionByName(alone)


def allocation_log(
    allocation: Allocation, outcomes: DataFrame, flags: DataFrame, to_process: DataFrame
) -> DataFrame:
    """Events of the walk as text. Order: product and colour, ORDEN_RECEPTOR, ORDEN_PAR, PASO.

    Opening events have ORDEN_RECEPTOR 0. Closing events of a receiver have no ORDEN_PAR and come after its pairs.
    """
    limits = allocation.limits
    queue = allocation.queue.select(*PRODUCT, "RECEPTOR", "ORDEN_RECEPTOR", "PARES")
    counts = queue.groupBy(*PRODUCT).agg(F.sum("PARES").alias("N"))
    opening = (
        to_process.select(*PRODUCT)
        .distinct()
        .join(counts, PRODUCT, "left")
        .select(
            *PRODUCT,
            F.lit(0).alias("ORDEN_RECEPTOR"),
            F.lit(0).alias("ORDEN_PAR"),
            F.posexplode(
                F.array(
                    F.lit("INICIO EVALUACIÓN"),
                    F.coalesce(F.concat(F.col("N").cast("string"), F.lit(" pares generados")), F.lit("Producto estancado")),
                )
            ).alias("PASO", "MSG"),
        )
    )

    got = allocation.moves.groupBy(*PRODUCT, "RECEPTOR").agg(F.count("*").alias("MOVIMIENTOS"))
    seen = outcomes.filter(F.col("RESULTADO") != NOT_SEEN)
    given = F.when(F.col("RESULTADO") == EMPTY, F.lit(0)).otherwise(F.col("APORTE"))
    refused = F.concat(F.lit("Emisor "), "EMISOR", F.lit(" rebutjat. "))
    full = (F.col("STOCK_ACUMULADO") + F.col("APORTE")) / F.col("VELOCIDAD_OPERATIVA_RECEPTOR") >= limits.max_cover
    lines = F.array_compact(
        F.array(
            F.concat(given.cast("string"), F.lit(" productes de "), "EMISOR", F.lit(" a "), "RECEPTOR"),
            F.when(F.col("RESULTADO") == OVER_COVER, F.concat(refused, F.lit("Supera cobertura máxima")))
            .when(F.col("RESULTADO") == OVER_UNITS, F.concat(refused, F.lit("Supera cantitat d'unitats màximes")))
            .when(F.col("RESULTADO") == ACCEPTED, F.concat(F.lit("Emisor "), "EMISOR", F.lit(" acceptat"))),
            F.when(
                (F.col("RESULTADO") == ACCEPTED) & full,
                F.concat(F.lit("Cobertura máxima assolida per receptor "), "RECEPTOR"),
            ),
        )
    )
    walked = seen.select(*PRODUCT, "ORDEN_RECEPTOR", "ORDEN_PAR", F.posexplode(lines).alias("PASO", "MSG"))

    closing_text = F.when(
        F.col("MOVIMIENTOS").isNull(),
        F.concat(F.lit("Receptor "), "RECEPTOR", F.lit(" sin posibilidad de enviarle stock")),
    ).when(F.col("MOTIVO").isNotNull(), F.lit(FEW_SIZES))
    closing = (
        queue.join(got, [*PRODUCT, "RECEPTOR"], "left")
        .join(flags.select(*PRODUCT, "RECEPTOR", "MOTIVO"), [*PRODUCT, "RECEPTOR"], "left")
        .select(
            *PRODUCT, "ORDEN_RECEPTOR", F.lit(None).cast("int").alias("ORDEN_PAR"),
            F.lit(0).alias("PASO"), closing_text.alias("MSG"),
        )
        .filter(F.col("MSG").isNotNull())
    )
    return opening.unionByName(walked).unionByName(closing)


def sender_sizes(stock: DataFrame) -> DataFrame:
    """Size labels a store has rows for, empty ones included, in text order, per product and colour."""
    return (
        stock.groupBy(F.col("CODEMAGASIN").alias("EMISOR"), *PRODUCT)
        .agg(F.array_join(F.sort_array(F.collect_set("TAILLE")), ", ").alias("TALLAS"))
    )


def move_table(allocation: Allocation, stock: DataFrame, photos: DataFrame, stores: DataFrame) -> DataFrame:
    """Moves as they are published: store and product names, sizes, rounded cover, photo address."""
    moving = allocation.moves
    held = _held_by(moving, stock)
    named = with_names(moving, wanted(allocation.network.roles), stores).join(
        sender_sizes(held), [*PRODUCT, "EMISOR"], "left"
    )
    return photo_lookup(named, photos).select(
        "EMISOR", "NOMBRE_EMISOR", "RECEPTOR", "NOMBRE_RECEPTOR",
        F.col("NOMPRODUIT").alias("NOMBRE_PRODUCTO"), F.col("LIBCOLORIS").alias("COLOR"),
        F.coalesce("TALLAS", F.lit("")).alias("TALLAS"),
        F.col("CODEPRODUIT").alias("CODIGO_PRODUCTO"), F.col("CODECOLORIS").alias("CODIGO_COLOR"),
        "STOCK_INICIAL_RECEPTOR", "STOCK_ANTES", "APORTE", "STOCK_DESPUES",
        F.bround("COBERTURA_ANTES").cast("int").alias("COBERTURA_ANTES"),
        F.bround("COBERTURA_DESPUES").cast("int").alias("COBERTURA_DESPUES"),
        "URL_FOTO",
    )

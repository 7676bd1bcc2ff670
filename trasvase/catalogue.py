"""Every registered query: (session, data folder) to a DataFrame."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trasvase.fixtures import ASOF, Given, travel_minutes
from trasvase.functions import sales as sales_fx
from trasvase.operators import allocate as al
from trasvase.operators import assortment as asm
from trasvase.operators import checks, digests, kpis, lookups, pairs, sales
from trasvase.operators import stock as st
from trasvase.plans import weekly
from trasvase.schemas import VENTAS_FICHERO, conform
from trasvase.session import scratch_path, stored
from trasvase.sinks import publishing
from trasvase.sinks import tables as sink
from trasvase.sources.sales_files import SalesScan, reading_summary, rejected_cells, sales_file_scope, scan_sales_files
from trasvase.sources.tables import PHOTO_HEADINGS, code_list, read_delimited, read_move_sheet, read_photos, read_ranking

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TIGHT = al.Limits(max_cover=3, size_share=0.75, max_units=6)
RUN_DATES = (datetime.date(2001, 9, 24), datetime.date(2001, 10, 1))


def query(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Given(spark, folder))
    return build


# ---------------------------------------------------------------- sales


@query
def sales_file_scope_query(g: Given) -> DataFrame:
    inside = sales_file_scope(g.ventas_raw, *weekly.sales_window(ASOF))
    country = sales_fx.country_of_file(F.col("ARCHIVO"))
    return inside.groupBy("ARCHIVO", country.alias("PAIS")).agg(F.count("*").alias("LINEAS"))


QUERIES["sales_file_scope"] = QUERIES.pop("sales_file_scope_query")


def _timed(g: Given) -> DataFrame:
    return sales.sales_time(conform(g.ventas_raw, VENTAS_FICHERO))


def _scanned(g: Given) -> SalesScan:
    """All sales written as dated files of two shapes and a bad one, and read again."""
    folder = scratch_path(g.spark, "sales-files")
    sink.write_named_lines(g.sales_file_lines, folder, "ARCHIVO", ["ORDEN"], "LINEA")
    return scan_sales_files(g.spark, [folder, f"{folder}-none"], "1900-01-01", "2100-01-01")


@query
def sales_files_read(g: Given) -> DataFrame:
    return _scanned(g).lines.filter(F.col("MALFORMADA").isNull()).select(
        "ARCHIVO", "FECHA", "HORA", "TIENDA", "TALON", "EAN", "VENTA_DIRECTA", "DEVOLUCION", "IMPORTE"
    )


@query
def sales_files_summary(g: Given) -> DataFrame:
    return reading_summary(g.spark, _scanned(g))


@query
def sales_rejects(g: Given) -> DataFrame:
    return rejected_cells(_scanned(g).lines).groupBy("ARCHIVO", "MOTIVO", "COLUMNA").agg(
        F.count("*").alias("CELDAS"), F.min("VALOR").alias("PRIMERO")
    )


@query
def sales_time(g: Given) -> DataFrame:
    return _timed(g).select(
        "TALON", "EAN", "HORA", "MINUTO", "HORA_ORIG", "MINUTO_ORIG",
        F.col("FECHA").cast("string").alias("FECHA"),
        sales_fx.moment_text(F.col("FECHA_HORA")).alias("FECHA_HORA"),
        sales_fx.moment_text(F.col("FECHA_HORA_ORIG")).alias("FECHA_HORA_ORIG"),
    )


@query
def sales_calendar(g: Given) -> DataFrame:
    return sales.sales_calendar(_timed(g)).groupBy("DIA_SEMANA", "DIA_SEMANA_NOMBRE", "FIN_DE_SEMANA").agg(
        F.count("*").alias("LINEAS"), F.count("DIA_SEMANA_ORIG").alias("CON_ORIGEN")
    )


@query
def store_code(g: Given) -> DataFrame:
    return g.ventas_raw.groupBy("TIENDA", sales_fx.store_code(F.col("TIENDA")).alias("CODIGO")).agg(
        F.count("*").alias("LINEAS")
    )


@query
def sales_store_name(g: Given) -> DataFrame:
    named = sales.sales_store_name(g.ventas_raw, g.centros)
    return named.select("TALON", "EAN", "CODIGO_TIENDA", "NOMBRE_TIENDA")


@query
def sales_clean(g: Given) -> DataFrame:
    return sales.sales_clean(g.ventas_raw, g.centros)


@query
def sales_scope(g: Given) -> DataFrame:
    eans = g.productos_procesar.select("CODEPRODUIT", "CODECOLORIS")
    listed = g.productos.join(eans, ["CODEPRODUIT", "CODECOLORIS"], "left_semi").select(
        F.col("CODEBARRES").alias("EAN")
    )
    return sales.sales_scope(sales.sales_clean(g.ventas_raw, g.centros), lookups.staffed_stores(g.centros), listed)


# ---------------------------------------------------------------- assortment


@query
def ranking_clean(g: Given) -> DataFrame:
    return asm.ranking_clean(g.ranking_sheet).toDF(*asm.RANKING_COLUMNS.values())


@query
def assortment_candidates(g: Given) -> DataFrame:
    return asm.assortment_candidates(asm.ranking_clean(g.ranking_sheet))


@query
def assortment_articles(g: Given) -> DataFrame:
    return asm.assortment_articles(asm.assortment_candidates(asm.ranking_clean(g.ranking_sheet)), g.articles)


@query
def assortment(g: Given) -> DataFrame:
    return asm.assortment(g.ranking_sheet, g.articles)


@query
def filter_products(g: Given) -> DataFrame:
    return asm.filter_products(g.productos, ["S1", "S2", "S5"], [], ["ECONOMY", "PROMO", "LARGE"], ["C1"])


@query
def product_dimension(g: Given) -> DataFrame:
    return asm.product_dimension(g.productos.unionByName(g.productos))


# ---------------------------------------------------------------- stock


@query
def stock_account_scope(g: Given) -> DataFrame:
    listed = g.productos_procesar.select("CODEPRODUIT", "CODECOLORIS")
    codes = g.articles.join(listed, ["CODEPRODUIT", "CODECOLORIS"], "left_semi")
    return st.stock_account_scope(g.stock_cuentas, lookups.staffed_stores(g.centros), codes)


@query
def stock_pivot(g: Given) -> DataFrame:
    return st.stock_pivot(g.stock_cuentas)


@query
def stock_position(g: Given) -> DataFrame:
    return st.stock_position(st.stock_pivot(g.stock_cuentas)).drop("DATEMODIFICATION", "DATECREATION")


@query
def article_info(g: Given) -> DataFrame:
    return st.article_info(g.articles, g.remote_products, g.remote_sizes, g.remote_colours)


@query
def season_catalogue(g: Given) -> DataFrame:
    return st.season_catalogue(g.articles, g.remote_products, g.remote_colours, g.class3, g.class2, g.class1)


@query
def stock_article(g: Given) -> DataFrame:
    position = st.stock_position(st.stock_pivot(g.stock_cuentas))
    info = st.article_info(g.articles, g.remote_products, g.remote_sizes, g.remote_colours)
    return st.stock_article(position, info).select("CODEMAGASIN", "CODEINTERNEARTICLE", "NOMPRODUIT", "TAILLE", "TOTAL")


@query
def stock_full(g: Given) -> DataFrame:
    return st.stock_full(g.stock_cuentas, g.articles, g.remote_products, g.remote_sizes, g.remote_colours)


# ---------------------------------------------------------------- KPIs


@query
def net_sales_ean(g: Given) -> DataFrame:
    return kpis.net_sales_ean(g.ventas)


@query
def stock_by_product(g: Given) -> DataFrame:
    return kpis.stock_by_product(g.stock, g.centros, g.productos)


@query
def sales_by_product(g: Given) -> DataFrame:
    return kpis.sales_by_product(g.ventas, g.centros, g.productos)


@query
def product_store_base(g: Given) -> DataFrame:
    return kpis.product_store_base(g.stock, g.recent, g.centros, g.productos)


def _kpis(g: Given) -> DataFrame:
    return kpis.store_product_kpis(g.stock, g.recent, g.centros, g.productos)


@query
def store_product_kpis(g: Given) -> DataFrame:
    return _kpis(g)


@query
def store_profile(g: Given) -> DataFrame:
    return _kpis(g).groupBy("CODEMAGASIN", "PERFIL").agg(
        F.count("*").alias("PRODUCTOS"), F.sum("STOCK_TOTAL").alias("STOCK"), F.sum("VENTA_4SEMANAS").alias("VENTA")
    )


@query
def product_map(g: Given) -> DataFrame:
    return kpis.product_map(g.stock)


@query
def name_codes(g: Given) -> DataFrame:
    return kpis.name_codes(g.stock)


@query
def stock_by_name(g: Given) -> DataFrame:
    return kpis.stock_by_name(g.stock)


@query
def sales_by_name(g: Given) -> DataFrame:
    return kpis.sales_by_name(g.ventas, g.stock)


def _profile_view(g: Given) -> DataFrame:
    staffed = lookups.staffed_stores(g.centros)
    return kpis.kpi_profile_view(g.stored_stock, g.recent, g.centros, g.productos_procesar, staffed)


@query
def kpi_profile_view(g: Given) -> DataFrame:
    return _profile_view(g)


@query
def kpi_profile_legacy(g: Given) -> DataFrame:
    return kpis.kpi_profile_legacy(g.stock, g.recent, g.centros, g.productos_procesar)


# ---------------------------------------------------------------- checks


@query
def sales_totals(g: Given) -> DataFrame:
    return checks.sales_totals(g.ventas)


@query
def sales_without_stock(g: Given) -> DataFrame:
    return checks.sales_without_stock(g.ventas, g.stock)


@query
def sales_trim_match(g: Given) -> DataFrame:
    padded = g.ventas.withColumn("EAN", F.concat(F.lit(" "), "EAN", F.lit("  ")))
    return checks.sales_trim_match(padded, g.stock)


@query
def sales_missing_from_profile(g: Given) -> DataFrame:
    return checks.sales_missing_from_profile(g.recent, g.stored_stock, g.productos_procesar, _profile_view(g))


@query
def product_drilldown(g: Given) -> DataFrame:
    return checks.product_drilldown(g.stock, "P-6", "C1", "7")


@query
def drilldown_sales(g: Given) -> DataFrame:
    return checks.drilldown_sales(g.ventas, g.stock, "P-6", "C1", "7")


# ---------------------------------------------------------------- lookups


@query
def filter_stores(g: Given) -> DataFrame:
    return lookups.filter_stores(g.centros, [], ["G", "M"], ["Tiene"])


@query
def staffed_stores(g: Given) -> DataFrame:
    return lookups.staffed_stores(g.centros)


@query
def facets(g: Given) -> DataFrame:
    return lookups.facets(g.productos, g.centros)


@query
def photo_lookup(g: Given) -> DataFrame:
    return lookups.photo_lookup(g.productos.select("CODEBARRES", "CODEPRODUIT", "CODECOLORIS"), g.fotos_productos)


# ---------------------------------------------------------------- pairs and allocation


def _network(g: Given, stock: DataFrame | None = None, distance: pairs.Distance = travel_minutes) -> pairs.Network:
    held = g.stock if stock is None else stock
    found = kpis.store_product_kpis(held, g.recent, g.centros, g.productos)
    return pairs.build_network(found, held, distance)


def _allocation(g: Given, limits: al.Limits = al.Limits()) -> al.Allocation:
    return al.allocate(_network(g, g.stored_stock), limits)


def _moves(g: Given, limits: al.Limits = al.Limits()) -> DataFrame:
    return al.move_table(_allocation(g, limits), g.stored_stock, g.fotos_productos, g.centros)


def _outcomes(done: al.Allocation) -> DataFrame:
    return stored(al.pair_outcomes(done), "outcomes")


@query
def available_by_size(g: Given) -> DataFrame:
    return pairs.available_by_size(g.stock)


@query
def pair_rank(g: Given) -> DataFrame:
    return pairs.pair_rank(_network(g)).select(*pairs.PRODUCT, "EMISOR", "RECEPTOR", "PAIR_RANK")


@query
def receiver_rank(g: Given) -> DataFrame:
    ranked = pairs.receiver_rank(pairs.pair_rank(_network(g)))
    return ranked.filter(F.col("PAIR_RANK") == F.col("RECEIVER_RANK")).select(
        *pairs.PRODUCT, "RECEPTOR", "RECEIVER_RANK"
    )


@query
def candidate_pairs(g: Given) -> DataFrame:
    return pairs.candidate_pairs(_network(g), g.centros)


@query
def transfer_allocation(g: Given) -> DataFrame:
    return al.transfer_allocation(_network(g), al.Limits()).drop("ORDEN_RECEPTOR")


@query
def transfer_allocation_tight(g: Given) -> DataFrame:
    return al.transfer_allocation(_network(g), TIGHT).drop("ORDEN_RECEPTOR")


@query
def transfer_allocation_rounds(g: Given) -> DataFrame:
    """With so few pairs at once that most products need several rounds."""
    network = pairs.network_of(_network(g, g.stored_stock).roles.drop("TROZOS"), travel_minutes, pairs_at_once=4)
    return al.transfer_allocation(network, al.Limits()).drop("ORDEN_RECEPTOR")


@query
def candidate_pairs_routes(g: Given) -> DataFrame:
    return pairs.candidate_pairs(_network(g, g.stored_stock, g.distancias), g.centros)


@query
def transfer_allocation_routes(g: Given) -> DataFrame:
    network = _network(g, g.stored_stock, g.distancias)
    return al.transfer_allocation(network, al.Limits()).drop("ORDEN_RECEPTOR")


@query
def rejected_pairs_routes(g: Given) -> DataFrame:
    network = _network(g, g.stored_stock, g.distancias)
    return al.rejected_pairs(al.pair_outcomes(al.allocate(network)))


@query
def move_table(g: Given) -> DataFrame:
    return _moves(g)


@query
def rejected_pairs(g: Given) -> DataFrame:
    return al.rejected_pairs(al.pair_outcomes(al.allocate(_network(g))))


@query
def rejected_pairs_tight(g: Given) -> DataFrame:
    return al.rejected_pairs(al.pair_outcomes(al.allocate(_network(g), TIGHT)))


@query
def receiver_sizes(g: Given) -> DataFrame:
    return al.receiver_sizes(_network(g, g.stored_stock), g.stored_stock)


@query
def size_coverage(g: Given) -> DataFrame:
    return al.size_coverage(_network(g, g.stored_stock), g.stored_stock)


@query
def size_coverage_flag(g: Given) -> DataFrame:
    return al.size_coverage_flag(_allocation(g), g.stored_stock)


@query
def allocation_log(g: Given) -> DataFrame:
    done = _allocation(g)
    outcomes = _outcomes(done)
    return al.allocation_log(done, outcomes, al.size_coverage_flag(done, g.stored_stock, outcomes), g.productos)


@query
def stuck_products(g: Given) -> DataFrame:
    done = _allocation(g)
    outcomes = _outcomes(done)
    return al.stuck_products(done, outcomes, al.size_coverage_flag(done, g.stored_stock, outcomes))


@query
def receiver_final_sizes(g: Given) -> DataFrame:
    return al.receiver_final_sizes(_allocation(g), g.stored_stock)


@query
def sender_sizes(g: Given) -> DataFrame:
    return al.sender_sizes(g.stock)


# ---------------------------------------------------------------- reports and history


@query
def ambiguous_colours(g: Given) -> DataFrame:
    return checks.ambiguous_colours(_renamed_colours(g))


@query
def ambiguous_colour_codes(g: Given) -> DataFrame:
    return checks.ambiguous_colour_codes(_renamed_colours(g))


def _renamed_colours(g: Given) -> DataFrame:
    """Moves whose colour names come from the first digit of the product code, so that some stand for two codes."""
    digit = F.substring(F.col("CODIGO_PRODUCTO").cast("string"), 1, 1).cast("int")
    name = F.when(digit % 2 == 0, F.concat(F.lit("T"), digit.cast("string"))).otherwise(
        F.concat(F.lit("T"), digit.cast("string"), F.lit("-"), F.col("CODIGO_COLOR").cast("string"))
    )
    return _moves(g).withColumn("COLOR", name)


@query
def digest_send(g: Given) -> DataFrame:
    return digests.digest_send(_moves(g))


@query
def receive_totals(g: Given) -> DataFrame:
    return digests.receive_totals(_moves(g))


@query
def digest_receive(g: Given) -> DataFrame:
    return digests.digest_receive(stored(_moves(g), "moves"))


@query
def digest_html(g: Given) -> DataFrame:
    return digests.digest_html(stored(_moves(g), "moves"))


# ---------------------------------------------------------------- written and read again


@query
def move_sheet(g: Given) -> DataFrame:
    root = scratch_path(g.spark, "sheet")
    sink.write_run(_moves(g), root, RUN_DATES[1])
    return read_move_sheet(g.spark, f"{root}/run_date={RUN_DATES[1].isoformat()}")


@query
def digest_from_sheet(g: Given) -> DataFrame:
    """Digests from one sheet of all senders, after the moves of one unit were deleted from it."""
    sheet, checked = scratch_path(g.spark, "sheet"), scratch_path(g.spark, "checked")
    sink.write_delimited(_moves(g), sheet)
    sink.write_delimited(read_delimited(g.spark, sheet).filter("APORTE <> '1'"), checked)
    return digests.digest_html(read_move_sheet(g.spark, checked))


@query
def stock_table(g: Given) -> DataFrame:
    root = scratch_path(g.spark, "tables")
    sink.refresh(g.stock, root, "stock")
    return sink.table(g.spark, root, "stock")


def _listing(g: Given, rows: DataFrame) -> DataFrame:
    """Sorted rows written as a listing and read again with their places."""
    path = scratch_path(g.spark, "listing")
    sink.write_ordered(rows, path)
    return sink.read_ordered(g.spark, path, rows.schema)


@query
def stock_listing(g: Given) -> DataFrame:
    """Place and order columns of each row: rows that tie in all of them may change places."""
    listed = _listing(g, st.stock_order(st.stock_full(g.stock_cuentas, g.articles, g.remote_products, g.remote_sizes, g.remote_colours)))
    return listed.select("POSICION", "CODEMAGASIN", "CODEPRODUIT", "CODEGRILLETAILLE", "INDICE")


@query
def kpi_listing(g: Given) -> DataFrame:
    listed = _listing(g, kpis.kpi_order(kpis.store_product_kpis(g.stored_stock, g.recent, g.centros, g.productos)))
    return listed.select("POSICION", "CODEMAGASIN", "NOMPRODUIT", "LIBCOLORIS")


@query
def exported_tables(g: Given) -> DataFrame:
    """Three tables of a session of their own, exported and counted from their files."""
    apart, root = g.spark.newSession(), scratch_path(g.spark, "export")
    for name, rows in (("centros", g.centros), ("productos", g.productos), ("stock", g.stock)):
        path = scratch_path(g.spark, name)
        rows.write.parquet(path)
        apart.read.schema(rows.schema).parquet(path).createOrReplaceTempView(f"trasvase_{name}")
    names = [name for name in sink.export_tables(apart, root) if name.startswith("trasvase_")]
    return sink.exported(g.spark, root, sorted(names))


@query
def published_versions(g: Given) -> DataFrame:
    """What readers see after a whole run, after one that was interrupted, and after the next whole one."""
    root, found = scratch_path(g.spark, "published"), []

    def seen(step: str) -> DataFrame:
        version = publishing.current_version(g.spark, root)
        stock, stores = (publishing.version_table(g.spark, root, version, name) for name in ("stock", "centros"))
        each = stock.selectExpr("1L AS FILAS", "TOTAL AS UNIDADES", "0L AS CENTROS").unionByName(stores.selectExpr("0L AS FILAS", "0L AS UNIDADES", "1L AS CENTROS"))
        return each.agg(F.lit(step).alias("PASO"), *[F.sum(name).alias(name) for name in each.columns])

    staffed = g.centros.filter("TIENE_PERSONAL")
    publishing.publish_version({"stock": g.stock, "centros": g.centros}, root)
    found.append(seen("1 COMPLETA"))
    publishing.write_version({"stock": g.stock.filter("TOTAL > 1")}, root, 2)  # and then it stopped
    found.append(seen("2 INTERRUMPIDA"))
    publishing.publish_version({"stock": g.stock.filter("TOTAL > 2"), "centros": staffed}, root)
    found.append(seen("3 COMPLETA"))
    return functools.reduce(DataFrame.unionByName, found)


@query
def key_violations(g: Given) -> DataFrame:
    """Tables with rows planted twice and without a key."""
    stores = g.centros.unionByName(g.centros.filter("CATEGORIA = 'G'")).unionByName(g.centros.filter("CATEGORIA = 'P'").withColumn("CODIGO_TIENDA", F.lit(None).cast("string")))
    stock = g.stock.unionByName(g.stock.filter("TOTAL % 5 = 3"))
    listed = g.productos_procesar.unionByName(g.productos_procesar.filter("CODECOLORIS = 1"))
    parts = [publishing.key_violations(rows, name) for name, rows in (("centros", stores), ("stock", stock), ("productos_procesar", listed))]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def products_to_process(g: Given) -> DataFrame:
    root = scratch_path(g.spark, "tables")
    sink.refresh(asm.assortment_candidates(asm.ranking_clean(g.ranking_sheet)), root, "productos_procesar")
    return sink.table(g.spark, root, "productos_procesar")


@query
def ranking_files(g: Given) -> DataFrame:
    """The ranking delivered as one text sheet and one Parquet sheet."""
    root = scratch_path(g.spark, "ranking")
    sheet = g.ranking_sheet.select(*[F.col(f"`{name}`").cast("string").alias(name.strip()) for name in g.ranking_sheet.columns])
    first = F.col("`Code coloris`") == "0"
    sink.write_delimited(sheet.filter(first), f"{root}/a.csv")
    sheet.filter(~first).write.parquet(f"{root}/b.parquet")
    return asm.assortment_candidates(asm.ranking_clean(read_ranking(g.spark, [f"{root}/a.csv", f"{root}/b.parquet"])))


@query
def photo_sheet(g: Given) -> DataFrame:
    """The photo sheet with its columns in another order and one that is not asked for."""
    path = scratch_path(g.spark, "photos")
    heads = {name: head for head, name in PHOTO_HEADINGS.items()}
    sheet = g.fotos_productos.select(F.lit("x").alias("Note"), *[F.col(name).alias(heads[name]) for name in reversed(g.fotos_productos.columns)])
    sink.write_delimited(sheet, path)
    return read_photos(g.spark, path)


@query
def profile_of_listed(g: Given) -> DataFrame:
    """The profile view of stores named in a list."""
    shown = code_list(g.spark, [str(n) for n in range(1, 14)], "CODIGO_TIENDA")
    view = kpis.kpi_profile_view(g.stored_stock, g.recent, g.centros, g.productos_procesar, shown)
    return view.select("CODEMAGASIN", "NOMPRODUIT", "LIBCOLORIS", "PERFIL")


@query
def moves_history(g: Given) -> DataFrame:
    root = scratch_path(g.spark, "history")
    network = _network(g, g.stored_stock)
    # the second date is run twice: the rerun replaces its own date only
    for day, limits in ((RUN_DATES[0], al.Limits()), (RUN_DATES[1], al.Limits()), (RUN_DATES[1], TIGHT)):
        moves = al.move_table(al.allocate(network, limits), g.stored_stock, g.fotos_productos, g.centros)
        sink.archive_moves(sink.published_moves(moves), root, day)
    return sink.move_store(g.spark, root)


@query
def weekly_moves(g: Given) -> DataFrame:
    inputs = weekly.Inputs(
        sales=sales_file_scope(g.ventas_raw, *weekly.sales_window(ASOF)),
        stock_accounts=g.stock_cuentas,
        articles=g.articles,
        remote_products=g.remote_products,
        remote_sizes=g.remote_sizes,
        remote_colours=g.remote_colours,
        stores=g.centros,
        distance=travel_minutes,
        photos=g.fotos_productos,
    )
    return weekly.weekly_run(inputs, g.ranking_sheet).moves

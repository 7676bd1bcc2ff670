"""The weekly run: from sales files, ranking and stock accounts to moves and reports."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trasvase.functions.kpis import WEEKS
from trasvase.operators import allocate as al
from trasvase.operators.assortment import assortment, assortment_candidates, ranking_clean
from trasvase.operators.digests import receive_html, send_html
from trasvase.operators.kpis import store_product_kpis
from trasvase.operators.lookups import staffed_stores
from trasvase.operators.pairs import PAIRS_AT_ONCE, Distance, build_network
from trasvase.operators.sales import sales_clean, sales_scope
from trasvase.operators.stock import stock_full
from trasvase.session import stored
from trasvase.sinks import tables as sink
from trasvase.sources.sales_files import read_sales_files
from trasvase.sources.tables import read_move_sheet

SALES_WINDOW = datetime.timedelta(weeks=WEEKS)


@dataclass(frozen=True)
class Inputs:
    """What a run reads. ``sales`` are raw sales lines (text columns, file name in ARCHIVO)."""

    sales: DataFrame
    stock_accounts: DataFrame
    articles: DataFrame
    remote_products: DataFrame
    remote_sizes: DataFrame
    remote_colours: DataFrame
    stores: DataFrame
    distance: Distance
    photos: DataFrame
    pairs_at_once: int = PAIRS_AT_ONCE


@dataclass(frozen=True)
class Run:
    products: DataFrame
    all_sales: DataFrame
    sales: DataFrame
    stock: DataFrame
    kpis: DataFrame
    allocation: al.Allocation
    moves: DataFrame
    candidates: DataFrame | None = None


def sales_window(asof: datetime.date) -> tuple[str, str]:
    """First day left out and last day kept, as text."""
    return (asof - SALES_WINDOW).isoformat(), asof.isoformat()


def read_sales(spark: SparkSession, folders: Sequence[str], asof: datetime.date) -> DataFrame:
    after, until = sales_window(asof)
    lines = read_sales_files(spark, folders, after, until)
    if lines is None:
        raise FileNotFoundError(f"no valid sales file after {after} and until {until} in {list(folders)}")
    return lines


def run(inputs: Inputs, products: DataFrame, stores: DataFrame, limits: al.Limits = al.Limits()) -> Run:
    """Rebalance the given products (one row per article) among the given stores (CODIGO_TIENDA)."""
    chosen = stores.select("CODIGO_TIENDA").distinct()
    eans = products.filter(F.col("CODEBARRES").isNotNull()).select(F.col("CODEBARRES").alias("EAN")).distinct()
    codes = products.filter(F.col("CODEINTERNEARTICLE").isNotNull()).select("CODEINTERNEARTICLE").distinct()
    all_sales = sales_clean(inputs.sales, inputs.stores)
    sales = sales_scope(all_sales, chosen, eans)
    # stock and KPIs are tables of the run: several later steps read them
    stock = stored(
        stock_full(
            inputs.stock_accounts, inputs.articles, inputs.remote_products, inputs.remote_sizes,
            inputs.remote_colours, chosen, codes,
        ),
        "stock",
    )
    kpis = stored(store_product_kpis(stock, sales, inputs.stores, products), "kpis")
    network = build_network(kpis, stock, inputs.distance, products, inputs.pairs_at_once)
    allocation = al.allocate(network, limits)
    moves = stored(al.move_table(allocation, stock, inputs.photos, inputs.stores), "moves")
    return Run(products, all_sales, sales, stock, kpis, allocation, moves)


def weekly_run(inputs: Inputs, ranking_sheet: DataFrame, limits: al.Limits = al.Limits()) -> Run:
    """The batch run: products from the ranking sheet, all stores with staff."""
    products = stored(assortment(ranking_sheet, inputs.articles), "products")
    done = run(inputs, products, staffed_stores(inputs.stores), limits)
    return replace(done, candidates=assortment_candidates(ranking_clean(ranking_sheet)))


def write_digests(moves: DataFrame, day: str) -> None:
    sink.write_digest(send_html(moves), f"{day}/a_enviar")
    sink.write_digest(receive_html(moves), f"{day}/a_recibir")


def digests_from_sheet(spark: SparkSession, sheet: str, root: str, asof: datetime.date) -> None:
    """Write a run's digests anew from its move sheet, after moves were deleted from it."""
    write_digests(read_move_sheet(spark, sheet), f"{root}/run_date={asof.isoformat()}")


def publish(done: Run, root: str, asof: datetime.date, stuck: bool = False) -> None:
    """Refresh the tables of a run, archive its moves, and write its sheets, digests, log and exports under its date."""
    day = f"{root}/run_date={asof.isoformat()}"
    for name, df in (
        ("productos", done.products),
        ("ventas", done.sales),
        ("stock", done.stock),
        ("stock_ventas_centro", done.kpis),
        ("productos_procesar", done.candidates),
    ):
        if df is not None:
            sink.refresh(df, f"{root}/tables", name)
    sink.archive_moves(sink.published_moves(done.moves), f"{root}/tables", asof)
    sink.write_run(done.moves, f"{root}/moves", asof)
    sink.write_delimited(done.moves, f"{day}/movimientos")
    sink.write_delimited(done.all_sales, f"{day}/export_ventas")
    sink.write_delimited(done.sales, f"{day}/export_ventas_filtradas")
    write_digests(done.moves, day)
    outcomes = stored(al.pair_outcomes(done.allocation), "outcomes")
    flags = al.size_coverage_flag(done.allocation, done.stock, outcomes)
    sink.write_delimited(al.allocation_log(done.allocation, outcomes, flags, done.products), f"{day}/log")
    if stuck:
        sink.write_stuck(al.stuck_products(done.allocation, outcomes, flags), f"{day}/estancados")

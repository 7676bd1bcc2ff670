"""Stock by account to stock by store and article, with article information."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trasvase.functions.kpis import floored
from trasvase.schemas import STOCK
from trasvase.session import dealt

# Stock accounts.
AVAILABLE, IN_TRANSIT, IN_PREPARATION = 1, 2, 10

# Seasons kept by the product catalogue.
CATALOGUE_SEASONS = ("E23", "H23", "E24", "H24", "E25", "H25", "E26", "H26")


def stock_account_scope(
    accounts: DataFrame, stores: DataFrame | None = None, articles: DataFrame | None = None
) -> DataFrame:
    """Rows of the three stock accounts, optionally of listed stores and articles only."""
    rows = accounts.filter(F.col("CODECPTSTOCKMAG").isin(AVAILABLE, IN_TRANSIT, IN_PREPARATION))
    if stores is not None:
        rows = rows.join(stores.select(F.col("CODIGO_TIENDA").alias("CODEMAGASIN")), "CODEMAGASIN", "left_semi")
    if articles is not None:
        rows = rows.join(articles.select("CODEINTERNEARTICLE"), "CODEINTERNEARTICLE", "left_semi")
    return rows


def stock_pivot(
    accounts: DataFrame, stores: DataFrame | None = None, articles: DataFrame | None = None
) -> DataFrame:
    """One row per store and article: one column per account, and the latest dates."""

    def account(code: int, name: str):
        return F.sum(F.when(F.col("CODECPTSTOCKMAG") == code, F.col("QTEENSTOCK")).otherwise(0)).alias(name)

    keys = ["CODEMAGASIN", "CODEINTERNEARTICLE"]
    return (
        dealt(stock_account_scope(accounts, stores, articles), *keys)
        .groupBy(*keys)
        .agg(
            account(AVAILABLE, "DISPONIBLE"),
            account(IN_TRANSIT, "TRANSITO"),
            account(IN_PREPARATION, "PREPARACION"),
            F.max("DATEMODIFICATION").alias("DATEMODIFICATION"),
            F.max("DATECREATION").alias("DATECREATION"),
        )
    )


def stock_position(pivoted: DataFrame) -> DataFrame:
    """No negative stock: each part is floored at 0; the total is the floor of the sum before flooring the parts."""
    whole = F.col("DISPONIBLE") + F.col("TRANSITO") + F.col("PREPARACION")
    return pivoted.withColumns(
        {
            "DISPONIBLE": floored(F.col("DISPONIBLE")),
            "TRANSITO": floored(F.col("TRANSITO")),
            "PREPARACION": floored(F.col("PREPARACION")),
            "TOTAL": floored(whole),
        }
    )


def article_info(articles: DataFrame, products: DataFrame, sizes: DataFrame, colours: DataFrame) -> DataFrame:
    """Articles with product name, size and colour. A size or colour without entry is null, colour code included."""
    return (
        articles.select("CODEINTERNEARTICLE", "CODEPRODUIT", "CODEBARRES", "CODEGRILLETAILLE", "INDICE", "CODECOLORIS")
        .withColumnRenamed("CODECOLORIS", "COLOR_ARTICULO")
        .withColumnRenamed("CODEGRILLETAILLE", "GRILLA_ARTICULO")
        .withColumnRenamed("INDICE", "INDICE_ARTICULO")
        .join(products.select("CODEPRODUIT", "NOMPRODUIT"), "CODEPRODUIT")
        .join(
            sizes.select("CODEGRILLETAILLE", "INDICE", "TAILLE"),
            (F.col("GRILLA_ARTICULO") == F.col("CODEGRILLETAILLE")) & (F.col("INDICE_ARTICULO") == F.col("INDICE")),
            "left",
        )
        .join(
            colours.select("CODECOLORIS", "LIBCOLORIS"),
            F.col("COLOR_ARTICULO") == F.col("CODECOLORIS"),
            "left",
        )
        .select(
            "NOMPRODUIT", "LIBCOLORIS", "TAILLE", "CODEINTERNEARTICLE", "CODEPRODUIT", "CODEBARRES", "CODECOLORIS",
            "CODEGRILLETAILLE", "INDICE",
        )
    )


def stock_article(position: DataFrame, info: DataFrame) -> DataFrame:
    """Stock rows with the information of their article."""
    return position.join(info, "CODEINTERNEARTICLE")


def stock_full(
    accounts: DataFrame,
    articles: DataFrame,
    products: DataFrame,
    sizes: DataFrame,
    colours: DataFrame,
    stores: DataFrame | None = None,
    article_list: DataFrame | None = None,
) -> DataFrame:
    """Stock by account to the stock table."""
    position = stock_position(stock_pivot(accounts, stores, article_list))
    info = article_info(articles, products, sizes, colours)
    return stock_article(position, info).select(*STOCK.names, "CODEGRILLETAILLE", "INDICE")


def stock_order(stock: DataFrame) -> DataFrame:
    """Reading order of a stock listing; for a sink, not for further work."""
    return stock.orderBy(
        F.asc_nulls_last("CODEMAGASIN"),
        F.asc_nulls_last("CODEPRODUIT"),
        F.asc_nulls_last("CODEGRILLETAILLE"),
        F.asc_nulls_last("INDICE"),
    )


def season_catalogue(
    articles: DataFrame,
    products: DataFrame,
    colours: DataFrame,
    class3: DataFrame,
    class2: DataFrame,
    class1: DataFrame,
    seasons: tuple[str, ...] = CATALOGUE_SEASONS,
) -> DataFrame:
    """Articles of the given seasons with product, colour and third-level class name."""
    kept = products.filter(F.col("CODESAISON").isin(*seasons))
    return (
        articles.select("CODEPRODUIT", "CODECOLORIS", F.col("CODEBARRES").alias("EAN"), "CODEINTERNEARTICLE")
        .join(kept.select("CODEPRODUIT", "NOMPRODUIT", "CODESAISON", "CODECLASSPROD3"), "CODEPRODUIT")
        .join(colours.select("CODECOLORIS", "LIBCOLORIS"), "CODECOLORIS", "left")
        .join(class3.select("CODECLASSPROD3", "LIBCLASSPROD3", "CODECLASSPROD2"), "CODECLASSPROD3", "left")
        .join(class2.select("CODECLASSPROD2", "CODECLASSPROD1"), "CODECLASSPROD2", "left")
        .join(class1.select("CODECLASSPROD1"), "CODECLASSPROD1", "left")
        .select(
            "CODESAISON", "LIBCLASSPROD3", "CODEPRODUIT", "CODECOLORIS", "NOMPRODUIT", "LIBCOLORIS", "EAN",
            "CODEINTERNEARTICLE",
        )
    )

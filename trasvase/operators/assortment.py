"""Candidate products: ranking sheet to products to rebalance."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns a ranking sheet must have, and the table column each becomes.
RANKING_COLUMNS = {
    "Saison de gestion": "TEMPORADA",
    "Collection": "COLLECTION",
    "Libellé famille": "FAMILIA",
    "Code produit": "CODEPRODUIT",
    "Code coloris": "CODECOLORIS",
    "Libellé produit": "NOMPRODUIT",
    "Libellé coloris": "LIBCOLORIS",
    "Nbre semaines implant (MC/Zone)": "SEMANAS_IMPLANTACION",
    "ESP - Qté vendue": "CANTIDAD_VENDIDA",
    "ESP - Couv": "SEMANAS_COBERTURA",
    "ESP - Stk dispo mag": "CANTIDAD_DISPONIBLE_CENTROS",
    "Stk dispo dépôt": "CANTIDAD_DISPONIBLE_ALMACENES",
    "Situation de Stock dépôt": "SITUACION",
}

# Depot states that make a product a candidate.
SHORT_SUPPLY = ("Gestion de pénurie", "Rupture")

BAD_COVER = "#DIV/0"

PRODUCT_COLUMNS = [
    "TEMPORADA", "COLLECTION", "FAMILIA", "CODEPRODUIT", "CODECOLORIS", "NOMPRODUIT", "LIBCOLORIS",
    "CODEBARRES", "CODEINTERNEARTICLE",
]


def ranking_clean(sheet: DataFrame) -> DataFrame:
    """Trim column names, drop empty rows and rows without a cover figure, check the required columns."""
    trimmed = sheet.toDF(*[name.strip() for name in sheet.columns])
    missing = [name for name in RANKING_COLUMNS if name not in trimmed.columns]
    if missing:
        raise ValueError(f"ranking sheet lacks columns: {missing}")
    cover = F.col("`ESP - Couv`")
    return trimmed.dropna("all").filter(cover.isNull() | (cover.cast("string") != BAD_COVER))


def _whole(name: str) -> Column:
    return F.bround(F.col(f"`{name}`").try_cast("double")).try_cast("int")


def assortment_candidates(ranking: DataFrame) -> DataFrame:
    """Products short in the depot that have been on sale, sell, and still sit in the stores."""
    whole = {
        "CODEPRODUIT", "CODECOLORIS", "SEMANAS_IMPLANTACION", "CANTIDAD_VENDIDA", "SEMANAS_COBERTURA",
        "CANTIDAD_DISPONIBLE_CENTROS", "CANTIDAD_DISPONIBLE_ALMACENES",
    }
    renamed = ranking.select(
        *[
            (_whole(sheet) if name in whole else F.col(f"`{sheet}`").cast("string")).alias(name)
            for sheet, name in RANKING_COLUMNS.items()
        ]
    )
    return renamed.filter(
        F.col("SITUACION").isin(*SHORT_SUPPLY)
        & (F.col("SEMANAS_IMPLANTACION") >= 3)
        & (F.col("CANTIDAD_DISPONIBLE_CENTROS") > 10)
        & (F.col("SEMANAS_COBERTURA") < 13)
        & (F.col("CANTIDAD_VENDIDA") > 10)
    ).drop("SITUACION")


def assortment_articles(candidates: DataFrame, articles: DataFrame) -> DataFrame:
    """Candidates with the article codes of their product and colour."""
    codes = articles.select("CODEPRODUIT", "CODECOLORIS", "CODEBARRES", "CODEINTERNEARTICLE")
    return candidates.join(codes, ["CODEPRODUIT", "CODECOLORIS"])


def assortment(sheet: DataFrame, articles: DataFrame) -> DataFrame:
    """Ranking sheet to the product table: one row per article of each candidate."""
    candidates = assortment_candidates(ranking_clean(sheet))
    return assortment_articles(candidates, articles).select(*PRODUCT_COLUMNS).distinct()


def product_dimension(products: DataFrame) -> DataFrame:
    """One row per EAN: its product and colour, codes and names. Of several rows for an EAN, one with both codes, the
    smallest, is kept.
    """
    lacking = F.col("CODEPRODUIT").isNull() | F.col("CODECOLORIS").isNull()
    identity = F.struct(lacking.alias("_"), "CODEPRODUIT", "CODECOLORIS", "NOMPRODUIT", "LIBCOLORIS")
    return (
        products.filter(F.col("CODEBARRES").isNotNull())
        .groupBy(F.col("CODEBARRES").cast("string").alias("CODEBARRES"))
        .agg(F.min(identity).alias("P"))
        .select("CODEBARRES", "P.*")
        .drop("_")
    )


def filter_products(
    products: DataFrame,
    seasons: Sequence[str] = (),
    collections: Sequence[str] = (),
    families: Sequence[str] = (),
    colours: Sequence[str] = (),
) -> DataFrame:
    """Products in every non-empty list; an empty list does not filter."""
    chosen = {"TEMPORADA": seasons, "COLLECTION": collections, "FAMILIA": families, "LIBCOLORIS": colours}
    tests = [F.col(name).isin(*values) for name, values in chosen.items() if values]
    rows = products.filter(functools.reduce(Column.__and__, tests)) if tests else products
    return rows.select(*PRODUCT_COLUMNS)

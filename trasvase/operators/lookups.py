"""Filters, facet lists and lookups for a front end."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAFFED, NOT_STAFFED = "Tiene", "No Tiene"
NO_PHOTO = "#"


def staffed_text(staffed: Column) -> Column:
    return F.when(staffed, STAFFED).otherwise(NOT_STAFFED)


def filter_stores(
    stores: DataFrame, clusters: Sequence[str] = (), categories: Sequence[str] = (), staffed: Sequence[str] = ()
) -> DataFrame:
    """Stores in every non-empty list; ``staffed`` holds 'Tiene' and/or 'No Tiene'."""
    tests = []
    if clusters:
        tests.append(F.col("CLUSTER").isin(*clusters))
    if categories:
        tests.append(F.col("CATEGORIA").isin(*categories))
    if staffed:
        tests.append(F.col("TIENE_PERSONAL").isin(*[answer == STAFFED for answer in staffed]))
    return stores.filter(functools.reduce(Column.__and__, tests)) if tests else stores


def staffed_stores(stores: DataFrame) -> DataFrame:
    """Codes of the stores with staff."""
    return stores.filter("TIENE_PERSONAL").select("CODIGO_TIENDA")


def facets(products: DataFrame, stores: DataFrame) -> DataFrame:
    """The distinct values of the seven filter lists, as (FACETA, VALOR).

    Each table is read once: its facet columns are unpivoted, then made distinct.
    """
    of_products = products.unpivot(
        [], ["TEMPORADA", "COLLECTION", "FAMILIA", "LIBCOLORIS"], "FACETA", "VALOR"
    )
    of_stores = stores.select(
        "CLUSTER", "CATEGORIA", staffed_text(F.col("TIENE_PERSONAL")).alias("TIENE_PERSONAL")
    ).unpivot([], ["CLUSTER", "CATEGORIA", "TIENE_PERSONAL"], "FACETA", "VALOR")
    return of_products.unionByName(of_stores).distinct()


def facet_list(values: DataFrame, facet: str) -> DataFrame:
    """One facet in display order: ascending, the staffed list descending."""
    chosen = values.filter(F.col("FACETA") == facet).select("VALOR")
    return chosen.orderBy(F.desc("VALOR") if facet == "TIENE_PERSONAL" else F.asc_nulls_last("VALOR"))


def photo_lookup(products: DataFrame, photos: DataFrame) -> DataFrame:
    """Adds URL_FOTO to rows with CODEPRODUIT and CODECOLORIS: one address per product and colour, '#' if none."""
    keys = ["CODEPRODUIT", "CODECOLORIS"]
    first = photos.groupBy(*keys).agg(F.min("URL_FOTO").alias("URL_FOTO"))
    return products.join(first, keys, "left").withColumn("URL_FOTO", F.coalesce("URL_FOTO", F.lit(NO_PHOTO)))

import pytest
from pyspark.sql import functions as F

from trasvase.operators import assortment as asm
from trasvase.operators import checks, kpis, lookups
from trasvase.operators import stock as st
from trasvase.sources import tables as src


def sheet(spark, rows):
    heads = list(asm.RANKING_COLUMNS)
    return spark.createDataFrame(rows, ", ".join(f"`{'  ' + h if i % 3 == 0 else h}` string" for i, h in enumerate(heads)))


def ranked(product="10", weeks="3", sold="11", cover="12", in_stores="11", state="Rupture"):
    return ("E26", "COL", "FAM", product, "1", "NAME", "RED", weeks, sold, cover, in_stores, "0", state)


def test_ranking_clean(spark):
    rows = [ranked("1"), ranked("2", cover="#DIV/0"), ranked("3", cover=None), (None,) * 13]
    clean = asm.ranking_clean(sheet(spark, rows))
    assert clean.columns == list(asm.RANKING_COLUMNS)
    assert {r["Code produit"] for r in clean.collect()} == {"1", "3"}
    with pytest.raises(ValueError, match="ESP - Couv"):
        asm.ranking_clean(sheet(spark, rows).drop("  ESP - Couv"))


@pytest.mark.parametrize(
    "change,kept",
    [
        ({}, True), ({"state": "Gestion de pénurie"}, True), ({"state": "Normal"}, False), ({"weeks": "2"}, False),
        ({"sold": "10"}, False), ({"in_stores": "10"}, False), ({"cover": "13"}, False), ({"cover": "12.5"}, True),
        ({"cover": "12.51"}, False), ({"cover": "n/a"}, False), ({"cover": None}, False), ({"sold": "10.5"}, False), ({"sold": "11.5"}, True),
    ],
)
def test_candidates(spark, change, kept):
    found = asm.assortment_candidates(asm.ranking_clean(sheet(spark, [ranked(**change)])))
    assert (found.count() == 1) is kept


def test_same_product_in_two_sheets_counts_once(spark):
    articles = spark.createDataFrame(
        [(10, 1, "111", "A1"), (10, 1, "112", "A2"), (10, 2, "113", "A3")],
        "CODEPRODUIT int, CODECOLORIS int, CODEBARRES string, CODEINTERNEARTICLE string",
    )
    both = asm.assortment(sheet(spark, [ranked(), ranked()]), articles)
    assert sorted(r.CODEBARRES for r in both.collect()) == ["111", "112"]
    renamed = both.unionByName(both.withColumn("NOMPRODUIT", F.lit("OTHER")))
    partial = renamed.unionByName(renamed.withColumn("CODECOLORIS", F.lit(None).cast("int")))
    found = asm.product_dimension(partial).collect()
    assert sorted(r.CODEBARRES for r in found) == ["111", "112"] and {(r.CODECOLORIS, r.NOMPRODUIT) for r in found} == {(1, "NAME")}


def test_ranking_and_photos_from_files(spark, tmp_path):
    one, two = tmp_path / "one.csv", tmp_path / "two.csv"
    heads = list(asm.RANKING_COLUMNS)
    one.write_text(";".join(heads) + "\n" + ";".join(ranked()) + "\n")
    two.write_text(";".join(reversed(heads)) + ";Extra\n" + ";".join(reversed(ranked("11"))) + ";x\n")
    both = src.read_ranking(spark, [str(one), str(tmp_path / "none.csv"), str(two)])
    assert asm.assortment_candidates(asm.ranking_clean(both)).count() == 2
    with pytest.raises(ValueError):
        src.read_ranking(spark, [str(tmp_path / "none.csv")])
    photos = tmp_path / "photos.csv"
    photos.write_text("Code Coloris;additional_image.$.url_1; ean ;Code Produit;other\n2;http://x;1;10;9\n")
    assert tuple(src.read_photos(spark, str(photos)).first()) == ("1", 10, 2, "http://x")


def test_stock_total_is_floored_after_adding(spark):
    accounts = spark.createDataFrame(
        [("801", "A", 1, 5), ("801", "A", 2, -3), ("801", "A", 10, 1), ("801", "A", 7, 100), ("803", "A", 1, 2), ("803", "A", 2, -9)],
        "CODEMAGASIN string, CODEINTERNEARTICLE string, CODECPTSTOCKMAG int, QTEENSTOCK int",
    ).withColumns({"DATEMODIFICATION": F.lit(None).cast("timestamp"), "DATECREATION": F.lit(None).cast("timestamp")})
    found = {r.CODEMAGASIN: r for r in st.stock_position(st.stock_pivot(accounts)).collect()}
    assert [found["801"][c] for c in ("DISPONIBLE", "TRANSITO", "PREPARACION", "TOTAL")] == [5, 0, 1, 3]
    assert [found["803"][c] for c in ("DISPONIBLE", "TRANSITO", "PREPARACION", "TOTAL")] == [2, 0, 0, 0]
    twice = src.code_list(spark, ["801", "801"], "CODIGO_TIENDA")
    assert st.stock_account_scope(accounts, twice).count() == 3


def _kpi(spark, available, transit, sales, colour=1):
    stock = spark.createDataFrame(
        [("801", "1", available, transit, 0, available + transit)],
        "CODEMAGASIN string, CODEBARRES string, DISPONIBLE long, TRANSITO long, PREPARACION long, TOTAL long",
    )
    sold = spark.createDataFrame([("801", "1", *s) for s in sales], "CODIGO_TIENDA string, EAN string, VENTA_DIRECTA int, DEVOLUCION int")
    stores = spark.createDataFrame([("801", "G")], "CODIGO_TIENDA string, CATEGORIA string")
    products = spark.createDataFrame(
        [("1", 10, colour, "N", "C")] * 2, "CODEBARRES string, CODEPRODUIT int, CODECOLORIS int, NOMPRODUIT string, LIBCOLORIS string"
    )
    return kpis.store_product_kpis(stock, sold, stores, products).collect()


@pytest.mark.parametrize(
    "available,transit,sales,profile,speed,weeks",
    [
        (3, 0, [], "EMISOR", 0, 999),
        (3, 1, [], "NEUTRO", 0, 999),
        (3, 0, [(2, -2)], "EMISOR", 0, 999),
        (3, 0, [(2, -5)], "EMISOR", 0, 999),
        (3, 0, [(1, None)], "RECEPTOR", 1, 3),
        (30, 0, [(10, 0)], "NEUTRO", 3, 10),
        (29, 0, [(10, 0)], "NEUTRO", 3, 10),
        (28, 0, [(10, 0)], "RECEPTOR", 3, 9),
        (0, 0, [(6, None), (None, None)], "RECEPTOR", 2, 0),
        (5, 0, [(6, 0)], "RECEPTOR", 2, 3),
    ],
)
def test_profile(spark, available, transit, sales, profile, speed, weeks):
    (row,) = _kpi(spark, available, transit, sales)
    assert (row.PERFIL, row.VELOCIDAD_OPERATIVA, row.SEMANAS_ROTACION) == (profile, speed, weeks)


def test_rows_without_stock_and_sales_or_without_colour_are_left_out(spark):
    assert _kpi(spark, 0, 0, [(1, -1)]) == []
    assert _kpi(spark, 5, 0, [(1, 0)], colour=None) == []


def test_returns_of_one_article_do_not_eat_sales_of_another(spark):
    sold = spark.createDataFrame(
        [("801", "1", 5, 0), ("801", "2", 0, -3)], "CODIGO_TIENDA string, EAN string, VENTA_DIRECTA int, DEVOLUCION int"
    )
    assert {r.EAN: r.TOTAL_VENTAS_BRUTAS for r in kpis.net_sales_ean(sold).collect()} == {"1": 5, "2": 0}


def test_store_filters_and_facet_order(spark):
    stores = spark.createDataFrame(
        [("1", "N", "A", "G", True), ("2", "M", "B", "M", False), ("3", "O", "A", "M", True)],
        "CODIGO_TIENDA string, NOMBRE_TIENDA string, CLUSTER string, CATEGORIA string, TIENE_PERSONAL boolean",
    )
    codes = lambda df: sorted(r.CODIGO_TIENDA for r in df.collect())
    assert codes(lookups.filter_stores(stores)) == ["1", "2", "3"]
    assert codes(lookups.filter_stores(stores, ["A"], ["M"])) == ["3"]
    assert codes(lookups.filter_stores(stores, staffed=["No Tiene"])) == ["2"]
    assert codes(lookups.filter_stores(stores, staffed=["Tiene", "No Tiene"])) == ["1", "2", "3"]
    products = spark.createDataFrame(
        [("E26", "c", "f", "RED"), ("E25", None, "f", "BLUE")], "TEMPORADA string, COLLECTION string, FAMILIA string, LIBCOLORIS string"
    )
    found = lookups.facets(products, stores)
    listed = lambda name: [r.VALOR for r in lookups.facet_list(found, name).collect()]
    assert listed("TEMPORADA") == ["E25", "E26"] and listed("COLLECTION") == ["c", None]
    assert listed("TIENE_PERSONAL") == ["Tiene", "No Tiene"]


def test_checks(spark):
    moves = spark.createDataFrame([("RED", 1), ("RED", 2), ("RED", 2), ("BLUE", 3), ("BLUE", 3)], "COLOR string, CODIGO_COLOR int")
    assert [tuple(r) for r in checks.ambiguous_colours(moves).collect()] == [("RED", 2)]
    assert sorted(tuple(r) for r in checks.ambiguous_colour_codes(moves).collect()) == [("RED", 1), ("RED", 2)]
    sold = spark.createDataFrame(
        [("801 ", " 1", 2, 0), ("801", "2", 1, -1)], "CODIGO_TIENDA string, EAN string, VENTA_DIRECTA int, DEVOLUCION int"
    )
    stock = spark.createDataFrame([("801", "1"), (None, "2")], "CODEMAGASIN string, CODEBARRES string")
    assert checks.sales_trim_match(sold, stock).count() == 1
    assert {r.EAN for r in checks.sales_without_stock(sold, stock).collect()} == {" 1", "2"}
    assert [tuple(r) for r in checks.sales_totals(sold).collect()] == [("801 ", " 1", 2, 0, 2)]


def test_delimited_file_as_a_relation(spark, tmp_path):
    path = tmp_path / "moves.csv"
    path.write_text("color;codigo_color\nRED;1\nRED;2\nBLUE;3\n")
    src.delimited_view(spark, "moves_csv", str(path))
    found = spark.sql("SELECT color FROM moves_csv GROUP BY color HAVING count(DISTINCT codigo_color) > 1").collect()
    assert [r.color for r in found] == ["RED"]


def test_profile_view_shows_listed_stores(spark):
    stock = spark.createDataFrame(
        [("801", "1", "N", "C", 3, 0, 0, 3), ("7", "1", "N", "C", 3, 0, 0, 3), ("803", "2", "O", "C", 3, 0, 0, 3)],
        "CODEMAGASIN string, CODEBARRES string, NOMPRODUIT string, LIBCOLORIS string, DISPONIBLE long, TRANSITO long, "
        "PREPARACION long, TOTAL long",
    )
    sold = spark.createDataFrame([("803", "1", 8, 0)], "CODIGO_TIENDA string, EAN string, VENTA_DIRECTA int, DEVOLUCION int")
    stores = spark.createDataFrame([(c, "G") for c in ("7", "801", "803")], "CODIGO_TIENDA string, CATEGORIA string")
    listed = spark.createDataFrame([("N", "C"), ("N", "C")], "NOMPRODUIT string, LIBCOLORIS string")
    shown = lambda *a: sorted((r.CODEMAGASIN, r.PERFIL) for r in kpis.kpi_profile_view(stock, sold, stores, listed, *a).collect())
    assert shown(kpis.SHOWN_STORES) == [("801", "EMISOR"), ("803", "RECEPTOR")]
    assert shown() == [("7", "EMISOR"), ("801", "EMISOR"), ("803", "RECEPTOR")]
    assert shown(src.code_list(spark, ["7"], "CODIGO_TIENDA")) == [("7", "EMISOR")]


def test_sums_by_near_keys_keep_the_number_of_tasks(spark):
    """Lines are dealt out by key over a given number of tasks, so that packed bytes do not decide what one task sums up."""
    accounts = spark.createDataFrame([("1", "a", 1, 2), ("1", "a", 2, 3)], "CODEMAGASIN string, CODEINTERNEARTICLE string, CODECPTSTOCKMAG int, QTEENSTOCK int")
    accounts = accounts.withColumns({name: F.lit(None).cast("timestamp_ntz") for name in ("DATEMODIFICATION", "DATECREATION")})
    sold = spark.createDataFrame([("1", "a", 2, None), ("1", "a", None, -1)], "CODIGO_TIENDA string, EAN string, VENTA_DIRECTA int, DEVOLUCION int")
    held, net = st.stock_pivot(accounts), kpis.net_sales_ean(sold)
    for found in (held, net):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 1
    assert [tuple(r)[2:5] for r in held.collect()] == [(2, 3, 0)] and [r.TOTAL_VENTAS_BRUTAS for r in net.collect()] == [1]

"""Whole runs: files in, tables, history, sheets and digests out."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trasvase.operators import allocate as al
from trasvase.operators import digests
from trasvase.plans import weekly
from trasvase.schemas import HOJA_MOVIMIENTOS, MOVIMIENTOS
from trasvase.sinks import publishing
from trasvase.sinks import tables as sink
from trasvase.sources.tables import code_list, read_delimited, read_move_sheet

ASOF = datetime.date(2025, 1, 29)


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    """Two colours of one product over three stores with staff and one without."""
    folder = tmp_path_factory.mktemp("sales")
    head = "FECHA;HORA;TIENDA;EAN;VENTA_DIRECTA;DEVOLUCION;IMPORTE\n"
    (folder / "202501101.csv").write_text(
        head + "10/01/2025;1000;T 00801;11;4;;100\n10/01/2025;1100;T 00803;12;4;;100\n10/01/2025;1100;T 00805;21;2;-2;100\n"
    )
    (folder / "202501011.csv").write_text(head + "01/01/2025;1000;T 00805;11;50;;100\n")  # first day of the window: left out
    (folder / "202501201.csv").write_text(head + "20/01/2025;1000;T 00807;11;5;;100\n20/01/2025;900;T 801;99;5;;1\n")
    articles = spark.createDataFrame(
        [(1, 1, "11", "a11", 1, 0), (1, 1, "12", "a12", 1, 1), (1, 2, "21", "a21", 1, 0), (9, 9, "99", "a99", 1, 0)],
        "CODEPRODUIT int, CODECOLORIS int, CODEBARRES string, CODEINTERNEARTICLE string, CODEGRILLETAILLE int, INDICE int",
    )
    accounts = spark.createDataFrame(
        [
            ("801", "a11", 1, 1), ("803", "a12", 1, 2), ("805", "a11", 1, 2), ("805", "a12", 1, 1), ("805", "a21", 1, 4),
            ("807", "a11", 1, 9), ("801", "a21", 1, 1), ("801", "a21", 2, 1), ("805", "a99", 1, 9),
        ],
        "CODEMAGASIN string, CODEINTERNEARTICLE string, CODECPTSTOCKMAG int, QTEENSTOCK int",
    ).withColumns({"DATEMODIFICATION": F.lit(None).cast("timestamp_ntz"), "DATECREATION": F.lit(None).cast("timestamp_ntz")})
    stores = spark.createDataFrame(
        [("801", "UNO & CO", "N", "G", True), ("803", "TRES", "N", "M", True), ("805", "CINCO", "S", "M", True), ("807", "SIETE", "S", "P", False)],
        "CODIGO_TIENDA string, NOMBRE_TIENDA string, CLUSTER string, CATEGORIA string, TIENE_PERSONAL boolean",
    )
    heads = (
        "Saison de gestion", "Collection", "Libellé famille", "Code produit", "Code coloris", "Libellé produit", "Libellé coloris",
        "Nbre semaines implant (MC/Zone)", "ESP - Qté vendue", "ESP - Couv", "ESP - Stk dispo mag", "Stk dispo dépôt", "Situation de Stock dépôt",
    )
    sheet = spark.createDataFrame(
        [("E26", "C", "F", "1", c, "DRESS", n, "4", "20", "5", "20", "0", "Rupture") for c, n in (("1", "RED"), ("2", "BLUE"))],
        ", ".join(f"`{h}` string" for h in heads),
    )
    inputs = weekly.Inputs(
        sales=weekly.read_sales(spark, [str(folder)], ASOF),
        stock_accounts=accounts,
        articles=articles,
        remote_products=spark.createDataFrame([(1, "DRESS"), (9, "HAT")], "CODEPRODUIT int, NOMPRODUIT string"),
        remote_sizes=spark.createDataFrame([(1, 0, "S"), (1, 1, "M")], "CODEGRILLETAILLE int, INDICE int, TAILLE string"),
        remote_colours=spark.createDataFrame([(1, "RED"), (2, "BLUE"), (9, "X")], "CODECOLORIS int, LIBCOLORIS string"),
        stores=stores,
        distance=spark.createDataFrame(
            [("805", "801", 10), ("805", "803", 5), ("801", "805", 1)], "CODIGO_ORIGEN string, CODIGO_DESTINO string, DISTANCIA_MINUTOS int"
        ),
        photos=spark.createDataFrame([("11", 1, 1, "http://x/1.jpg")], "EAN string, CODEPRODUIT int, CODECOLORIS int, URL_FOTO string"),
    )
    return inputs, sheet, weekly.weekly_run(inputs, sheet)


def test_weekly_run(done):
    _, _, run = done
    profiles = {(r.CODEMAGASIN, r.CODECOLORIS): r.PERFIL for r in run.kpis.collect()}
    assert profiles == {
        ("801", 1): "RECEPTOR", ("803", 1): "RECEPTOR", ("805", 1): "EMISOR", ("805", 2): "EMISOR", ("801", 2): "NEUTRO",
    }
    (move,) = run.moves.collect()
    assert (move.EMISOR, move.RECEPTOR, move.APORTE, move.STOCK_DESPUES) == ("805", "801", 3, 4)
    assert (move.NOMBRE_PRODUCTO, move.COLOR, move.TALLAS, move.URL_FOTO) == ("DRESS", "RED", "M, S", "http://x/1.jpg")


def test_interactive_run_uses_the_chosen_stores_and_products(done, spark):
    inputs, _, whole = done
    chosen = weekly.run(inputs, whole.products.filter("CODECOLORIS = 1"), code_list(spark, ["803", "805"], "CODIGO_TIENDA"))
    assert [(r.EMISOR, r.RECEPTOR) for r in chosen.moves.collect()] == [("805", "803")]
    none = weekly.run(inputs, whole.products, code_list(spark, ["803", "805"], "CODIGO_TIENDA"), al.Limits(max_units=4))
    assert none.moves.isEmpty()


def test_publish_and_history(done, spark, tmp_path):
    _, _, run = done
    root = str(tmp_path)
    weekly.publish(run, root, ASOF, stuck=True)
    tables = f"{root}/tables"
    assert sink.current_moves(spark, tables).count() == 1 and sink.moves_history(spark, tables).count() == 0
    later = ASOF + datetime.timedelta(days=7)
    moves = sink.published_moves(run.moves)
    sink.archive_moves(moves.withColumn("APORTE", F.lit(7)), tables, later)
    sink.archive_moves(moves.withColumn("APORTE", F.lit(8)), tables, later)
    assert [r.APORTE for r in sink.current_moves(spark, tables).collect()] == [8]
    assert [(r.APORTE, r.SEMANA, r.ANO_ISO, r.RUN_DATE) for r in sink.moves_history(spark, tables).collect()] == [(3, 5, 2025, ASOF)]
    assert sink.current_moves(spark, tables).columns == MOVIMIENTOS.names
    sink.archive_moves(moves.filter("false"), tables, later)  # a rerun that finds nothing to move
    assert sink.current_moves(spark, tables).isEmpty() and sink.moves_history(spark, tables).count() == 1
    assert sink.move_store(spark, tables).count() == 1

    sheet = read_delimited(spark, f"{root}/moves/run_date=2025-01-29/CENTRO=805")
    assert [(r.EMISOR, r.RECEPTOR, r.APORTE) for r in sheet.collect()] == [("805", "801", "3")]
    page = "\n".join(
        p.read_text() for p in sorted(Path(root, "run_date=2025-01-29", "a_recibir", "CENTRO=801").glob("part-*"))
    )
    assert page.startswith("<html>") and page.rstrip().endswith("</html>")
    assert "1 referencias" in page and "3 unidades" in page and "805 - CINCO" in page and 'href="http://x/1.jpg"' in page
    assert Path(root, "run_date=2025-01-29", "a_enviar", "CENTRO=805").exists()
    assert sink.table(spark, tables, "productos_procesar").select("CODEPRODUIT", "SEMANAS_COBERTURA").collect() == (
        run.candidates.select("CODEPRODUIT", "SEMANAS_COBERTURA").collect()
    )

    whole = read_move_sheet(spark, f"{root}/run_date=2025-01-29/movimientos")
    assert whole.collect() == run.moves.collect() and whole.dtypes == run.moves.dtypes
    again = f"{root}/again"
    sink.write_delimited(whole.filter("APORTE > 3"), f"{root}/checked")  # the only move is deleted from the sheet
    weekly.digests_from_sheet(spark, f"{root}/checked", again, ASOF)
    assert not list(Path(again).glob("*/a_recibir/CENTRO=*"))

    day = f"{root}/run_date=2025-01-29"
    assert read_delimited(spark, f"{day}/export_ventas").count() == 5
    assert read_delimited(spark, f"{day}/export_ventas_filtradas").count() == 3
    messages = {r.MSG for r in read_delimited(spark, f"{day}/log").collect()}
    assert {"2 pares generados", "3 productes de 805 a 801", "Receptor 803 sin posibilidad de enviarle stock"} <= messages
    stuck = {(r.EMISOR, r.CODECOLORIS, r.MOTIVO) for r in read_delimited(spark, f"{day}/estancados").collect()}
    assert ("805", "2", al.NO_SALES) in stuck

    names = sink.register(spark, tables)
    assert {"ventas", "stock", "productos", "stock_ventas_centro"} <= set(names)
    exported = sink.export_tables(spark, f"{root}/export")
    assert set(names) <= set(exported)
    assert read_delimited(spark, f"{root}/export/stock").count() == spark.table("stock").count()
    for name in exported:
        spark.catalog.dropTempView(name)


def test_sheet_of_many_senders_is_written_and_read_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    def row(sender, receiver):
        return (sender, f"S{sender}; \"x\"", receiver, None, "P", "C", "M, S", 1, 2, 3, 4, 5, 6, 7, None, "#")

    rows = [row(sender, receiver) for sender in ("1", "2", "3", "4/5", "a, b", "7", "{8}") for receiver in ("8", "9")]
    moves, path = spark.createDataFrame(rows, HOJA_MOVIMIENTOS), f"{tmp_path}/run_date=2025-01-29"
    jobs, write = [], sink._write_folders
    monkeypatch.setattr(sink, "_write_folders", lambda mine, *how: (jobs.append((mine.select("EMISOR").distinct().count(), *how[1:])), write(mine, *how)))
    sink.write_run(moves, str(tmp_path), ASOF)
    assert jobs == [(7, "overwrite", True)] and sorted(read_move_sheet(spark, path).collect(), key=str) == sorted(moves.collect(), key=str)
    jobs.clear()
    sink.write_run(moves.filter("EMISOR <> '3'"), str(tmp_path), ASOF, folders_at_once=2)  # a rerun replaces the whole sheet
    assert sum(n for n, _, _ in jobs) == 6 and [how for _, *how in jobs] == [["overwrite", False], ["append", False], ["append", True]]
    assert len(list(Path(path).glob("CENTRO=*"))) == 6 and Path(path, "_SUCCESS").exists()
    left = moves.filter("EMISOR <> '3'")
    for sheet in (read_move_sheet(spark, path), read_move_sheet(spark, path, folders_at_once=2)):
        assert sheet.schema == HOJA_MOVIMIENTOS and sorted(sheet.collect(), key=str) == sorted(left.collect(), key=str)
    assert not [file for file in sheet.inputFiles() if "CENTRO=" in file]  # none of the folders stays on the driver


def test_limits_from_a_form():
    assert al.Limits.of_form("9", "60", "12") == al.Limits(max_cover=9, size_share=0.6, max_units=12)


def test_refresh_replaces_by_name(spark, tmp_path):
    root = str(tmp_path)
    sink.create_tables(spark, root)
    assert sink.table(spark, root, "distancias").count() == 0
    for minutes in (1, 2):
        rows = spark.createDataFrame([(minutes, "b", "a")], "DISTANCIA_MINUTOS int, CODIGO_DESTINO string, CODIGO_ORIGEN string")
        sink.refresh(rows, root, "distancias")
    assert [tuple(r) for r in sink.table(spark, root, "distancias").collect()] == [("a", "b", 2)]


def test_digest_lines_make_one_page_per_store(spark):
    moves = spark.createDataFrame(
        [
            ("1", "A<1>", r, f"R{r}", p, "RED", "S", code, 1, 2, 5, photo)
            for r, p, code, photo in (("8", "P2", 2, "#"), ("8", "P1", 1, None), ("9", "P1", 1, "http://x?a=1&b=2"))
        ],
        "EMISOR string, NOMBRE_EMISOR string, RECEPTOR string, NOMBRE_RECEPTOR string, NOMBRE_PRODUCTO string, COLOR string, "
        "TALLAS string, CODIGO_PRODUCTO int, CODIGO_COLOR int, APORTE long, STOCK_DESPUES long, URL_FOTO string",
    )
    lines = digests.send_html(moves).orderBy("CENTRO", "OTRO", "ITEM", "LINEA").collect()
    page = [r.HTML for r in lines]
    assert sum("<html>" in x for x in page) == 1 and page[-1] == "</body></html>"
    assert [x[:11] for x in page if x.startswith("<h2>")] == ["<h2>Destino"] * 2
    assert [x.split("</b> ")[1][:2] for x in page if x.startswith("<li>")] == ["P1", "P2", "P1"]
    assert sum("Sin foto" in x for x in page) == 2 and any("a=1&amp;b=2" in x for x in page)
    received = digests.receive_html(moves).filter("CENTRO = '8'").orderBy("OTRO", "ITEM", "LINEA").collect()
    assert "2 referencias</b> con un total de <b>4 unidades" in received[0].HTML
    assert "A&lt;1&gt;" in received[1].HTML


def test_readers_see_a_whole_version_or_the_one_before(spark, tmp_path):
    root, stores = str(tmp_path), spark.createDataFrame([("1", "A"), ("2", "B")], "CODIGO_TIENDA string, NOMBRE_TIENDA string")
    assert publishing.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        publishing.current_table(spark, root, "centros")
    assert publishing.publish_version({"centros": stores}, root) == 1
    publishing.write_version({"centros": stores.limit(1)}, root, 2)
    assert publishing.current_table(spark, root, "centros").count() == 2
    with pytest.raises(publishing.KeysBroken, match="centros: 1 keys, such as '1'"):
        publishing.publish_version({"centros": stores.unionByName(stores.limit(1))}, root)
    assert (publishing.current_version(spark, root), publishing.current_table(spark, root, "centros").count()) == (1, 2)
    assert publishing.publish_version({"centros": stores.limit(1)}, root) == 2
    assert publishing.current_table(spark, root, "centros").count() == 1


def test_seeds_are_published_if_their_keys_hold(spark, tmp_path):
    (tmp_path / "centros.csv").write_text("NOMBRE_TIENDA;CODIGO_TIENDA;TIENE_PERSONAL\nA;1;true\nB;;false\nC;1;true\nD;2;true\n")
    (tmp_path / "distancias.csv").write_text("CODIGO_ORIGEN;CODIGO_DESTINO;DISTANCIA_MINUTOS\n1;2;30\n")
    files = {name: str(tmp_path / f"{name}.csv") for name in ("centros", "distancias")}
    broken = publishing.load_seeds(spark, files, f"{tmp_path}/root")
    assert sorted((r.TABLA, r.CLAVE, r.FILAS, r.MOTIVO) for r in broken.collect()) == [("centros", "", 1, "CLAVE VACIA"), ("centros", "1", 2, "CLAVE REPETIDA")]
    assert publishing.current_version(spark, f"{tmp_path}/root") is None
    (tmp_path / "centros.csv").write_text("NOMBRE_TIENDA;CODIGO_TIENDA;TIENE_PERSONAL\nA;1;true\n")
    assert publishing.load_seeds(spark, files, f"{tmp_path}/root").isEmpty()
    assert publishing.current_table(spark, f"{tmp_path}/root", "distancias").first().DISTANCIA_MINUTOS == 30

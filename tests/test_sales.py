import datetime

import pytest
from pyspark.sql import functions as F

from trasvase.functions import sales as fx
from trasvase.operators import sales
from trasvase.plans import weekly
from trasvase.schemas import FOTOS_PRODUCTOS, VENTAS, lost_values
from trasvase.sources import tables
from trasvase.sources.sales_files import (
    list_sales_files, read_sales_files, reading_summary, rejected_cells, sales_file_scope, scan_sales_files,
)

HEAD = "FECHA;HORA;TIENDA;NUM_VENDEDOR;TALON;EAN;VENTA_DIRECTA;DEVOLUCION;IMPORTE"


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "value,hour,minute",
    [("905", 9, 5), ("1275", 12, 75), ("905.0", 9, 5), ("0", 0, 0), ("2359", 23, 59), (None, None, None), ("", None, None), ("x", None, None)],
)
def test_hour_and_minute(spark, value, hour, minute):
    assert one(spark, fx.hour_of, value) == hour
    assert one(spark, fx.minute_of, value) == minute


@pytest.mark.parametrize(
    "label,code",
    [
        ("TDA 00801", "801"), (" TDA 1782 ", "1782"), ("SIN CODIGO", None), ("T12", None), ("A1234567", "34567"),
        ("801 B", None), (None, None), ("000", "0"),
    ],
)
def test_store_code(spark, label, code):
    assert one(spark, fx.store_code, label) == code


@pytest.mark.parametrize("text,day", [("31/12/2025", datetime.date(2025, 12, 31)), ("31/02/2025", None), ("2025-01-01", None), ("1/7/2025", datetime.date(2025, 7, 1)), (None, None)])
def test_sale_date(spark, text, day):
    assert one(spark, fx.sale_date, text) == day


def test_files_in_scope_are_digits_only_after_start_until_end(spark):
    names = [
        "202501011.csv", "202501021.csv", "202501312.csv", "202502011.csv", "copia_202501021.csv", "20250115.csv",
        "2025.csv", "202501152.csv.bak", "20250120abc.csv",
    ]
    files = spark.createDataFrame([(n,) for n in names], "ARCHIVO string")
    kept = {r.ARCHIVO for r in sales_file_scope(files, "2025-01-01", "2025-01-31").collect()}
    assert kept == {"202501021.csv", "202501312.csv", "20250115.csv"}


@pytest.fixture
def folder(tmp_path):
    first = tmp_path / "a"
    second = tmp_path / "b"
    first.mkdir()
    second.mkdir()
    (first / "202501021.csv").write_text(
        f"{HEAD}\n02/01/2025;905;TDA 00801;7;T1;111;2;;1999\n04/01/2025;;TDA 00801;7;T2;111;;-1;-1050\n"
    )
    (first / "202501032.csv").write_text(
        "IMPORTE;TIENDA;HORA;FECHA;EAN;PEDIDO\n500;SIN CODIGO;1275;03/01/2025;222;3\n2500;TDA 999;1830;99/01/2025;222;x\n"
    )
    (first / "202501010.csv").write_text(f"{HEAD}\n01/01/2025;905;TDA 00801;7;T0;111;2;;1999\n")
    (first / "notas.csv").write_text("x\n1\n")
    (second / "202501042.csv").write_text("")
    (second / "202501051.csv").write_text("FECHA;HORA;TIENDA\n05/01/2025;900;TDA 801\n")
    (second / "202501063.csv").write_text(f"{HEAD}\n06/01/2025;1000;TDA 803;7;T6;333;1;;100\n")
    return [str(first), str(second), str(tmp_path / "missing")]


@pytest.fixture
def stores(spark):
    return spark.createDataFrame([("801", "CENTRAL"), ("803", "NORTE")], "CODIGO_TIENDA string, NOMBRE_TIENDA string")


def test_only_files_with_the_required_columns_are_read(spark, folder):
    names = [path.rsplit("/")[-1] for path in list_sales_files(spark, folder, "2025-01-01", "2025-01-31")]
    assert names == ["202501021.csv", "202501032.csv", "202501051.csv", "202501063.csv"]
    read = read_sales_files(spark, folder, "2025-01-01", "2025-01-31").select("ARCHIVO").distinct().collect()
    assert {r.ARCHIVO for r in read} == {"202501021.csv", "202501032.csv", "202501063.csv"}
    assert list_sales_files(spark, [folder[2]], "2025-01-01", "2025-01-31") == []
    assert read_sales_files(spark, folder, "2026-01-01", "2026-01-31") is None
    with pytest.raises(FileNotFoundError):
        weekly.read_sales(spark, folder, datetime.date(2026, 1, 1))


def test_sales_files_to_the_sales_table(spark, folder, stores):
    raw = read_sales_files(spark, folder, "2025-01-01", "2025-01-31")
    clean = sales.sales_clean(raw, stores)
    assert clean.schema.names == VENTAS.names and [f.dataType for f in clean.schema] == [f.dataType for f in VENTAS]
    lines = {(r.EAN, r.FECHA, r.IMPORTE): r for r in clean.collect()}
    assert len(lines) == 5
    whole = lines["111", "2025-01-02", 19.99]
    assert (whole.PAIS, whole.CODIGO_TIENDA, whole.NOMBRE_TIENDA) == ("ES", "801", "CENTRAL")
    assert (whole.FECHA_HORA, whole.HORA, whole.MINUTO) == ("2025-01-02 09:05:00", 9, 5)
    assert (whole.DIA_SEMANA, whole.DIA_SEMANA_NOMBRE, whole.FIN_DE_SEMANA) == (4, "Jueves", "NO")
    assert (whole.VENTA_DIRECTA, whole.DEVOLUCION, whole.PEDIDO, whole.NUM_VENDEDOR) == (2, None, None, "7")
    no_hour = lines["111", "2025-01-04", -10.5]  # a Saturday, but without an hour there is no timestamp
    assert (no_hour.FECHA_HORA, no_hour.HORA, no_hour.DIA_SEMANA, no_hour.FIN_DE_SEMANA) == (None, None, None, "NO")
    bad_minute = lines["222", "2025-01-03", 5.0]
    assert (bad_minute.PAIS, bad_minute.CODIGO_TIENDA, bad_minute.NOMBRE_TIENDA) == ("PT", None, "OTROS CENTROS")
    assert (bad_minute.HORA, bad_minute.MINUTO, bad_minute.FECHA_HORA, bad_minute.PEDIDO) == (12, 75, None, 3)
    bad_date = lines["222", None, 25.0]
    assert (bad_date.HORA, bad_date.FECHA_HORA, bad_date.CODIGO_TIENDA, bad_date.PEDIDO) == (18, None, None, None)
    assert lines["333", "2025-01-06", 1.0].PAIS is None


def test_original_ticket_uses_its_own_minute(spark, stores):
    raw = spark.createDataFrame(
        [("05/01/2025", "905", "801", "04/01/2025", "1830")], "FECHA string, HORA string, TIENDA string, FECHA_ORIG string, HORA_ORIG string"
    )
    line = sales.sales_clean(raw, stores).first()
    assert (line.FECHA_HORA, line.FECHA_HORA_ORIG) == ("2025-01-05 09:05:00", "2025-01-04 18:30:00")
    assert (line.DIA_SEMANA_NOMBRE, line.FIN_DE_SEMANA, line.DIA_SEMANA_ORIG_NOMBRE) == ("Domingo", "SI", "Sábado")


def test_repeated_list_entries_do_not_repeat_sales(spark):
    sold = spark.createDataFrame([("801", "1"), ("801", "2"), ("803", "1"), (None, "1")], "CODIGO_TIENDA string, EAN string")
    chosen = spark.createDataFrame([("801",), ("801",)], "CODIGO_TIENDA string")
    eans = spark.createDataFrame([("1",), ("1",)], "EAN string")
    assert [tuple(r) for r in sales.sales_scope(sold, chosen, eans).select("CODIGO_TIENDA", "EAN").collect()] == [("801", "1")]


def test_sale_times_do_not_depend_on_the_time_zone(spark, stores):
    """Clocks skip 02:00 to 03:00 on this day in Madrid; a sale at 02:30 stays one."""
    raw = spark.createDataFrame([("30/03/2025", "230", "801")], "FECHA string, HORA string, TIENDA string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        line = sales.sales_clean(raw, stores).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (line.FECHA_HORA, line.FECHA, line.DIA_SEMANA_NOMBRE) == ("2025-03-30 02:30:00", "2025-03-30", "Domingo")


def test_skipped_files_and_rejected_lines_are_listed(spark, folder, tmp_path):
    third = tmp_path / "third folder"
    third.mkdir()
    (third / "202501071.csv").write_text('\ufeff"FECHA";"HORA";TIENDA;IMPORTE;PEDIDO\n07/01/2025;9;801;x y;\n07/01/2025;9;801\n07/01/2025;9;801;1;2;3\n32/01/2025;9h;801;5;z\n07/01/2025;9;801;5;1\n')
    (third / "202501081.csv").write_text("FECHA;HORA;TIENDA;IMPORTE;HORA\n08/01/2025;9;801;1;9\n")
    (third / "202501091.csv").write_text("FECHA;HORA;TIENDA;IMPORTE\n")
    (third / "202501101.csv").write_text("\n  \n")
    scan = scan_sales_files(spark, [*folder, str(third)], "2025-01-01", "2025-01-31")
    skipped = {r.ARCHIVO: r.MOTIVO for r in scan.files.collect() if r.MOTIVO}
    assert skipped == {"202501051.csv": "FALTAN COLUMNAS", "202501081.csv": "COLUMNAS REPETIDAS", "202501101.csv": "FICHERO VACIO"} | (
        {"202501042.csv": "FICHERO VACIO"} if "202501042.csv" in skipped else {}
    )
    cells = sorted((r.ARCHIVO, r.MOTIVO, r.COLUMNA or "", r.VALOR) for r in rejected_cells(scan.lines).collect() if r.ARCHIVO == "202501071.csv")
    assert cells == [
        ("202501071.csv", "CAMPOS DE MAS O DE MENOS", "", "07/01/2025;9;801"),
        ("202501071.csv", "CAMPOS DE MAS O DE MENOS", "", "07/01/2025;9;801;1;2;3"),
        ("202501071.csv", "VALOR ILEGIBLE", "FECHA", "32/01/2025"),
        ("202501071.csv", "VALOR ILEGIBLE", "HORA", "9h"),
        ("202501071.csv", "VALOR ILEGIBLE", "IMPORTE", "x y"),
        ("202501071.csv", "VALOR ILEGIBLE", "PEDIDO", "z"),
    ]
    summary = {(r.ARCHIVO, r.MOTIVO): r.LINEAS for r in reading_summary(spark, scan).collect()}
    assert {k[1]: n for k, n in summary.items() if k[0] == "202501071.csv"} == {"CAMPOS DE MAS O DE MENOS": 2, "VALOR ILEGIBLE": 2, "CORRECTA": 1}
    assert summary["202501051.csv", "FALTAN COLUMNAS"] == 1 and summary["202501081.csv", "COLUMNAS REPETIDAS"] == 1
    assert sum(n for (name, _), n in summary.items() if name[:8] >= "20250107") == 6
    assert scan_sales_files(spark, [folder[2]], "2025-01-01", "2025-01-31") is None


def test_ranking_sheets_that_cannot_be_opened_are_listed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Code produit;Code coloris\n1;2\n")
    sheets, skipped = tables.ranking_sheets(spark, [str(tmp_path / "a.csv"), str(tmp_path / "missing.parquet")])
    assert len(sheets) == 1 and [(r.RUTA, r.MOTIVO) for r in skipped.collect()] == [(str(tmp_path / "missing.parquet"), "PATH_NOT_FOUND")]
    with pytest.raises(ValueError, match="PATH_NOT_FOUND"):
        tables.read_ranking(spark, [str(tmp_path / "missing.parquet")])


def test_values_that_conform_loses_are_counted(spark):
    rows = spark.createDataFrame([("1", "x", " "), ("2", "x", None), ("3", "4", "5")], "ean string, codeproduit string, CODECOLORIS string")
    lost = lost_values(rows, FOTOS_PRODUCTOS).collect()
    assert [(r.COLUMNA, r.VALOR, r.FILAS) for r in lost] == [("CODEPRODUIT", "x", 2)]
    assert lost_values(rows.select("ean"), FOTOS_PRODUCTOS).collect() == []

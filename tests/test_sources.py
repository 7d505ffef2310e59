from datetime import date

import pytest
from pyspark.sql import types as T

from shelfwise import schemas
from shelfwise.operators.dims import read_catalogues
from shelfwise.sources import delimited, tables
from tests.conftest import as_set


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


SALES_HEAD = "SKU|EAN_UPC|Descripcion|Depto|SubDepto|Clase|SubClase|Semana|Tienda|VentaUni|VentaPesos|VentaCosto|Invfinvta|FP\n"


def test_weekly_sales(spark, tmp_path):
    write(tmp_path / "ventas/ventas201801.csv", SALES_HEAD + "1|750.0|a|1|2|3|4|201701|9|2|30.5|20|5|x\n# no row\n2|NA|b|1|2|3|4|1|9|0|0|0|0|x\n")
    write(tmp_path / "ventas/ventas201802.csv", SALES_HEAD + "3|7|c|1|2|3|4|2|9|1|1|1|1|x\n")
    got = delimited.read_sales(spark, str(tmp_path), [201801])
    assert as_set(got, "sku", "upc", "period", "store", "amount") == {
        (1, 750, 201801, 9, 30.5), (2, None, 201801, 9, 0.0),
    }
    assert "closing_stock" not in got.columns
    both = delimited.read_sales(spark, str(tmp_path), [201801, 201802], raw=True)
    assert as_set(both, "sku", "closing_stock") == {(1, 5.0), (2, 0.0), (3, 1.0)}


def test_missing_week_is_an_empty_table(spark, tmp_path):
    write(tmp_path / "ventas/ventas201801.csv", SALES_HEAD + "1|7|a|1|2|3|4|1|9|2|30|20|5|x\n")
    got = delimited.read_sales(spark, str(tmp_path), [201850])
    assert got.count() == 0 and dict(got.dtypes)["amount"] == "double"


def test_competitor_feeds(spark, tmp_path):
    folder = tmp_path / "preciosCompetencia"
    write(folder / "ba_201751.csv", "shop|barcode|pr\n5|123.0|9.5\n6|124|NA\n")
    write(folder / "ba_201752.csv", "shop|barcode|pr\n5|123|9.9\n")
    write(folder / "walmart_201751.csv", "UPC|Precio|Tienda\n123|8.0|71\n")
    write(folder / "x.csv", "a\n1\n")
    found = delimited.feed_inventory(spark, str(folder))
    assert as_set(found, "source", "period") == {("ba_", 201751), ("ba_", 201752), ("walmart_", 201751)}
    assert as_set(delimited.feed_sources(found, 201752), "source") == {("ba_",)}
    assert as_set(delimited.feed_periods(found, "ba_"), "period") == {(201751,), (201752,)}

    got = delimited.read_competitor_prices(spark, str(tmp_path), [201751])
    columns = ("period", "upc", "comp_store", "comp_price", "comp_source")
    assert as_set(got, *columns) == {
        (201751, 123, 5, 9.5, "ba_"), (201751, 124, 6, None, "ba_"), (201751, 123, 71, 8.0, "walmart_"),
    }
    several = delimited.read_competitor_prices(spark, str(tmp_path), [201751, 201752])
    assert several.count() == 4
    assert as_set(delimited.competitor_store_catalogue(several, "ba_"), "comp_store") == {(5,), (6,)}
    assert "comp_price_x" in delimited.read_competitor_prices(spark, str(tmp_path), [201751], "_x").columns
    assert delimited.read_competitor_prices(spark, str(tmp_path), [199901]).count() == 0


def test_inventory_snapshots(spark, tmp_path):
    head = "SKU|Tienda|FechaInven|InvFinUni|InvFinVta|InvFinCto\n"
    for name in ("Inv_15Ene18", "Inv_02Abr18", "Inv_30Dic17", "Inv_07Ago18", "other"):
        write(tmp_path / f"inventarios/{name}.csv", head + "1|2|NA|3|4|5\n1|3|Mon Jan 08 00:00:00 CST 2018|3|4|5\n1|4|2018-01-09|3|4|5\n")
    root = str(tmp_path)
    days = as_set(delimited.inventory_files(spark, root), "snapshot_date")
    assert days == {(date(2018, 1, 15),), (date(2018, 4, 2),), (date(2017, 12, 30),), (date(2018, 8, 7),)}
    assert delimited.pick_snapshot(spark, root, date(2018, 4, 1)) == (date(2018, 1, 15), "Inv_15Ene18.csv")
    assert delimited.pick_snapshot(spark, root, date(2017, 1, 1)) is None
    stock = delimited.read_inventory(spark, root, "Inv_15Ene18.csv", date(2018, 1, 15))
    assert as_set(stock, "store", "stock_date", "stock_value") == {
        (2, date(2018, 1, 15), 4.0), (3, date(2018, 1, 8), 4.0), (4, date(2018, 1, 9), 4.0),
    }


def test_catalogues(spark, tmp_path):
    files = {
        "cat_tiendas": "Tienda|Nombre_tda|Formato|Region|Zona|Tipo_Tda\n1|a|F|R|Z|T\n1|b|F|R|Z|T\n",
        "cat_skus": "Articulo|EAN_UPC|Descripcion|GrupoArticulos|Estatus|Depto|DescripDepto|SubDepto|DescripSubdepto|Clase|DescripClase|SubClase|DescripSubCl|Num_Dpt\n5|77|d|g|A|1|x|2|y|3|z|4|w|1\n",
        "cat_deciles": "SKU|Tienda|Decil|InicioVigencia|FinVigencia\n5|1|3|2018-01-01|2018-02-01\n5|1|4|2018-03-01|2018-04-01\n",
        "cat_deciles_nacional": "SKU|UPC|Decil\n5|77|NACIONAL D4\n",
        "cat_impuestos": "Articulo|IVA|IEPS\n5|160|NA\n",
        "matriz_competencia": "Centro|Prioridad|Depto|SubDepto|TiendaCompetencia|FuenteCompetencia|CadenaCompetencia\n1|1|1|2|9|ba_|B\n1|2|1|2|NA|ba_|B\n",
        "cat_promos": "Depto|SubDepto|CambioPromocion\n1|2|15\n",
        "cat_grupos": "Articulo|GrupoArticulo\n5|40\n",
        "cat_excepciones": "Articulo|Excepcion\n6|EXC\n",
    }
    for name, text in files.items():
        write(tmp_path / f"{name}.csv", text)
    cats = read_catalogues(spark, str(tmp_path))
    assert as_set(cats.stores, "store", "store_name") == {(1, "a")}
    assert as_set(cats.skus, "sku", "upc", "dept", "subclass_id") == {(5, 77, 1, 4)}
    assert as_set(cats.store_deciles, "store_decile") == {("4",)}
    assert as_set(cats.national_deciles, "national_decile") == {(4,)}
    assert as_set(cats.taxes, "iva", "ieps") == {(160.0, 0.0)}
    assert as_set(cats.matrix, "priority", "comp_store") == {(1, 9)}
    assert as_set(cats.promo_limits, "promo_percent") == {(15,)}
    assert cats.margins.count() == 0
    assert as_set(cats.price_groups, "price_group") == {(40,)}
    assert as_set(cats.exceptions, "sku", "exception") == {(6, "EXC")}


def test_sidecars(spark, table, tmp_path):
    path = str(tmp_path / "saved")
    df = table("a int, b string, c double, d date", (1, "x", 1.5, date(2018, 1, 1)), (2, None, None, None))
    tables.save_delimited(df, path)
    tables.save_delimited(df, path)
    back = tables.load_delimited(spark, path)
    assert back.schema == df.schema and as_set(back, "*") == as_set(df, "*")
    tables.write_plain_header(spark, path)
    assert spark.read.text(path + ".plainheader").first()[0] == "a|b|c|d"
    spark.createDataFrame([("{}",)], "l string").write.mode("overwrite").text(path + ".sparkheader")
    with pytest.raises(ValueError, match="bad schema"):
        tables.load_delimited(spark, path)
    assert tables.parse_schema("nonsense") is None
    assert tables.parse_schema(T.StructType().json()) == T.StructType()


def test_split_and_union(spark, table, tmp_path):
    df = table("dept int, subdept int, v int", (1, 1, 5), (1, 2, 6), (2, 1, 7))
    tables.split_export(df, str(tmp_path / "split"), ["dept", "subdept"], max_rows_per_file=1)
    one = tables.load_table(spark, str(tmp_path / "split/dept=1/subdept=2"))
    assert as_set(one, "v") == {(6,)}
    for i in (1, 2):
        tables.save_table(df, str(tmp_path / f"week{i}"))
    assert tables.union_saved(spark, [str(tmp_path / "week1"), str(tmp_path / "week2")]).count() == 6
    tables.export_report(df, str(tmp_path / "report"), ["v"])
    texts = [p.read_text() for p in sorted((tmp_path / "report").glob("part-*.csv"))]
    rows = [line for t in texts for line in t.splitlines()[1:]]
    assert rows == ["1|1|5", "1|2|6", "2|1|7"] and all(t.startswith("dept|subdept|v") for t in texts if t)


def test_headings_cover_every_schema():
    names = {f.name for s in vars(schemas).values() if isinstance(s, T.StructType) for f in s}
    assert names == set(schemas.HEADINGS)


def test_each_file_by_its_own_heading(spark, tmp_path):
    folder = tmp_path / "preciosCompetencia"
    folder.mkdir()
    (folder / "ba_201801.csv").write_text("# note\nshop|barcode|pr\n5|123|9.9\n")
    (folder / "ba_201802.csv").write_text("barcode|pr|shop\n123|8.8|5\n")
    out = delimited.read_competitor_prices(spark, str(tmp_path), [201801, 201802])
    assert as_set(out, "period", "upc", "comp_store", "comp_price") == {(201801, 123, 5, 9.9), (201802, 123, 5, 8.8)}
    assert out.count() == 2


def test_no_files_give_an_empty_table(spark, tmp_path):
    (tmp_path / "ventas").mkdir()
    sales = delimited.read_sales(spark, str(tmp_path), [201801])
    assert sales.count() == 0 and {"period", "sku", "store", "units"} <= set(sales.columns)


def test_only_heads_are_read_for_headings(spark, tmp_path, monkeypatch):
    """Bytes read to learn the headings do not grow with the files."""
    line = "7|750123456789.0|1.5\n"
    for n, name in ((10, "a_201801"), (400_000, "b_201801")):
        write(tmp_path / f"preciosCompetencia/{name}.csv", "# note\n\nshop|barcode|pr\n" + line * n)
    stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem

    def read_bytes(action):
        before = sum(s.getBytesRead() for s in stats.getAllStatistics())
        result = action()
        return sum(s.getBytesRead() for s in stats.getAllStatistics()) - before, result

    folder = str(tmp_path / "preciosCompetencia")
    read, grouped = read_bytes(lambda: delimited._by_heading(spark, folder, "*.csv", "#"))
    assert [len(g) for g in grouped] == [2] and read < 100_000
    assert sum(f.stat().st_size for f in (tmp_path / "preciosCompetencia").iterdir()) > 8_000_000
    assert delimited.read_competitor_prices(spark, str(tmp_path), [201801]).count() == 400_010


def test_heads_of_packed_and_empty_files(spark, tmp_path):
    import gzip

    (tmp_path / "x").mkdir()
    (tmp_path / "x/a.csv.gz").write_bytes(gzip.compress(b"SKU|IVA|IEPS\n1|160|0\n"))
    (tmp_path / "x/b.csv").write_bytes("\ufeffSKU|IVA|IEPS\n2|0|80\n".encode())
    (tmp_path / "x/c.csv").write_bytes(b"")
    (tmp_path / "x/d e.csv").write_bytes(b"IEPS|SKU\n80|3\n")
    got = delimited.read_delimited(spark, str(tmp_path / "x"), schemas.TAXES)
    assert as_set(got, "sku", "iva", "ieps") == {(1, 160.0, 0.0), (2, 0.0, 80.0), (3, None, 80.0)}

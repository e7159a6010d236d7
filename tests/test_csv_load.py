from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest

from salestide.plans import reports, trends
from salestide.sources import schema
from salestide.sources.checks import repeated_keys, unknown_keys
from salestide.sources.csv_load import _swap, breaks_inside_quotes, load_star, read_csv, write_table
from salestide.sources.star import open_star, open_table, register_star, register_table
from tests.conftest import line

PRODUCT_HEADER = ",".join(schema.PRODUCTS.names)
SALES_HEADER = ",".join(schema.SALES.names)
CUSTOMER_HEADER = ",".join(schema.CUSTOMERS.names)


def _file(folder: Path, name: str, *lines: str, end: str = "\r\n") -> str:
    path = folder / name
    path.write_bytes("".join(text + end for text in lines).encode())
    return str(path)


def _products(spark, folder, *lines, **options):
    path = _file(folder, "products.csv", PRODUCT_HEADER, *lines)
    return read_csv(spark, path, schema.PRODUCTS, **options).collect()


def test_fields_take_their_declared_types(spark, tmp_path):
    rows = _products(
        spark,
        tmp_path,
        "1,210,FR-58,Frame- Black- 58,CO_RF,Components,Frames,Yes,0,Road,2003-07-01",
        "2,211,FR-60,Frame,CO_RF,Components,Frames,No,1898.5,n/a,2003-07-01",
        "3,212,PD-1,Pedal,CO_PE,,,,18,Touring,",
    )
    assert tuple(rows[0]) == (
        1, 210, "FR-58", "Frame- Black- 58", "CO_RF", "Components", "Frames", True, Decimal("0.00"), "Road",
        dt.date(2003, 7, 1),
    )
    assert (rows[1].maintenance, rows[1].cost, rows[1].product_line) == (False, Decimal("1898.50"), "n/a")
    assert (rows[2].category, rows[2].subcategory, rows[2].maintenance, rows[2].start_date) == (None,) * 4


def test_quotes_blanks_and_empty_text(spark, tmp_path):
    rows = _products(spark, tmp_path, '1,,"","say ""hi"", you", x ,,"a\\",,,,')
    row = rows[0]
    assert row.product_id is None
    assert row.product_number == ""
    assert row.product_name == 'say "hi", you'
    assert row.category_id == " x "
    assert row.category is None
    assert row.subcategory == "a\\"


def test_line_breaks_inside_quotes(spark, tmp_path):
    rows = _products(spark, tmp_path, '1,2,a,"two\nlines",c,d,e,Yes,1,f,2020-01-01', multi_line=True)
    assert rows[0].product_name == "two\nlines"
    assert rows[0].start_date == dt.date(2020, 1, 1)


@pytest.mark.parametrize(
    ("text", "value"),
    [("Yes", True), ("TRUE", True), ("t", True), ("on", True), ("1", True), (" y ", True),
     ("No", False), ("false", False), ("off", False), ("0", False), ("", None)],
)
def test_booleans(spark, tmp_path, text, value):
    assert _products(spark, tmp_path, f"1,,,,,,,{text},,,")[0].maintenance is value


def test_money_is_rounded_half_up_to_cents(spark, tmp_path):
    rows = _products(spark, tmp_path, "1,,,,,,,,1.005,,", "2,,,,,,,,-1.005,,")
    assert [r.cost for r in rows] == [Decimal("1.01"), Decimal("-1.01")]


def test_blanks_beyond_the_declared_length_are_cut(spark, tmp_path):
    rows = _products(spark, tmp_path, f"1,,,,{'x' * 18}     ,,,,,,")
    assert rows[0].category_id == "x" * 18 + "  "


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "bad",
    [
        "x,,,,,,,,,,",
        "1.5,,,,,,,,,,",
        "3000000000,,,,,,,,,,",
        "1,,,,,,,maybe,,,",
        "1,,,,,,,,12345678901.00,,",
        "1,,,,,,,,cheap,,",
        "1,,,,,,,,,,2020-13-01",
        "1,,,,,,,,,,2010",
        "1,,,,,,,,,,2010-12",
        "1,,,,,,,,,,2010-12-29 rubbish",
        "1,,,,,,,,,,2010-12-29Tfoo",
        "1,,,,,,,,,,2010-12-29 00:00:00",
        f"1,,,,{'x' * 21},,,,,,",
        "1,2,3",
        "1,,,,,,,,,,,,extra",
    ],
)
def test_bad_input_stops_the_load(spark, tmp_path, bad, ansi):
    kept = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception):
            _products(spark, tmp_path, bad)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", kept)


def test_messages_name_the_column(spark, tmp_path):
    with pytest.raises(Exception, match="cost is not a valid decimal"):
        _products(spark, tmp_path, "1,,,,,,,,cheap,,")


def _star_files(folder, amount="5.00"):
    return {
        "dim_customers": _file(folder, "c.csv", CUSTOMER_HEADER, "1,11,AW1,Ann,Lee,Peru,Single,Female,1990-02-03,2020-01-01"),
        "dim_products": _file(folder, "p.csv", PRODUCT_HEADER, "1,210,FR,Frame,CO,Parts,Frames,Yes,10,Road,2003-07-01"),
        "fact_sales": _file(
            folder,
            "s.csv",
            SALES_HEADER,
            f"SO1,1,1,2021-05-06,2021-05-08,2021-05-10,{amount},2,2.50",
            f"SO2,1,1,2022-05-06,2022-05-08,2022-05-10,{amount},2,2.50",
            f"SO3,1,9,,,,{amount},2,2.50",
            end="\n",
        ),
    }


def test_load_replaces_tables_and_keeps_types(spark, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    load_star(spark, _star_files(tmp_path, "1.00"), warehouse)
    load_star(spark, _star_files(tmp_path, "5.00"), warehouse)
    star = open_star(spark, warehouse)
    assert star.customers.first().birthdate == dt.date(1990, 2, 3)
    assert star.products.first().maintenance is True
    assert star.sales.count() == 3
    assert {f.name: f.dataType for f in star.sales.schema.fields}["sales_amount"] == schema.MONEY
    assert [tuple(r) for r in trends.yearly(star.sales).collect()] == [
        (2021, Decimal("5.00"), 1, 2),
        (2022, Decimal("5.00"), 1, 2),
    ]


def test_sales_are_stored_by_order_year(spark, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    load_star(spark, _star_files(tmp_path), warehouse)
    folders = {p.name for p in Path(warehouse, "fact_sales").iterdir() if p.is_dir()}
    assert folders == {"order_year=2021", "order_year=2022", "order_year=__HIVE_DEFAULT_PARTITION__"}
    year = open_table(spark, warehouse, "fact_sales").filter("order_year = 2022")
    assert [r.order_number for r in year.collect()] == ["SO2"]
    assert "PartitionFilters: [isnotnull(order_year" in year._jdf.queryExecution().toString()


def test_long_keys():
    wide = schema.with_long_keys(schema.SALES)
    kinds = {f.name: f.dataType.simpleString() for f in wide.fields}
    assert (kinds["customer_key"], kinds["quantity"], kinds["order_number"]) == ("bigint", "int", "varchar(30)")


def test_registered_tables_answer_sql(spark, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    load_star(spark, _star_files(tmp_path), warehouse)
    for _ in range(2):
        register_star(spark, warehouse, "gold")
    names = spark.sql(
        "SELECT c.first_name, p.product_name, f.order_year FROM gold.fact_sales f"
        " JOIN gold.dim_customers c ON f.customer_key = c.customer_key"
        " JOIN gold.dim_products p ON f.product_key = p.product_key ORDER BY f.order_year"
    )
    assert [tuple(r) for r in names.collect()] == [("Ann", "Frame", 2021), ("Ann", "Frame", 2022)]
    assert spark.table("gold.fact_sales").count() == 3

    star = open_star(spark, warehouse)
    reports.publish_table(reports.report(star.sales, star.customers, "2023-01-01"), "gold.report_customer")
    best = reports.top_customers(spark.table("gold.report_customer"))
    assert [r.customer_key for r in best.collect()] == [1]


def test_a_failed_load_leaves_the_old_tables(spark, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    load_star(spark, _star_files(tmp_path), warehouse)
    before = [sorted(map(tuple, t.collect()), key=str) for t in open_star(spark, warehouse)]
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception, match="sales_amount is not a valid"):
        load_star(spark, _star_files(tmp_path / "bad", amount="much"), warehouse)
    assert [sorted(map(tuple, t.collect()), key=str) for t in open_star(spark, warehouse)] == before
    (tmp_path / "good").mkdir()
    load_star(spark, _star_files(tmp_path / "good", amount="6.00"), warehouse)
    assert {r.sales_amount for r in open_star(spark, warehouse).sales.collect()} == {Decimal("6.00")}
    assert not [p.name for p in (tmp_path / "warehouse").iterdir() if "old" in p.name]


def _everything(spark, warehouse):
    return [sorted(map(tuple, t.collect()), key=str) for t in open_star(spark, warehouse)]


def test_moves_are_taken_back_if_a_later_one_fails(spark, tmp_path):
    warehouse = tmp_path / "warehouse"
    load_star(spark, _star_files(tmp_path), str(warehouse))
    before = _everything(spark, str(warehouse))
    (tmp_path / "new").mkdir()
    files = _star_files(tmp_path / "new", amount="7.00")
    staged = {}
    for number, (name, columns) in enumerate(schema.TABLES.items()):
        write_table(read_csv(spark, files[name], columns), str(warehouse / ".staged"), name)
        # The second table has nothing to move in.
        staged[f"{warehouse}/{name}"] = f"{warehouse}/{'.missing' if number == 1 else '.staged'}/{name}"
    with pytest.raises(Exception):
        _swap(spark, staged)
    assert _everything(spark, str(warehouse)) == before


def test_a_failed_load_leaves_nothing_beside_the_tables(spark, tmp_path):
    warehouse = tmp_path / "warehouse"
    load_star(spark, _star_files(tmp_path), str(warehouse))
    before = sorted(p.name for p in warehouse.iterdir())
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception):
        load_star(spark, _star_files(tmp_path / "bad", amount="much"), str(warehouse))
    assert sorted(p.name for p in warehouse.iterdir()) == before


def test_a_lasting_view_follows_loads_and_sessions(spark, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    load_star(spark, _star_files(tmp_path), warehouse)
    reports.publish_lasting_view(spark, warehouse, "lasting.report_customer", spend_limit=3, tenure_months=0)
    (tmp_path / "more").mkdir()
    for folder in (tmp_path, tmp_path / "more"):
        load_star(spark, _star_files(folder, amount="5.00" if folder == tmp_path else "8.00"), warehouse)
        star = open_star(spark, warehouse)
        want = reports.report(star.sales, star.customers, spend_limit=3, tenure_months=0)
        got = spark.newSession().table("lasting.report_customer")
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        rows = sorted(map(tuple, got.collect()), key=str)
        assert rows and rows == sorted(map(tuple, want.collect()), key=str)


def test_a_quoted_line_break_says_what_it_needs(spark, tmp_path):
    files = _star_files(tmp_path)
    files["dim_products"] = _file(tmp_path, "p2.csv", PRODUCT_HEADER, '1,2,a,"two\nlines",c,d,e,Yes,1,f,2020-01-01')
    with pytest.raises(Exception, match="multi_line"):
        load_star(spark, files, str(tmp_path / "w2"), multi_line=False)
    load_star(spark, files, str(tmp_path / "w2"), multi_line=True)


BREAKS = {
    "1,2,a,plain,c,d,e,Yes,1,f,2020-01-01": False,
    '1,2,a,"say ""hi"", you",c,d,e,Yes,1,f,2020-01-01': False,
    '1,2,"",""" """,c,d,e,Yes,1,f,2020-01-01': False,
    '1,2,a,"two\nlines",c,d,e,Yes,1,f,2020-01-01': True,
    '1,2,a,"""two""\r\n""lines""",c,d,e,Yes,1,f,2020-01-01': True,
    '1,2,"a","\n\n""\n","c\n",d,e,Yes,1,f,2020-01-01': True,
}


@pytest.mark.parametrize("row", BREAKS)
def test_line_breaks_are_found(spark, tmp_path, row):
    path = _file(tmp_path, "p.csv", PRODUCT_HEADER, "7,8,x,y,c,d,e,No,1,f,2020-01-01", row, "9,8,x,y,c,d,e,No,1,f,2020-01-01")
    assert breaks_inside_quotes(spark, path) is BREAKS[row]
    found = read_csv(spark, path, schema.PRODUCTS).collect()
    assert [r.product_key for r in found] == [7, 1, 9]
    assert found == read_csv(spark, path, schema.PRODUCTS, multi_line=True).collect()


def test_files_of_both_kinds_load_without_a_flag(spark, tmp_path):
    files = _star_files(tmp_path)
    (tmp_path / "products").mkdir()
    rows = list(BREAKS)
    for number, row in enumerate(rows):
        _file(tmp_path / "products", f"{number}.csv", PRODUCT_HEADER, row)
    files["dim_products"] = str(tmp_path / "products")
    load_star(spark, files, str(tmp_path / "w"))
    names = {r.product_name for r in open_star(spark, str(tmp_path / "w")).products.collect()}
    assert names == {"plain", 'say "hi", you', '" "', "two\nlines", '"two"\n"lines"', '\n\n"\n'}


def test_a_quote_that_never_ends_stops_the_load(spark, tmp_path):
    with pytest.raises(Exception):
        _products(spark, tmp_path, '1,2,a,"open,c,d,e,Yes,1,f,2020-01-01', "2,2,a,b,c,d,e,Yes,1,f,2020-01-01")


def test_checks(tables):
    sales = tables.sales(
        line("A", 1, None, "1"), line("B", 9, None, "1"), line("C", 9, None, "1"), line("D", None, None, "1")
    )
    customers = tables.customers({"customer_key": 1}, {"customer_key": 2}, {"customer_key": 2}, {"customer_key": None})
    lost = unknown_keys(sales, customers, "customer_key").collect()
    assert {tuple(r) for r in lost} == {(9, 2), (None, 1)}
    assert [tuple(r) for r in repeated_keys(customers, "customer_key").collect()] == [(2, 2)]

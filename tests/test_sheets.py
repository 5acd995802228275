"""Header and column detection on small hand-made sheets (S04, S13, P10, P12, P13), each
checked against the answer worked out by hand."""

from stockroom.sources.sheets import (detect_columns, detect_money_column, header_row, pick_inventory_sheet, resolve_aliases,
                                      sheet_body, tidy_columns)


def _sheet(spark, rows):
    n = max(len(r) for r in rows)
    data = [(i, *[(None if v is None else str(v)) for v in (list(r) + [None] * (n - len(r)))]) for i, r in enumerate(rows)]
    schema = "row_idx bigint, " + ", ".join(f"c{j} string" for j in range(n))
    return spark.createDataFrame(data, schema)


def test_header_row_skips_title_and_numeric_rows(spark):
    s = _sheet(spark, [["Price sheet"], ["1", "2", "3"], ["UPC", "Description", "Cost"],
                       ["012345678905", "Blue gear", "$4.10"], [None, None, None], ["012345678912", "Red gear", "5"]])
    assert header_row(s) == 2
    headers, body = sheet_body(s)
    assert headers == ["UPC", "Description", "Cost"]
    assert [r.row_idx for r in body.orderBy("row_idx").collect()] == [3, 5]


def test_detect_columns_by_header_then_by_content(spark):
    s = _sheet(spark, [["Item Name", "Unit Cost", "Qty"], ["Blue gear", "4.10", "3"]])
    headers, body = sheet_body(s)
    assert detect_columns(headers, body) == {"upc": None, "desc": 0, "price": 1, "qty": 2}
    rows = [["Ref", "Name", "Each"]] + [[f"00{900000000000 + i}", f"item {i}", "1.5"] for i in range(6)]
    headers, body = sheet_body(_sheet(spark, rows))
    assert detect_columns(headers, body)["upc"] == 0


def test_money_column_exact_name_then_profile(spark):
    s = _sheet(spark, [["Item", "Net Buy $"], ["a", "10"]])
    headers, body = sheet_body(s)
    assert detect_money_column(headers, body) == (1, False)
    rows = [["Item", "Cases", "Total"]] + [[f"i{k}", str(k + 1), f"{(k + 1) * 12.25:.2f}"] for k in range(5)]
    headers, body = sheet_body(_sheet(spark, rows))
    assert detect_money_column(headers, body) == (2, True)


def test_resolve_aliases_first_occurrence_wins():
    hdr = ["Product UPC", "Units/Case", "Deal Description", "Product UPC", "Net/Unit"]
    aliases = {"upc": ["product upc"], "units": ["units/case"], "netunit": ["net/unit"]}
    assert resolve_aliases(hdr, aliases) == {"upc": 0, "units": 1, "netunit": 4}


def test_tidy_columns(spark):
    df = spark.createDataFrame([(0, "a", "x", None, "h", "1"), (1, "", "y", None, "h", "2"), (2, "b", "z", None, "h", "3")],
                               "row_idx bigint, code string, name string, empty string, helper_col string, name2 string")
    df = df.toDF("row_idx", "code", "name", "empty", "helper_col", "name")
    out = tidy_columns(df, key="code", drop_like=["helper"], preferred=["nam"])
    assert out.columns == ["name", "row_idx", "code"]
    assert [(r.code, r.name) for r in out.orderBy("row_idx").collect()] == [("a", "x"), ("b", "z")]
    twice = df.toDF("row_idx", "code", "name", "empty", "Cost", "Cost (1)")
    assert tidy_columns(twice, key="code", preferred=["cost"]).columns == ["Cost", "row_idx", "code", "name"]


def test_late_evidence_counts(spark):
    rows = [["Ref", "Name"]] + [["x", f"item {i}"] for i in range(60)] + [[f"00{900000000000 + i}", "z"] for i in range(60)]
    headers, body = sheet_body(_sheet(spark, rows))
    assert detect_columns(headers, body)["upc"] == 0
    assert header_row(_sheet(spark, [["1", "2"]] * 20 + [["Code", "Cost"], ["5", "6"]])) == 20
    assert header_row(_sheet(spark, [["1", "2"], ["3", "4"]])) == 0


def test_inventory_sheet_by_required_columns_and_score():
    base = ["OH", "Product Description"]
    sheets = {"notes": ["a"], "plain": base, "locations": [*base, "Location Name"], "windows": [*base, "30D", "90D"], "half": ["OH", "TOH", "PM", "30D"]}
    assert pick_inventory_sheet(sheets) == "locations"
    assert pick_inventory_sheet({"one": base, "two": base}) == "one" and pick_inventory_sheet({"x": ["OH"]}) is None


def test_decisions_from_json(spark, tmp_path):
    from stockroom.operators.decisions import read_decisions
    (tmp_path / "a.json").write_text('[{"dept": "THC", "item": "x", "action": "qty", "qty": 12}, {"item": "y", "qty": "a few", "extra": 1}]')
    got = read_decisions(spark, str(tmp_path / "a.json"), multiline=True).orderBy("item").collect()
    assert [(r.item, r.qty, r.action) for r in got] == [("x", "12", "qty"), ("y", "a few", None)]


def test_sheet_compare_meets_the_upload_twice_and_spreads_rows_without_a_key(spark):
    from stockroom.plans.matching import sheet_compare
    catalog = spark.createDataFrame(
        [("0-01", "Blue  Gear", 4.0, 9.0, 1), ("001", "Blue Gear", 5.0, 10.0, 2), ("002", None, 7.0, 8.0, 3), ("none", "Anvil", 1.0, 2.0, 4),
         ("003", " ", 0.0, 3.0, 5), ("004", "\tOdd", None, 3.0, 6), ("005", "odd", 2.0, 3.0, 7)], "code string, item string, unit_cost double, price double, cat_row bigint")
    stock = spark.createDataFrame([("A", "blue gear", 3, 1.0), ("B", "BLUE GEAR", 4, 20.0), ("A", " ", 1, 1.0)], "dept string, item string, chain_oh bigint, wos double")
    upload = spark.createDataFrame(
        [("00-1", "other", 2.5, 1), ("", "BLUE gear", 2.5, 2), ("002", "blue gear", 1.0, 3), ("002", "", 1.0, 4), (None, None, 1.0, 5), ("999", "anvil", 1.0, 6),
         ("003", "", 1.0, 7), ("", " odd", None, 8), ("", "\tODD", 1.0, 9)], "up_code string, up_item string, up_price double, up_row bigint")
    out = sheet_compare(upload, catalog, stock)
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got == {
        1: ("other", "001", "Yes", 2.5, 5.0, 50.0, 10.0, 4, 20.0, "OVERSTOCK — skip"),
        2: ("BLUE gear", "001", "Yes", 2.5, 5.0, 50.0, 10.0, 4, 20.0, "OVERSTOCK — skip"),
        3: ("blue gear", "001", "Yes", 1.0, 7.0, 85.7, 8.0, 4, 20.0, "OVERSTOCK — skip"),  # the code's own cost, the name's item
        4: ("", "002", "No", 1.0, None, None, None, None, None, "we don't carry / not found"),
        5: ("", "", "No", 1.0, None, None, None, None, None, "we don't carry / not found"),
        6: ("anvil", "999", "No", 1.0, None, None, None, None, None, "we don't carry / not found"),
        7: (" ", "003", "Yes", 1.0, 0.0, None, 3.0, 1, 1.0, "LOW — restock"),
        8: (" odd", "005", "Yes", None, 2.0, None, 3.0, None, None, None),
        9: ("\tODD", "004", "Yes", 1.0, None, None, 3.0, None, None, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3 and plan.count("xxhash64") >= 2  # by code, by name, and the names' listings


def test_cells_are_tested_without_lambdas(spark):
    headers, body = sheet_body(_sheet(spark, [["Ref", "Name"], ["1", None], ["", ""], [None, "x"]]))
    assert headers == ["Ref", "Name"] and [r.row_idx for r in body.orderBy("row_idx").collect()] == [1, 3]
    assert "lambda" not in body._jdf.queryExecution().optimizedPlan().toString()

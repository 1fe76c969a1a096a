"""Land, then load a day, from the command line."""

import json

import pytest

from assayline.__main__ import main, parse
from tests.helpers import EDGE_PRODUCTS, EDGE_RECORDS


def test_land_then_load_a_day(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "1.json").write_text(
        "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in EDGE_RECORDS), encoding="utf-8"
    )
    header = "item_id,name,category,price\n"
    (tmp_path / "products.csv").write_text(
        header + "".join(",".join(map(str, row)) + "\n" for row in EDGE_PRODUCTS), encoding="utf-8"
    )
    at = {name: str(tmp_path / name) for name in ("raw", "bronze", "state", "tables")}
    assert (
        main(["land", "--source", at["raw"], "--bronze", at["bronze"], "--state", at["state"]]) == 0
    )
    load = ["--bronze", at["bronze"], "--products", str(tmp_path / "products.csv")]
    load += ["--warehouse", at["tables"], "--prefix", "cli"]
    assert main(["day", *load, "--run-date", "2026-01-11"]) == 0
    # The copied record landed once, so the day is exact.
    row = spark.table("cli_gold.gold_sales_daily").first()
    assert (row.total_revenue, row.order_count, row.order_date.isoformat()) == (
        121900,
        3,
        "2026-01-10",
    )


def test_a_day_must_be_named():
    with pytest.raises(SystemExit):
        parse(["day", "--bronze", "b", "--products", "p", "--warehouse", "w"])

"""Bronze -> silver -> gold over generated marketplace files with the eight contracts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakelayer.contracts import get_contract
from lakelayer.plans import olist

N_ORDERS, N_CUSTOMERS, N_PRODUCTS, N_SELLERS = 40, 25, 12, 5
ZIPS = ["01001", "02002", "13003", "40004"]


def _ts(d):
    return d.strftime("%Y-%m-%d %H:%M:%S")


def _write(path, contract, rows):
    c = get_contract(contract)
    lines = [",".join(f.header for f in c.fields)]
    for r in rows:
        lines.append(",".join("" if v is None else str(v) for v in r))
    path.write_text("\n".join(lines) + "\n")


def generate(d, city_of=lambda i: f"city{i % 4}"):
    rnd = random.Random(11)
    base = dt.datetime(2017, 3, 1, 9, 0, 0)
    customers = [(f"c{i}", f"u{i}", ZIPS[i % 4], city_of(i), "SP") for i in range(N_CUSTOMERS)]
    customers.append(("c0", "u0", ZIPS[0], city_of(0), "SP"))  # exact duplicate row
    orders, items, payments, reviews = [], [], [], []
    expect = {"items": 0, "paid": {}, "review": {}, "delivery": {}}
    for i in range(N_ORDERS):
        p = base + dt.timedelta(days=i * 7, hours=i)
        delivered = p + dt.timedelta(days=5 + i % 9)
        orders.append((f"o{i}", f"c{i % N_CUSTOMERS}", "delivered", _ts(p), _ts(p), _ts(p), _ts(delivered), _ts(p + dt.timedelta(days=10))))
        for k in range(1 + i % 3):
            items.append((f"o{i}", k + 1, f"p{(i + k) % N_PRODUCTS}", f"s{(i + k) % N_SELLERS}", _ts(p), f"{10 + k}.5", "2.0"))
            expect["items"] += 1
            expect["delivery"][(f"o{i}", k + 1)] = (delivered.date() - p.date()).days
        total = 0.0
        for s in range(1 + i % 2):
            v = round(20 + rnd.random() * 100, 2)
            total += v
            payments.append((f"o{i}", s + 1, "credit_card", 1 + s, v))
        expect["paid"][f"o{i}"] = round(total, 2)
        for r in range(i % 3):
            reviews.append((f"r{i}_{r}", f"o{i}", 1 + (i + r) % 5, "", "", _ts(p), _ts(p + dt.timedelta(days=r))))
        if i % 3:
            expect["review"][f"o{i}"] = 1 + (i + (i % 3) - 1) % 5
    products = [(f"p{j}", "moveis" if j % 2 else "beleza", 10, 100, 1, 500 + j, 10.0, 5.0, 3.0) for j in range(N_PRODUCTS)]
    sellers = [(f"s{k}", ZIPS[k % 4], "city", "sp") for k in range(N_SELLERS)]
    geo = [(z, -23.5 + 0.01 * j, -46.6 - 0.01 * j, "sao paulo", "SP") for z in ZIPS for j in range(5)]
    files = {}
    for name, rows in [("olist_orders", orders), ("olist_order_items", items), ("olist_customers", customers),
                       ("olist_products", products), ("olist_sellers", sellers), ("olist_payments", payments),
                       ("olist_reviews", reviews), ("olist_geolocation", geo)]:
        d.mkdir(exist_ok=True)
        _write(d / f"{name}.csv", name, rows)
        files[name] = str(d / f"{name}.csv")
    return files, expect


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("olist")
    files, expect = generate(d / "day1")
    root = str(d / "lake")
    olist.run_bronze(spark, files, root, "2024-01-01")
    reports = olist.run_silver(spark, root, quality_mode="fail")
    tables = olist.run_gold(spark, root, "2024-01-01")
    return spark, d, root, tables, expect, reports


def test_silver_dedups_and_reports(built):
    spark, _, root, _, _, reports = built
    assert olist.silver(spark, root, "olist_customers").count() == N_CUSTOMERS
    assert all(r["passed"] for rows in reports.values() for r in rows)


def test_fact_grain_and_keys(built):
    spark, _, _, tables, expect, _ = built
    f = tables["fact_orders"].read()
    assert f.count() == expect["items"]
    assert f.filter(F.col("customer_sk").isNull() | F.col("product_sk").isNull() | F.col("seller_sk").isNull() | F.col("geo_sk").isNull()).count() == 0
    assert f.select("order_sk").distinct().count() == expect["items"]


def test_fact_measures(built):
    spark, _, _, tables, expect, _ = built
    rows = tables["fact_orders"].read().collect()
    for r in rows:
        assert r.payment_value == pytest.approx(expect["paid"][r.order_id])
        assert r.review_score == expect["review"].get(r.order_id)
        assert r.delivery_days == expect["delivery"][(r.order_id, r.order_item_id)]
        assert r.order_year_month == r.order_year_month[:7]


def test_dimensions(built):
    spark, _, _, tables, _, _ = built
    assert tables["dim_date"].read().count() == 5844
    geo = {r.zip_code: r for r in tables["dim_geography"].read().collect()}
    assert set(geo) == set(ZIPS) and geo["01001"].lat == pytest.approx(-23.48)
    assert tables["dim_customer"].read().filter("is_current").count() == N_CUSTOMERS


def test_second_day_versions_customers(built):
    spark, d, root, _, _, _ = built
    files, _ = generate(d / "day2", city_of=lambda i: "moved" if i == 3 else f"city{i % 4}")
    olist.run_bronze(spark, files, root, "2024-01-02")
    olist.run_silver(spark, root)
    tables = olist.run_gold(spark, root, "2024-01-02")
    dc = tables["dim_customer"].read()
    versions = dc.filter(F.col("customer_id") == "c3").orderBy("valid_from").collect()
    assert [(v.city, v.is_current) for v in versions] == [("city3", False), ("moved", True)]
    assert dc.filter("is_current").count() == N_CUSTOMERS
    f = tables["fact_orders"].read()
    # purchases in 2017 resolve to the first version of c3 (open to the past)
    old_sk = versions[0].customer_sk
    assert f.join(dc.select("customer_sk", "customer_id"), "customer_sk").filter(F.col("customer_id") == "c3").select("customer_sk").distinct().collect()[0][0] == old_sk
    assert f.count() == sum(1 + i % 3 for i in range(N_ORDERS))


def test_cli_runs_all_layers(spark, tmp_path, capsys):
    import json

    from lakelayer import cli

    files, _ = generate(tmp_path / "landing")
    rc = cli.main(["all", "--landing", str(tmp_path / "landing"), "--lake", str(tmp_path / "lake"),
                   "--batch-id", "b1", "--as-of", "2024-01-01"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rc == 0 and set(out) == {"bronze", "silver", "gold"}
    assert out["bronze"]["olist_orders"] == {"total": N_ORDERS, "clean": N_ORDERS, "quarantine": 0}
    assert out["gold"]["fact_orders"]

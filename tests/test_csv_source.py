"""Contract CSV reads: faults, reasons, projection independence, multi-line, by-name."""

import json

import pytest
from pyspark.sql import functions as F

from lakelayer.contracts import Contract, ContractRegistry
from lakelayer.sources.csv import read_csv_contract

FIELDS = [
    {"name": "id", "type": "string", "nullable": False},
    {"name": "n", "type": "integer", "nullable": False},
    {"name": "price", "type": "double", "nullable": True},
    {"name": "ts", "type": "timestamp", "nullable": True},
    {"name": "note", "type": "string", "nullable": True},
]

FAULTS = "\n".join(
    [
        "id,n,price,ts,note",
        "a1,10,1.5,2024-01-02 03:04:05,plain",
        "a2,xx,2.0,2024-01-02 03:04:05,bad int",
        "a3,8.0,2.0,2024-01-02 03:04:05,int with fraction",
        "a4,4,2.0",
        "a5,5,2.0,2024-01-02 03:04:05,long,extra",
        ",6,2.0,2024-01-02 03:04:05,empty key",
        "a7,7,2.0,2024-01-02,date only",
        "a8,8,2.0,2024-01-02 03:04:05.5,fractional second",
        'a9,9,2.0,2024-01-02 03:04:05,"say ""hi"""',
    ]
) + "\n"

EXPECTED = {
    "a1": None,
    "a2": "bad_type:n",
    "a3": "bad_type:n",
    "a4": "malformed_record",
    "a5": "malformed_record",
    None: "missing_required_field:id",
    "a7": "bad_type:ts",
    "a8": "bad_type:ts",
    "a9": None,
}


def contract(multi_line=False, by_name=False):
    fields = [dict(f, source_name=f"src_{f['name']}") if by_name else f for f in FIELDS]
    return Contract.from_dict({"name": "t", "fields": fields, "format": {"header": True, "multiLine": multi_line}})


@pytest.fixture()
def faults_csv(tmp_path):
    p = tmp_path / "faults.csv"
    p.write_text(FAULTS)
    return str(p)


def test_reasons_per_fault(spark, faults_csv):
    df = read_csv_contract(spark, faults_csv, contract())
    got = {r.id: r._quarantine_reason for r in df.collect()}
    assert got == EXPECTED


def test_values_are_typed_and_quotes_unescaped(spark, faults_csv):
    rows = {r.id: r for r in read_csv_contract(spark, faults_csv, contract()).collect()}
    assert rows["a1"].n == 10 and rows["a1"].price == 1.5
    assert str(rows["a1"].ts) == "2024-01-02 03:04:05"
    assert rows["a9"].note == 'say "hi"'
    assert rows["a2"].n is None


@pytest.mark.parametrize("cols", [["id", "_quarantine_reason"], ["_quarantine_reason"], ["n", "_corrupt_record", "_quarantine_reason"]])
def test_classification_does_not_depend_on_projection(spark, faults_csv, cols):
    df = read_csv_contract(spark, faults_csv, contract()).select(*cols)
    assert df.filter(F.col("_quarantine_reason") == "malformed_record").count() == 2
    assert df.filter(F.col("_quarantine_reason").isNotNull()).count() == 7


def test_multiline_records(spark, tmp_path):
    p = tmp_path / "ml.csv"
    p.write_text('id,n,price,ts,note\nb1,1,1.0,2024-01-02 03:04:05,"line one\nline two"\nb2,2,2.0,2024-01-02 03:04:05,ok\n')
    rows = {r.id: r for r in read_csv_contract(spark, str(p), contract(multi_line=True)).collect()}
    assert set(rows) == {"b1", "b2"}
    assert rows["b1"].note == "line one\nline two" and rows["b1"]._quarantine_reason is None


def test_match_by_name_reordered_header(spark, tmp_path):
    p = tmp_path / "reordered.csv"
    p.write_text("src_note,src_ts,src_price,src_n,src_id\nhello,2024-01-02 03:04:05,3.5,7,z1\n")
    r = read_csv_contract(spark, str(p), contract(by_name=True), match_by_name=True).collect()[0]
    assert (r.id, r.n, r.price, r.note, r._quarantine_reason) == ("z1", 7, 3.5, "hello", None)


def test_match_by_name_missing_header_fails(spark, tmp_path):
    p = tmp_path / "short.csv"
    p.write_text("src_id,src_n\nz1,1\n")
    with pytest.raises(ValueError, match="header lacks"):
        read_csv_contract(spark, str(p), contract(by_name=True), match_by_name=True)


def test_source_file_column(spark, faults_csv):
    df = read_csv_contract(spark, faults_csv, contract(), source_file=True)
    assert {r[0].endswith("faults.csv") for r in df.select("_source_file").collect()} == {True}


def test_olist_contract_reads_positionally(spark, tmp_path):
    c = ContractRegistry().get("olist_orders")
    p = tmp_path / "orders.csv"
    p.write_text(",".join(f.header for f in c.fields) + "\n"
                 "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,,2017-10-10 21:25:13,2017-10-18 00:00:00\n")
    r = read_csv_contract(spark, str(p), c).collect()[0]
    assert r.order_id == "o1" and r.carrier_delivery_ts is None and r._quarantine_reason is None

import json

import pytest
from pyspark.sql import types as T

from lakelayer.contracts import ContractRegistry, get_contract


def _write(d, name, version, fields):
    (d / f"{name}_v{version}.json").write_text(json.dumps({"name": name, "version": version, "fields": fields}))


def test_latest_version_is_numeric(tmp_path):
    for v in (1, 2, 10):
        _write(tmp_path, "orders", v, [{"name": f"c{v}", "type": "string", "nullable": True}])
    c = ContractRegistry(tmp_path).get("orders")
    assert c.version == 10 and c.names == ["c10"]


def test_prefix_names_do_not_collide(tmp_path):
    _write(tmp_path, "orders", 1, [{"name": "a", "type": "string"}])
    _write(tmp_path, "orders_items", 3, [{"name": "b", "type": "string"}])
    assert ContractRegistry(tmp_path).get("orders").names == ["a"]


def test_missing_contract_names_it(tmp_path):
    with pytest.raises(FileNotFoundError, match="nope"):
        ContractRegistry(tmp_path).get("nope")


def test_unknown_type_names_type_and_file(tmp_path):
    _write(tmp_path, "bad", 1, [{"name": "x", "type": "varchar2"}])
    with pytest.raises(ValueError, match="varchar2.*bad_v1.json"):
        ContractRegistry(tmp_path).get("bad")


def test_typed_schema_types_nullability_description():
    s = get_contract("olist_orders").typed_schema()
    assert s["order_id"].dataType == T.StringType() and not s["order_id"].nullable
    assert s["purchase_ts"].dataType == T.TimestampType()
    assert s["approved_ts"].nullable
    assert s["order_id"].metadata["description"]


@pytest.mark.parametrize("name", ContractRegistry().names())
def test_every_contract_loads(name):
    c = get_contract(name)
    assert c.fields and c.typed_schema().fieldNames() == c.names
    assert all(f.dataType == T.StringType() for f in c.raw_schema().fields)


def test_reviews_contract_reads_multiline_and_items_key_is_composite():
    assert get_contract("olist_reviews").multi_line
    assert get_contract("olist_order_items").key == ("order_id", "order_item_id")


def test_decimal_and_extra_types():
    from lakelayer.contracts import spark_type

    assert spark_type("decimal(12,2)") == T.DecimalType(12, 2)
    assert spark_type("timestamp_ntz") == T.TimestampNTZType()
    assert spark_type("long") == T.LongType()

"""The eight source contracts ingested by one parameterised bronze job."""

import pytest
from pyspark.sql import functions as F

from lakelayer.contracts import ContractRegistry, get_contract
from lakelayer.plans import bronze as B

OLIST = [n for n in ContractRegistry().names() if n.startswith("olist_")]
N = 20


def _cell(f, i):
    if f.type == "integer":
        return str(i + 1)
    if f.type == "double":
        return f"{i}.25"
    if f.type.startswith("timestamp"):
        return f"2017-10-{(i % 28) + 1:02d} 10:56:33"
    return f"{f.name}_{i}"


def _rows(contract):
    """Generated rows: 3 empty first field, 5 a non-numeric number (if any),
    7 an extra field; the reviews contract gets a quoted line break in row 2."""
    lines = [",".join(f.header for f in contract.fields)]
    expected = {}
    numeric = [f for f in contract.fields if f.type in ("integer", "double")]
    for i in range(N):
        cells = [_cell(f, i) for f in contract.fields]
        reason = None
        if i == 7:
            cells.append("extra")
            reason = "malformed_record"
        elif i == 5 and numeric:
            cells[contract.fields.index(numeric[0])] = "n/a"
            reason = f"bad_type:{numeric[0].name}"
        elif i == 3:
            cells[0] = ""
            reason = f"missing_required_field:{contract.fields[0].name}"
        elif i == 2 and contract.multi_line:
            j = next(k for k, f in enumerate(contract.fields) if f.name == "comment")
            cells[j] = '"first line\nsecond line"'
        lines.append(",".join(cells))
        expected[i] = reason
    return "\n".join(lines) + "\n", expected


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    out = {}
    for name in OLIST:
        text, expected = _rows(get_contract(name))
        (d / f"{name}.csv").write_text(text)
        out[name] = (str(d / f"{name}.csv"), expected)
    return out


def test_eight_contracts(landing):
    assert len(OLIST) == 8


def test_run_all_counts_and_reasons(spark, landing, tmp_path):
    root = str(tmp_path / "bronze")
    results = B.run_all(spark, {n: p for n, (p, _) in landing.items()}, root, batch_id="2024-01-01")
    for name, res in results.items():
        expected = landing[name][1]
        n_bad = sum(r is not None for r in expected.values())
        assert (res.total_rows, res.quarantine_rows, res.clean_rows) == (N, n_bad, N - n_bad), name
        got = sorted(r[0] for r in B.quarantine(res.table).select("_quarantine_reason").collect())
        assert got == sorted(r for r in expected.values() if r), name
        clean = B.clean(res.table)
        assert "_corrupt_record" not in clean.columns and clean.count() == N - n_bad
        assert clean.filter(F.col("_source_file").isNull() | F.col("_ingested_at").isNull()).count() == 0


def test_rerun_of_a_batch_replaces_it(spark, landing, tmp_path):
    root = str(tmp_path / "bronze")
    src = {"olist_orders": landing["olist_orders"][0]}
    B.run_all(spark, src, root, batch_id="b1")
    res = B.run_all(spark, src, root, batch_id="b1")["olist_orders"]
    assert res.table.read().count() == N
    B.run_all(spark, src, root, batch_id="b2")
    assert res.table.read().count() == 2 * N


def test_multiline_review_survives(spark, landing, tmp_path):
    res = B.ingest(spark, "olist_reviews", landing["olist_reviews"][0], str(tmp_path / "r"), "b1")
    row = B.clean(res.table).filter(F.col("review_id") == "review_id_2").collect()[0]
    assert row.comment == "first line\nsecond line"

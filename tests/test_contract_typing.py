"""Contract typing rules against a brute-force Python statement of the same rules."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lakelayer.contracts import Contract
from lakelayer.operators.contract import apply_contract

INT_RE = re.compile(r"[+-]?[0-9]+")
NUM_RE = re.compile(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?")

CONTRACT = Contract.from_dict(
    {
        "name": "p",
        "fields": [
            {"name": "k", "type": "string", "nullable": False},
            {"name": "i", "type": "integer", "nullable": True},
            {"name": "d", "type": "double", "nullable": False},
            {"name": "b", "type": "boolean", "nullable": True},
            {"name": "t", "type": "timestamp_ntz", "nullable": True},
        ],
    }
)


def brute(row):
    k, i, d, b, t = row
    ti = None
    if i is not None and INT_RE.fullmatch(i) and -(2**31) <= int(i) < 2**31:
        ti = int(i)
    td = float(d) if d is not None and NUM_RE.fullmatch(d) else None
    tb = {"true": True, "false": False}.get(b.lower()) if b is not None else None
    tt = None
    if t is not None and re.fullmatch(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", t):
        try:
            tt = dt.datetime.strptime(t, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            tt = None
    reason = None
    for name, raw, typed in (("i", i, ti), ("d", d, td), ("b", b, tb), ("t", t, tt)):
        if raw is not None and typed is None:
            reason = f"bad_type:{name}"
            break
    if reason is None:
        if k is None:
            reason = "missing_required_field:k"
        elif td is None:
            reason = "missing_required_field:d"
    return (k, ti, td, tb, tt, reason)


cell = st.one_of(
    st.none(),
    st.text(alphabet="0123456789+-.eE", max_size=8),
    st.integers(min_value=-(2**40), max_value=2**40).map(str),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(repr),
)
boolean = st.one_of(st.none(), st.sampled_from(["true", "FALSE", "True", "yes", "0", ""]))
stamp = st.one_of(
    st.none(),
    st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 1, 1)).map(lambda x: x.strftime("%Y-%m-%d %H:%M:%S")),
    st.sampled_from(["2024-02-30 00:00:00", "2024-01-01", "2024-01-01 10:00:00.5", "2024-13-01 00:00:00", "x"]),
)
rows = st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=3)), cell, cell, boolean, stamp), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(rows)
def test_typing_matches_brute_force(spark, data):
    # empty strings stand for NULL cells, as the CSV reader reads them
    data = [tuple(None if v == "" else v for v in r) for r in data]
    df = spark.createDataFrame(data, "k string, i string, d string, b string, t string")
    got = [tuple(r) for r in apply_contract(df, CONTRACT).collect()]
    want = [brute(r) for r in data]
    assert sorted(got, key=repr) == sorted(want, key=repr)

"""Contract projection: raw strings in, typed columns plus one reason out.

Sources are read with every field as a string. ``apply_contract`` then types
each field with a ``try_``-style expression and classifies the row in the same
projection, so a single narrow stage (no shuffle, no cache, no second scan)
yields both the clean value and why a row is rejected.

Reason precedence (first match wins):

1. ``malformed_record``            the parser flagged the line (ragged, bad quoting)
2. ``bad_type:<field>``            a non-empty cell failed its conversion, fields in contract order
3. ``missing_required_field:<field>`` a required field is NULL, fields in contract order

Reading every ``bad_type:*`` as ``malformed_record`` gives the two-reason
scheme of a typed CSV read in PERMISSIVE mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.contracts import Contract, _DECIMAL

CORRUPT_COL = "_corrupt_record"
REASON_COL = "_quarantine_reason"

# Fixed text patterns: what a well-formed numeric cell looks like.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
DECIMAL_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def typed_value(raw: Column, type_name: str, timestamp_format: str) -> Column:
    """Convert a raw string cell to the contract type; NULL when it does not fit."""
    if type_name == "string":
        return raw
    if type_name in ("integer", "long"):
        target = "int" if type_name == "integer" else "bigint"
        return F.when(raw.rlike(INTEGER_PATTERN), raw.try_cast(target))
    if type_name == "double":
        return F.when(raw.rlike(DECIMAL_PATTERN), raw.try_cast("double"))
    if _DECIMAL.match(type_name):
        return F.when(raw.rlike(DECIMAL_PATTERN), raw.try_cast(type_name))
    if type_name == "boolean":
        low = F.lower(raw)
        return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
    if type_name == "timestamp":
        return F.try_to_timestamp(raw, F.lit(timestamp_format))
    if type_name == "timestamp_ntz":
        return F.try_to_timestamp(raw, F.lit(timestamp_format)).cast("timestamp_ntz")
    if type_name == "date":
        return F.try_to_timestamp(raw, F.lit("yyyy-MM-dd")).cast("date")
    raise ValueError(f"unknown contract type '{type_name}'")


def reason_column(
    contract: Contract,
    raw: dict[str, Column],
    typed: dict[str, Column],
    corrupt: Column | None,
) -> Column:
    branches: list[tuple[Column, str]] = []
    if corrupt is not None:
        branches.append((corrupt.isNotNull(), "malformed_record"))
    for f in contract.fields:
        if f.type != "string":
            branches.append((raw[f.name].isNotNull() & typed[f.name].isNull(), f"bad_type:{f.name}"))
    for f in contract.fields:
        if f.required:
            branches.append((typed[f.name].isNull(), f"missing_required_field:{f.name}"))
    if not branches:
        return F.lit(None).cast("string")
    expr = F.when(branches[0][0], F.lit(branches[0][1]))
    for cond, label in branches[1:]:
        expr = expr.when(cond, F.lit(label))
    return expr


def apply_contract(
    raw_df: DataFrame,
    contract: Contract,
    corrupt_col: str | None = CORRUPT_COL,
    keep: list[str] | None = None,
) -> DataFrame:
    """Type ``raw_df`` (string columns named as the contract) and add the reason.

    ``keep`` lists extra columns (e.g. file metadata) carried through unchanged.
    The output has the contract fields in order, then ``keep``, then the
    corrupt column (if present) and ``_quarantine_reason`` (NULL = clean).
    """
    missing = [n for n in contract.names if n not in raw_df.columns]
    if missing:
        raise ValueError(f"contract {contract.name}: columns absent from input: {missing}")
    raw = {f.name: F.col(f.name).cast("string") for f in contract.fields}
    typed = {f.name: typed_value(raw[f.name], f.type, contract.timestamp_format) for f in contract.fields}
    has_corrupt = corrupt_col is not None and corrupt_col in raw_df.columns
    corrupt = F.col(corrupt_col) if has_corrupt else None
    # Conversions come in a step of their own: in the branches of the reason Spark would
    # convert every cell again.
    converted = {f"_typed_{f.name}": typed[f.name] for f in contract.fields if f.type != "string"}
    typed = {f.name: F.col(f"_typed_{f.name}") if f.type != "string" else raw[f.name] for f in contract.fields}
    cols = [typed[f.name].alias(f.name) for f in contract.fields]
    cols += [F.col(c) for c in (keep or [])]
    if has_corrupt:
        cols.append(F.col(corrupt_col))
    cols.append(reason_column(contract, raw, typed, corrupt).alias(REASON_COL))
    return raw_df.select("*", *[c.alias(n) for n, c in converted.items()]).select(*cols)

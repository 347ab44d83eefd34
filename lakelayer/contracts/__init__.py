"""Versioned data contracts.

A contract is a JSON file ``<name>_v<k>.json`` listing fields with a type, a
nullability flag (a quality rule: NULL in a required field sends the row to
quarantine), an optional ``source_name`` (the header in the raw file) and a
description. The highest *numeric* version wins, so ``v10`` beats ``v2``.

The contract is turned into two Spark schemas: the raw one (every field a
string, which is how sources are read so that no cell is lost to a failed
conversion) and the typed one, which ``operators.contract.apply_contract``
produces with ``try_cast`` expressions.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

DEFS_DIR = Path(__file__).parent / "defs"

_SIMPLE_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
}
_DECIMAL = re.compile(r"^decimal\((\d+),\s*(\d+)\)$")
_VERSIONED = re.compile(r"^(?P<name>.+)_v(?P<version>\d+)\.json$")


def spark_type(type_name: str, where: str = "") -> T.DataType:
    if type_name in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[type_name]
    m = _DECIMAL.match(type_name)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    raise ValueError(f"unknown contract type '{type_name}'{' in ' + where if where else ''}")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    source_name: str | None = None
    description: str = ""

    @property
    def required(self) -> bool:
        return not self.nullable

    @property
    def header(self) -> str:
        return self.source_name or self.name


@dataclass(frozen=True)
class Contract:
    name: str
    version: int
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    header: bool = True
    multi_line: bool = False
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
    description: str = ""
    options: dict = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def typed_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    spark_type(f.type, self.name),
                    f.nullable,
                    {"description": f.description},
                )
                for f in self.fields
            ]
        )

    def raw_schema(self) -> T.StructType:
        """Every field as a nullable string, in file order."""
        return T.StructType([T.StructField(f.name, T.StringType(), True) for f in self.fields])

    @classmethod
    def from_dict(cls, d: dict, where: str = "") -> "Contract":
        fields = tuple(
            Field(
                name=f["name"],
                type=f["type"],
                nullable=bool(f.get("nullable", True)),
                source_name=f.get("source_name"),
                description=f.get("description", ""),
            )
            for f in d["fields"]
        )
        for f in fields:
            spark_type(f.type, where or d.get("name", ""))
        fmt = d.get("format", {})
        return cls(
            name=d["name"],
            version=int(d.get("version", 1)),
            fields=fields,
            key=tuple(d.get("key", ())),
            header=bool(fmt.get("header", True)),
            multi_line=bool(fmt.get("multiLine", False)),
            timestamp_format=fmt.get("timestampFormat", "yyyy-MM-dd HH:mm:ss"),
            description=d.get("description", ""),
            options={k: v for k, v in fmt.items() if k not in ("header", "multiLine", "timestampFormat")},
        )


class ContractRegistry:
    """Finds the latest version of a contract by name in a directory."""

    def __init__(self, directory: str | Path = DEFS_DIR):
        self.directory = Path(directory)

    def versions(self, name: str) -> list[tuple[int, Path]]:
        found = []
        for p in self.directory.glob(f"{name}_v*.json"):
            m = _VERSIONED.match(p.name)
            if m and m.group("name") == name:
                found.append((int(m.group("version")), p))
        return sorted(found)

    def path(self, name: str) -> Path:
        versions = self.versions(name)
        if not versions:
            raise FileNotFoundError(f"no contract named '{name}' in {self.directory}")
        return versions[-1][1]

    def get(self, name: str) -> Contract:
        p = self.path(name)
        with open(p) as fh:
            return Contract.from_dict(json.load(fh), where=p.name)

    def names(self) -> list[str]:
        out = set()
        for p in self.directory.glob("*_v*.json"):
            m = _VERSIONED.match(p.name)
            if m:
                out.add(m.group("name"))
        return sorted(out)


def get_contract(name: str) -> Contract:
    return ContractRegistry().get(name)

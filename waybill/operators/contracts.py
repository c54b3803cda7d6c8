"""Table contracts: declared columns with treatments and validations, read from JSON or built in code."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Check:
    """A named check; ``columns`` are its arguments (the column, unless given), ``null_columns`` the cells it nulls (its arguments)."""

    check: str
    reason: str
    columns: tuple[str, ...] = ()
    null_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    key: bool = False
    treatments: tuple[str, ...] = ()
    validations: tuple[Check, ...] = ()
    new_name: str | None = None

    @property
    def output(self) -> str:
        return self.new_name or self.name


@dataclass(frozen=True)
class TableContract:
    table_name: str
    columns: tuple[ColumnSpec, ...]
    partitioned_by: tuple[str, ...] = ("ingest_date",)
    description: str = ""
    keys: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(c.name for c in self.columns if c.key and not c.new_name))

    @property
    def plain(self) -> list[ColumnSpec]:
        return [c for c in self.columns if not c.new_name]

    @property
    def derived(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.new_name]


class ContractError(ValueError):
    """A frame or a declaration does not fit its contract."""


def from_dict(data: dict) -> TableContract:
    def check(v: dict) -> Check:
        return Check(v["check"], v["reason"], tuple(v.get("columns") or ()), tuple(v.get("null_columns") or ()))

    columns = [
        ColumnSpec(c["name"], c["type"], bool(c.get("key")), tuple(c.get("treatments") or ()), tuple(map(check, c.get("validations") or ())), c.get("new_name"))
        for c in data["schema"]
    ]
    return TableContract(data["table_name"], tuple(columns), tuple(data.get("partitioned_by") or ()), data.get("description", ""))


def load(path: str) -> TableContract:
    return from_dict(json.loads(Path(path).read_text(encoding="utf-8")))


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Declared columns in declared order; others are dropped. Raises ContractError on a missing column or another type."""
    types = dict(df.dtypes)
    wanted = [c for c in contract.columns if c.output not in contract.partitioned_by]
    problems = [f"{c.output} is missing" if c.output not in types else f"{c.output} is {types[c.output]}, not {c.type}" for c in wanted if types.get(c.output) != c.type]
    if problems:
        raise ContractError(f"{contract.table_name}: {'; '.join(problems)}")
    return df.select(*(c.output for c in wanted))

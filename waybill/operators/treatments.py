"""Treatments: what a contract does to values before they are judged."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .contracts import ColumnSpec, ContractError, TableContract

TREATMENTS: dict[str, Callable[[Column], Column]] = {
    "trim": F.trim,
    "normalize": text.upper_trim,
    "parse_date": text.lenient_timestamp,
    "normalize_cpf": text.digits,
    "normalize_telefone": text.national_phone,
}


def treated(column: Column, spec: ColumnSpec) -> Column:
    """The spec's treatments in order; an unknown one is a ContractError."""
    if unknown := [t for t in spec.treatments if t not in TREATMENTS]:
        raise ContractError(f"{spec.name}: no treatment named {', '.join(unknown)}")
    return reduce(lambda c, name: TREATMENTS[name](c), spec.treatments, column)


def trim_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.trim(n) for n in names})


def drop_keyless(df: DataFrame, keys) -> DataFrame:
    """Rows whose key parts are all filled; rows that repeat a key stay."""
    return df.where(reduce(lambda a, k: a & text.filled(F.col(k)), keys, F.lit(True)))


def apply_treatments(df: DataFrame, contract: TableContract) -> DataFrame:
    """Treat and cast every declared column that is present, in one projection; malformed values become null."""
    specs = {c.name: c for c in contract.plain}
    out = [treated(F.col(n), specs[n]).try_cast(specs[n].type).alias(n) if n in specs else F.col(n) for n in df.columns]
    return drop_keyless(df.select(*out), contract.keys)


def derive(df: DataFrame, contract: TableContract) -> DataFrame:
    """Columns made from others after validation, so a nulled cell gives null."""
    made = {c.new_name: treated(F.col(c.name), c).try_cast(c.type) for c in contract.derived if c.name in df.columns}
    return df.withColumns(made) if made else df

"""Declared table constraints: DDL columns, and rows split into sound ones and ones that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

BROKEN = "broken_rules"


@dataclass(frozen=True)
class Constraints:
    """PRIMARY KEY, NOT NULL and VARCHAR(n) of a table (a key column is never null)."""
    key: Sequence[str]
    not_null: Sequence[str] = ()
    lengths: Mapping[str, int] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return list(dict.fromkeys([*self.key, *self.not_null]))


def ddl(schema: StructType, constraints: Constraints) -> str:
    """Column list of a CREATE TABLE: VARCHAR(n) and NOT NULL where declared."""
    def one(f):
        kind = f"VARCHAR({constraints.lengths[f.name]})" if f.name in constraints.lengths else f.dataType.simpleString()
        return f"`{f.name}` {kind}{' NOT NULL' if f.name in constraints.required else ''}"
    return ", ".join(map(one, schema.fields))


def broken_rules(constraints: Constraints) -> Column:
    """The names of the rules a row breaks, as an array (empty for a sound row)."""
    rules = [F.when(F.col(c).isNull(), F.lit(f"{c} NOT NULL")) for c in constraints.required]
    rules += [F.when(F.length(c) > n, F.lit(f"{c} VARCHAR({n})")) for c, n in constraints.lengths.items()]
    return F.array_compact(F.array(*rules))


def with_broken_rules(df: DataFrame, constraints: Constraints) -> DataFrame:
    """``df`` and its broken rules. A generated column: Catalyst leaves a filter on it above, where a
    filter on a projected one would repeat the typing of all checked columns once per rule."""
    return df.select("*", F.explode(F.array(broken_rules(constraints))).alias(BROKEN))

"""Table contracts: column types, nullability, text lengths and keys."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.casts import readable
from snapledger.operators.checkplan import CheckPlan


REJECTED = "_rejected"


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    nullable: bool = True
    max_length: int | None = None


@dataclass(frozen=True)
class Contract:
    """What one stored table promises.

    ``layer`` is ``snapshot`` or ``report``; report tables may not keep a history.
    """

    table: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    layer: str = "snapshot"

    def __post_init__(self):
        names = [f.name for f in self.fields]
        # a row without its key could never meet its history
        required = tuple(replace(f, nullable=False) if f.name in self.keys else f for f in self.fields)
        object.__setattr__(self, "fields", required)
        missing = [c for c in (*self.keys, *self.partition_by) if c not in names]
        if missing or len(set(names)) != len(names):
            raise ValueError(f"{self.table}: bad contract, unknown or repeated columns {missing}")

    @property
    def ordered(self) -> tuple[Field, ...]:
        """Keys first, in key order; then the rest as declared."""
        by_name = {f.name: f for f in self.fields}
        return tuple(by_name[k] for k in self.keys) + tuple(
            f for f in self.fields if f.name not in self.keys
        )

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.ordered]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T.DataType.fromDDL(f.type), f.nullable) for f in self.ordered]
        )

    @property
    def staged_schema(self) -> T.StructType:
        """The schema with the column that names unreadable values."""
        return T.StructType([*self.schema.fields, T.StructField(REJECTED, T.StringType())])

    def conform(self, df: DataFrame, mark_rejects: bool = False) -> DataFrame:
        """Contract columns in contract order. A value that does not fit its type becomes
        NULL; ``mark_rejects`` adds a column naming such values so that none is lost quietly."""
        columns = [readable(df, f.name, f.type).alias(f.name) for f in self.ordered]
        if mark_rejects:
            names = F.concat_ws(",", *[
                F.when(bad, F.lit(name)) for name, bad in self._unreadable(df).items()])
            columns.append(F.nullif(names, F.lit("")).alias(REJECTED))
        return df.select(*columns)

    def _unreadable(self, df: DataFrame) -> dict[str, Column]:
        """Cast failures, for the columns whose type is not the contract's already."""
        stored = {f.name: f.dataType for f in df.schema}
        return {
            f.name: F.col(f.name).isNotNull() & readable(df, f.name, f.type).isNull()
            for f in self.ordered if stored[f.name] != T.DataType.fromDDL(f.type)
        }

    def rules(self, df: DataFrame) -> dict[str, Column]:
        """Conditions that mark a bad row, by name of the check."""
        rules = {}
        for f in self.ordered:
            if not f.nullable:
                rules[f"{self.table}.{f.name}:required"] = F.col(f.name).isNull()
            if f.max_length is not None:
                text = F.col(f.name).cast("string")
                rules[f"{self.table}.{f.name}:length"] = F.length(text) > f.max_length
        for name, bad in self._unreadable(df).items():
            rules[f"{self.table}.{name}:type"] = bad
        if REJECTED in df.columns:
            rules[f"{self.table}:type"] = F.col(REJECTED).isNotNull()
        return rules

    def violations(self, df: DataFrame) -> DataFrame:
        """(check, n_checked, n_bad): all column rules and key uniqueness, in one pass."""
        return self.register(CheckPlan(), df).frame()

    def register(self, plan: CheckPlan, df: DataFrame) -> CheckPlan:
        return plan.rules(df, self.rules(df)).unique(f"{self.table}:unique_key", df, self.keys)

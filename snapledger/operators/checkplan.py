"""Checks that are registered first and then computed together, reading every frame once.

Each check is a fold over keys. A row of a frame turns into one entry for all its row rules and one
for each keyed check (the entry holds the check's number, the key as text, and what the row adds to
either side of the check). The entries of all frames are united, combined per key, and judged in one
aggregate: comparing two frames needs no join, and a frame that ten checks look at is scanned once.
Entries combine on the map side, so copies of a hot key shrink before they travel.

A NULL in a key counts as a value of its own, except that no reference row can match it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.checks import CheckFailed

_SUMS = ("nl", "nr", "l", "r")  # rows and totals of the left and of the right side


def _count(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _key_text(columns: Sequence[str | Column]) -> Column:
    """Values as one text; lengths keep neighbouring values apart."""
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    return F.concat_ws(";", *parts) if parts else F.lit("")


def _any_null(columns: Sequence[str | Column]) -> Column:
    nulls = [(F.col(c) if isinstance(c, str) else c).isNull() for c in columns]
    return reduce(lambda a, b: a | b, nulls, F.lit(False))


@dataclass(frozen=True)
class _Entry:
    """What a row adds to one fold."""

    fold: int
    key: Column
    right: bool = False
    value: Column | None = None
    where: Column | None = None
    variant: Column | None = None

    def struct(self, rules: Sequence[Column], width: int, variants: bool) -> Column:
        side, other = ("r", "l") if self.right else ("l", "r")
        value = _count(0) if self.value is None else self.value.cast("bigint")
        flags = [F.coalesce(bad, F.lit(False)).cast("bigint") for bad in rules]
        flags += [_count(0)] * (width - len(flags))
        fields = {"fold": F.lit(self.fold), "key": self.key, f"n{side}": _count(1), f"n{other}": _count(0),
                  side: value, other: _count(0) if self.value is None else F.lit(None).cast("bigint")}
        if variants:
            fields["variant"] = F.lit(None).cast("string") if self.variant is None else self.variant
        names = ["fold", "key", *_SUMS, *(["variant"] if variants else [])]
        made = F.struct(*[fields[n].alias(n) for n in names], *[b.alias(f"b{i}") for i, b in enumerate(flags)])
        return made if self.where is None else F.when(self.where, made)


@dataclass
class _Frame:
    df: DataFrame
    fold: int
    rules: list[Column] = field(default_factory=list)
    entries: list[_Entry] = field(default_factory=list)


@dataclass(frozen=True)
class _Check:
    """A finding: sums over the folded keys of ``fold``; ``column`` is the rule's number."""

    name: str
    kind: str
    fold: int
    column: int = 0
    rows: int | None = None  # fold that counts the rows checked, where it is another one

    def contributions(self) -> tuple[Column, Column]:
        """(checked, bad) of one folded key."""
        here = F.col("fold") == self.fold
        nl, nr, left, right = (F.col(c) for c in _SUMS)
        agree = F.coalesce((nl > 0) & (nr > 0) & (left == right), F.lit(False))
        mapped = self.kind in ("unmapped", "flawed")
        if self.kind == "rule":
            checked, bad = nl, F.col(f"b{self.column}")
        elif self.kind in ("not_empty", "count"):
            checked, bad = nl, _count(0)
        elif self.kind == "tally":
            checked, bad = F.col(f"b{self.column}"), _count(0)
        elif self.kind == "balance":
            checked, bad = nl, nl - nr
        elif mapped:
            checked, bad = nl, F.when(nr == 0 if self.kind == "unmapped" else (nr > 0) & (right > 0), nl)
        else:
            wrong = {
                "unique": nl > 1,
                "known": nr == 0,
                "equal": ~agree,
                "left_equal": ~agree,
                "whole": ~F.coalesce((nl > 0) & (left == F.coalesce(right, _count(0))), F.lit(False)),
                "conflict": F.col("variants") > 1 if self.kind == "conflict" else F.lit(False),
            }[self.kind]
            counted = F.lit(True) if self.kind in ("equal", "whole") else nl > 0
            checked, bad = F.when(counted, _count(1)), F.when(counted & wrong, _count(1))
        at = here if self.rows is None else F.col("fold") == self.rows
        return F.when(at, nl if self.rows is not None else checked), F.when(here, bad)


class CheckPlan:
    """Register checks on any number of frames, then ``frame()`` or ``findings()`` once."""

    def __init__(self):
        self._frames: list[_Frame] = []
        self._checks: list[_Check] = []
        self._others: list[DataFrame] = []
        self._folds = 0

    def _fold(self) -> int:
        self._folds += 1
        return self._folds - 1

    def _frame(self, df: DataFrame) -> _Frame:
        for known in self._frames:
            if known.df is df or (known.df.columns == df.columns and known.df.sameSemantics(df)):
                return known
        self._frames.append(_Frame(df, self._fold()))
        return self._frames[-1]

    def rules(self, df: DataFrame, rules: Mapping[str, Column]) -> CheckPlan:
        """Rows that break a rule."""
        frame = self._frame(df)
        for name, bad in rules.items():
            self._checks.append(_Check(name, "rule", frame.fold, len(frame.rules)))
            frame.rules.append(bad)
        return self

    def not_empty(self, name: str, df: DataFrame) -> CheckPlan:
        self._checks.append(_Check(name, "not_empty", self._frame(df).fold))
        return self

    def count(self, name: str, df: DataFrame) -> CheckPlan:
        """Rows of a frame; never a failure."""
        self._checks.append(_Check(name, "count", self._frame(df).fold))
        return self

    def alias(self, name: str, other: str) -> CheckPlan:
        """A finding under a second name."""
        self._checks.append(replace(next(c for c in self._checks if c.name == name), name=other))
        return self

    def tally(self, df: DataFrame, wanted: Mapping[str, Column]) -> CheckPlan:
        """Rows that meet a condition, as the number checked; never a failure."""
        frame = self._frame(df)
        for name, condition in wanted.items():
            self._checks.append(_Check(name, "tally", frame.fold, len(frame.rules)))
            frame.rules.append(condition)
        return self

    def unique(self, name: str, df: DataFrame, keys: Sequence[str]) -> CheckPlan:
        """Keys that occur more than once; the keys are what is counted."""
        fold = self._fold()
        self._frame(df).entries.append(_Entry(fold, _key_text(keys)))
        self._checks.append(_Check(name, "unique", fold))
        return self

    def conflict(self, name: str, df: DataFrame, keys: Sequence[str], values: Sequence[str],
                 where: Column | None = None) -> CheckPlan:
        """Keys whose rows disagree on ``values``, compared value by value."""
        fold = self._fold()
        self._frame(df).entries.append(_Entry(fold, _key_text(keys), where=where, variant=_key_text(values)))
        self._checks.append(_Check(name, "conflict", fold))
        return self

    def known(self, name: str, df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> CheckPlan:
        """Distinct keys that the reference lacks."""
        self._both(name, "known", df, reference, keys, keys, right_where=~_any_null(keys))
        return self

    def mapped(self, df: DataFrame, reference: DataFrame, key: str, missing: str, flawed: str,
               flaw: Column, where: Column | None = None) -> CheckPlan:
        """Rows whose key the reference lacks (``missing``) or holds with a flaw (``flawed``).
        All rows count as checked."""
        rows = self._frame(df).fold
        self._both(missing, "unmapped", df, reference, [key], [key], left_where=where,
                   right_where=~_any_null([key]), right_value=F.coalesce(flaw, F.lit(False)).cast("bigint"))
        self._checks[-1] = replace(self._checks[-1], rows=rows)
        self._checks.append(replace(self._checks[-1], name=flawed, kind="flawed"))
        return self

    def equal(self, name: str, left: DataFrame, right: DataFrame, keys: Sequence[str | Column],
              total: str, left_where: Column | None = None, right_where: Column | None = None,
              every: str = "either", right_keys: Sequence[str | Column] | None = None,
              left_total: str | None = None) -> CheckPlan:
        """Keys whose totals differ; ``every`` says whose keys count: ``either`` side's or ``left``."""
        kind = {"either": "equal", "left": "left_equal"}[every]
        self._both(name, kind, left, right, keys, right_keys or keys, F.col(left_total or total), F.col(total),
                   left_where, right_where)
        return self

    def whole(self, name: str, df: DataFrame, keys: Sequence[str], is_whole: Column, total: str,
              where: Column | None = None) -> CheckPlan:
        """Keys whose total row is not the sum of the key's other rows."""
        among = F.lit(True) if where is None else where
        self._both(name, "whole", df, df, keys, keys, F.col(total), F.col(total),
                   among & is_whole, among & ~is_whole)
        return self

    def rows_equal(self, name: str, left: DataFrame, right: DataFrame) -> CheckPlan:
        """Equal row counts; the finding is the size of the difference."""
        self._both(name, "balance", left, right, [], [])
        return self

    def _both(self, name, kind, left, right, left_keys, right_keys, left_value=None, right_value=None,
              left_where=None, right_where=None) -> None:
        fold = self._fold()
        self._frame(left).entries.append(
            _Entry(fold, _key_text(left_keys), value=left_value, where=left_where))
        self._frame(right).entries.append(
            _Entry(fold, _key_text(right_keys), right=True, value=right_value, where=right_where))
        self._checks.append(_Check(name, kind, fold))

    def add(self, checks: DataFrame | CheckPlan) -> CheckPlan:
        """Another plan, whose frames join this one's, or findings that are computed by themselves."""
        if isinstance(checks, DataFrame):
            self._others.append(checks)
            return self
        moved: dict[int, int] = {}

        def at(fold: int) -> int:
            if fold not in moved:
                moved[fold] = self._fold()
            return moved[fold]

        first_rule: dict[int, int] = {}
        for frame in checks._frames:
            mine = self._frame(frame.df)
            moved[frame.fold], first_rule[frame.fold] = mine.fold, len(mine.rules)
            mine.rules += frame.rules
            mine.entries += [replace(e, fold=at(e.fold)) for e in frame.entries]
        self._checks += [replace(
            c, fold=at(c.fold), column=c.column + first_rule.get(c.fold, 0),
            rows=None if c.rows is None else at(c.rows)) for c in checks._checks]
        self._others += checks._others
        return self

    def frame(self) -> DataFrame:
        """(check, n_checked, n_bad), one row per check, also where a frame is empty."""
        parts = ([self._folded()] if self._checks else []) + self._others
        return reduce(DataFrame.unionByName, parts)

    def _folded(self) -> DataFrame:
        width = max(len(f.rules) for f in self._frames)
        variants = any(e.variant is not None for f in self._frames for e in f.entries)
        flags = [f"b{i}" for i in range(width)]
        entries = []
        for f in self._frames:
            made = [_Entry(f.fold, F.lit("")).struct(f.rules, width, variants)]
            made += [e.struct([], width, variants) for e in f.entries]
            row = F.array(*made)
            if any(e.where is not None for e in f.entries):
                row = F.array_compact(row)
            entries.append(f.df.select(F.inline(row)))
        sums = [F.sum(c).alias(c) for c in (*_SUMS, *flags)]
        folded = reduce(DataFrame.unionAll, entries)
        if variants:
            folded = folded.groupBy("fold", "key", "variant").agg(*sums)
            sums.append(F.count("variant").alias("variants"))
        folded = folded.groupBy("fold", "key").agg(*sums)
        totals = []
        for i, check in enumerate(self._checks):
            checked, bad = check.contributions()
            totals.append(F.coalesce(F.sum(checked), _count(0)).alias(f"checked_{i}"))
            totals.append(F.coalesce(F.sum(bad), _count(0)).alias(f"bad_{i}"))
        one = folded.agg(*totals)
        rows = []
        for i, check in enumerate(self._checks):
            checked, bad = F.col(f"checked_{i}"), F.col(f"bad_{i}")
            bad = F.abs(bad) if check.kind == "balance" else bad
            bad = F.when(checked == 0, _count(1)).otherwise(_count(0)) if check.kind == "not_empty" else bad
            rows.append(F.struct(F.lit(check.name).alias("check"), checked.alias("n_checked"), bad.alias("n_bad")))
        return one.select(F.inline(F.array(*rows)))

    def findings(self) -> dict[str, tuple[int, int]]:
        """{check: (n_checked, n_bad)}; brings one row per check to the driver."""
        if not self._checks and not self._others:
            return {}
        found: dict[str, tuple[int, int]] = {}
        for row in self.frame().collect():
            checked, bad = found.get(row["check"], (0, 0))
            found[row["check"]] = (checked + row["n_checked"], bad + row["n_bad"])
        return found

    def enforce(self) -> dict[str, tuple[int, int]]:
        """The findings, if all are good; else raises with every failed check."""
        found = self.findings()
        failed = sorted((name, bad) for name, (_, bad) in found.items() if bad > 0)
        if failed:
            raise CheckFailed(failed)
        return found

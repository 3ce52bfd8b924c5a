"""Versions by observation time: complete snapshots compared with what is stored.

Convention: ``valid_from``/``valid_to`` are UTC observation times, ``valid_to`` is exclusive
and NULL while open. A key that disappears gets a tombstone version, a key that returns
gets another live one. See ``scd2`` for the convention by valid date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.hashing import length_prefixed_md5
from snapledger.operators.checks import (
    count_bad,
    duplicate_key_check,
    enforce,
    union_checks,
)

# Columns the history adds, and columns that never count as a change.
META = {
    "version_no": "bigint",
    "valid_from": "timestamp",
    "valid_to": "timestamp",
    "is_current": "tinyint",
    "row_hash": "string",
    "is_deleted": "tinyint",
    "change_type": "string",
}
IGNORED = ("processed_at", "updated_at", "created_at", "ingestion_timestamp")


class HistoryRefused(RuntimeError):
    """The snapshot does not fit the stored history; nothing may be written."""


def _payload(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    return [*keys, *[c for c in columns if c not in keys]]


def guard_schema(snapshot: DataFrame, keys: Sequence[str], history: DataFrame | None = None) -> None:
    """Keys exist, no reserved names, and the column list is the stored one."""
    reserved = sorted(set(snapshot.columns) & set(META))
    if reserved:
        raise HistoryRefused(f"reserved column names in the snapshot: {reserved}")
    if not keys or not set(keys) <= set(snapshot.columns):
        raise HistoryRefused(f"history keys {list(keys)} are not all in the snapshot")
    if history is not None:
        expected = [*_payload(snapshot.columns, keys), *META]
        if history.columns != expected:
            raise HistoryRefused(f"history columns changed: {history.columns} != {expected}")
        stored = {f.name: f.dataType for f in history.schema}
        moved = [f.name for f in snapshot.schema if stored[f.name] != f.dataType]
        if moved:
            raise HistoryRefused(f"history column types changed: {moved}")


def empty_history(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A history without rows for this snapshot's columns."""
    guard_schema(snapshot, keys)
    kinds = {f.name: f.dataType for f in snapshot.schema}
    fields = [T.StructField(n, kinds[n]) for n in _payload(snapshot.columns, keys)]
    fields += [T.StructField(n, T.DataType.fromDDL(t)) for n, t in META.items()]
    return snapshot.sparkSession.createDataFrame([], T.StructType(fields))


def input_checks(current: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What must hold before a step: complete keys, one snapshot row and one current row each."""
    return union_checks(
        count_bad(snapshot, {"history:keys_not_null": _null_key(keys)}),
        duplicate_key_check("history:snapshot_unique_key", snapshot, keys),
        duplicate_key_check("history:one_current_row", current, keys),
    )


def row_hash(columns: Sequence[str], keys: Sequence[str], ignored: Sequence[str] = IGNORED) -> Column:
    """The hash that tells whether a row changed."""
    return length_prefixed_md5([c for c in _payload(columns, keys) if c not in ignored])


def _incoming(snapshot: DataFrame, keys: Sequence[str], ignored: Sequence[str]) -> DataFrame:
    names = _payload(snapshot.columns, keys)
    return snapshot.select(*names, row_hash(names, keys, ignored).alias("_hash"))


def _nth(keys: Sequence[str]) -> Column:
    """Number of a row among those of its key. The window clusters and sorts on the keys, as
    the join that follows does, so it costs no shuffle of its own."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(keys[0]))


def _null_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _refusing(df: DataFrame, keys: Sequence[str], column: str, side: str) -> DataFrame:
    """``df`` with ``column`` raising at a row whose key is incomplete or was there before."""
    def refuse(what: str) -> Column:
        shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        return F.raise_error(F.concat(F.lit(f"{side}: {what}: "), shown)).cast("string")

    return df.withColumn("_nth", _nth(keys)).withColumn(
        column, F.when(_null_key(keys), refuse("incomplete key"))
        .when(F.col("_nth") > 1, refuse("a key occurs twice")).otherwise(F.col(column))).drop("_nth")


def _events() -> tuple[Column, Column, Column]:
    """(opens a version, deletes, closes the old version) over joined columns."""
    present, known = F.col("s._hash").isNotNull(), F.col("h.row_hash").isNotNull()
    tombstone = F.col("h.is_deleted") == 1
    opens = present & (~known | tombstone | (F.col("h.row_hash") != F.col("s._hash")))
    deletes = known & ~present & ~tombstone
    return opens, deletes, known & (opens | deletes)


def _joined(h: DataFrame, s: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = [F.col(f"h.{k}") == F.col(f"s.{k}") for k in keys]
    return h.alias("h").join(s.alias("s"), on, "full_outer")


def has_changes(
    current: DataFrame, snapshot: DataFrame, keys: Sequence[str],
    ignored: Sequence[str] = IGNORED,
) -> bool:
    """Whether a step would add a version. Joins keys and hashes only, stops at the first hit."""
    h = current.select(*keys, "row_hash", "is_deleted")
    s = _incoming(snapshot, keys, ignored).select(*keys, "_hash")
    opens, deletes, _ = _events()
    return not _joined(h, s, keys).filter(opens | deletes).select(F.lit(1)).isEmpty()


def _versions(
    names: Sequence[str], moment: Column, opens: Column, deletes: Column, new: str, new_hash: str,
) -> Column:
    """The versions a joined row stands for: the stored one (``h``) as it was or closed now,
    and the one that is opened, with the payload of ``new`` unless it is a tombstone."""
    known = F.col("h.row_hash").isNotNull()
    closes = known & (opens | deletes)

    def version(payload, **meta):
        return F.struct(*[c.alias(n) for n, c in zip(names, payload)],
                        *[meta[n].cast(t).alias(n) for n, t in META.items()])

    kept = version(
        [F.col(f"h.{n}") for n in names],
        version_no=F.col("h.version_no"), valid_from=F.col("h.valid_from"),
        valid_to=F.when(closes, moment).otherwise(F.col("h.valid_to")),
        is_current=F.when(closes, 0).otherwise(1), row_hash=F.col("h.row_hash"),
        is_deleted=F.col("h.is_deleted"), change_type=F.col("h.change_type"),
    )
    kind = (
        F.when(deletes, "DELETE").when(~known, "INITIAL")
        .when(F.col("h.is_deleted") == 1, "REACTIVATED").otherwise("CHANGE")
    )
    opened = version(
        [F.when(deletes, F.col(f"h.{n}")).otherwise(F.col(f"{new}.{n}")) for n in names],
        version_no=F.coalesce(F.col("h.version_no"), F.lit(0)) + 1, valid_from=moment,
        valid_to=F.lit(None), is_current=F.lit(1),
        row_hash=F.when(deletes, F.col("h.row_hash")).otherwise(F.col(new_hash)),
        is_deleted=F.when(deletes, 1).otherwise(0), change_type=kind,
    )
    return (
        F.when(closes, F.array(kept, opened)).when(known, F.array(kept)).otherwise(F.array(opened)))


def history_delta(
    current: DataFrame, snapshot: DataFrame, keys: Sequence[str], stamp: Column,
    ignored: Sequence[str] = IGNORED,
) -> DataFrame:
    """Compare the current rows with a complete snapshot.

    Returns the new set of current rows plus the rows this step closes (``is_current`` 0);
    versions closed earlier are neither read nor written. One full outer join decides
    new, changed, reactivated and deleted keys, and each joined row unfolds into the old
    and the new version in place, so every input row is shuffled once. A key that is
    incomplete or occurs twice on a side fails the query that reads the result.
    """
    guard_schema(snapshot, keys, current)
    names = _payload(snapshot.columns, keys)
    opens, deletes, _ = _events()
    joined = _joined(
        _refusing(current, keys, "row_hash", "stored history"),
        _refusing(_incoming(snapshot, keys, ignored), keys, "_hash", "snapshot"), keys)
    return joined.select(F.inline(
        _versions(names, stamp.cast("timestamp"), opens, deletes, "s", "s._hash")))


@dataclass(frozen=True)
class Changed:
    """What a comparison found: versions to open by kind, and what must not occur."""

    opened: Mapping[str, int]
    unchanged: int
    repeated_snapshot: int
    repeated_current: int
    null_keys: int
    last_stamp: int | None  # of the stored versions, microseconds since 1970

    @property
    def any(self) -> bool:
        return sum(self.opened.values()) > 0

    @property
    def live(self) -> int:
        """Live current rows after the step."""
        return self.unchanged + sum(n for kind, n in self.opened.items() if kind != "DELETE")


# What can happen to a key.
KINDS = ("INITIAL", "CHANGE", "REACTIVATED", "DELETE")


def change_set(current: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """(keys and ``_event`` of every key, the aggregates that describe them as ``Changed``).

    Reads keys, hashes and flags only: ``current`` has ``row_hash``, ``is_deleted`` and
    ``valid_from``, ``snapshot`` has ``_row_hash``. Rows that repeat a key are told by
    ``_event`` REPEATED and REPEATED_CURRENT instead of being joined with each other. An unchanged
    key has the event UNCHANGED, a tombstone that stays has GONE.
    """
    def first_of_each(df, *columns):
        return df.select(*keys, *columns).withColumn("_nth", _nth(keys))

    h = first_of_each(current, "row_hash", "is_deleted", "valid_from")
    s = first_of_each(snapshot, F.col("_row_hash").alias("_hash"))
    # a row beyond the first of its key joins with no first one; not an equality of two columns,
    # which would join by more than the keys the windows are clustered on
    on = [F.col(f"h.{k}") == F.col(f"s.{k}") for k in keys] + [F.col("h._nth") - F.col("s._nth") == 0]
    joined = h.alias("h").join(s.alias("s"), on, "full_outer")
    opens, deletes, _ = _events()
    event = (
        F.when(F.coalesce("s._nth", F.lit(1)) > 1, "REPEATED")
        .when(F.coalesce("h._nth", F.lit(1)) > 1, "REPEATED_CURRENT")
        .when(deletes, "DELETE").when(opens & F.col("h.row_hash").isNull(), "INITIAL")
        .when(opens & (F.col("h.is_deleted") == 1), "REACTIVATED").when(opens, "CHANGE")
        .when(F.col("s._hash").isNull(), "GONE").otherwise("UNCHANGED")
    )
    events = joined.select(
        *[F.coalesce(f"s.{k}", f"h.{k}").alias(k) for k in keys], event.alias("_event"),
        F.unix_micros("h.valid_from").alias("_stamp"))
    facts = {kind: F.count_if(F.col("_event") == kind) for kind in (
        *KINDS, "UNCHANGED", "REPEATED", "REPEATED_CURRENT")}
    facts["null_keys"] = F.count_if(_null_key(keys))
    facts["last_stamp"] = F.max("_stamp")
    return events, facts


def changed(facts: Mapping[str, int]) -> Changed:
    """``Changed`` from the values of the aggregates of ``change_set``."""
    return Changed(
        {kind: facts.get(kind) or 0 for kind in KINDS}, facts.get("UNCHANGED") or 0,
        facts.get("REPEATED") or 0, facts.get("REPEATED_CURRENT") or 0, facts.get("null_keys") or 0,
        facts.get("last_stamp"))


def apply_changes(
    current: DataFrame, changes: DataFrame, snapshot: DataFrame, keys: Sequence[str], stamp: Column,
) -> DataFrame:
    """The current rows and those just closed, after the events of ``changes`` (keys, ``_event``).

    ``snapshot`` carries ``_row_hash``. Its rows, and nothing else, are fetched for the changed keys,
    and each current row meets at most one event, so a few changes are broadcast to the rows they
    belong to and the payload of unchanged rows is not shuffled.
    """
    payload = snapshot.select(*keys, F.struct(*snapshot.columns).alias("_new"))
    events = changes.filter(F.col("_event") != "DELETE").join(payload, list(keys)).unionByName(
        changes.filter(F.col("_event") == "DELETE"), allowMissingColumns=True)
    names = _payload([c for c in snapshot.columns if c != "_row_hash"], keys)
    moment = stamp.cast("timestamp")
    event = F.col("e._event")
    deletes = F.coalesce(event == "DELETE", F.lit(False))
    opens = event.isNotNull() & ~deletes
    old = events.filter(F.col("_event") != "INITIAL")
    on = [F.col(f"h.{k}") == F.col(f"e.{k}") for k in keys]
    moved = current.alias("h").join(old.alias("e"), on, "left")
    rest = moved.select(F.inline(_versions(names, moment, opens, deletes, "e._new", "e._new._row_hash")))
    meta = {"version_no": F.lit(1), "valid_from": moment, "valid_to": F.lit(None), "is_current": F.lit(1),
            "row_hash": F.col("_new._row_hash"), "is_deleted": F.lit(0), "change_type": F.lit("INITIAL")}
    new = events.filter(F.col("_event") == "INITIAL").select(
        *[F.col(f"_new.{n}").alias(n) for n in names], *[meta[n].cast(t).alias(n) for n, t in META.items()])
    return rest.unionByName(new)


def opened_rows(snapshot: DataFrame, keys: Sequence[str], stamp: Column) -> DataFrame:
    """The first version of every row of a snapshot that carries ``_row_hash``."""
    names = _payload([c for c in snapshot.columns if c != "_row_hash"], keys)
    meta = {"version_no": F.lit(1), "valid_from": stamp, "valid_to": F.lit(None), "is_current": F.lit(1),
            "row_hash": F.col("_row_hash"), "is_deleted": F.lit(0), "change_type": F.lit("INITIAL")}
    return snapshot.select(*names, *[meta[n].cast(t).alias(n) for n, t in META.items()])


def history_step(
    history: DataFrame, snapshot: DataFrame, keys: Sequence[str], stamp: Column,
    ignored: Sequence[str] = IGNORED, checked: bool = False,
) -> DataFrame:
    """The whole history after one more complete snapshot.

    Repeated or incomplete keys on either side are refused before anything is compared, with
    all findings, which computes both inputs once more. With ``checked`` no job is run here:
    such a key then fails the query that reads the result.
    """
    if not checked:
        enforce(input_checks(history.filter("is_current = 1"), snapshot, keys))
    delta = history_delta(history.filter("is_current = 1"), snapshot, keys, stamp, ignored)
    return history.filter("is_current = 0").unionByName(delta)


def history_baseline(
    history: DataFrame | None, existing: DataFrame, keys: Sequence[str], stamp: Column,
    ignored: Sequence[str] = IGNORED, checked: bool = False,
) -> DataFrame:
    """A missing or empty history starts from the table as it stands; otherwise keep it.

    ``checked`` is that of ``history_step``.
    """
    if history is not None and not history.isEmpty():
        return history
    return history_step(empty_history(existing, keys), existing, keys, stamp, ignored, checked)


def next_stamp(current: DataFrame, now: datetime) -> datetime:
    """Observation time of a step in UTC: now, but always after every stored version.

    A time without zone is the machine's local time.
    """
    return stamp_after(current.agg(F.unix_micros(F.max("valid_from")).alias("last")).first()["last"], now)


def stamp_after(last: int | None, now: datetime) -> datetime:
    """``now`` in UTC, or just after ``last`` (microseconds since 1970) if that is later."""
    now = now.astimezone(timezone.utc)
    if last is None:
        return now
    return max(now, datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=last + 1))


def counted_checks(spark: SparkSession, facts: Mapping[str, int]) -> DataFrame:
    """Counts that must be zero, already known, as checks."""
    return spark.createDataFrame(
        [(name, abs(bad), abs(bad)) for name, bad in facts.items()], "check string, n_checked bigint, n_bad bigint")


def step_facts(found: Changed, snapshot_rows: int, before: int, written: Mapping[str, int]) -> dict[str, int]:
    """The rules of ``step_checks``, from what the comparison and the write counted.

    ``before`` is the number of current rows compared, ``written`` has ``rows``, ``current`` and
    ``live`` of what was stored for them.
    """
    n_opened = sum(found.opened.values())
    return {
        "history:live_rows_equal_snapshot": found.live - snapshot_rows,
        "history:one_current_row": found.repeated_current,
        "history:rows_equal_old_and_opened": written["rows"] - before - n_opened,
        "history:current_rows": written["current"] - before - found.opened["INITIAL"],
    }


def step_checks(
    delta: DataFrame, snapshot: DataFrame, keys: Sequence[str], before: DataFrame | None = None,
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """What must hold after a step, before it is published: live current rows are as many
    as the snapshot's rows, every key has one current row, and, given the current rows
    ``before``, each of these is still there and each row more is a version just opened.
    With ``counted`` (see ``step_facts``) these are known and no frame is read."""
    if counted is not None:
        return counted_checks(delta.sparkSession, counted)
    live = delta.filter("is_current = 1 AND is_deleted = 0").select(F.lit(1).alias("_side"))
    wanted = snapshot.select(F.lit(-1).alias("_side"))
    balance = live.unionAll(wanted).agg(
        F.count_if(F.col("_side") == 1).alias("n_checked"), F.abs(F.sum("_side")).alias("n_bad"))
    more = []
    if before is not None:
        latest = delta.agg(F.count(F.lit(1)).alias("n"), F.max("valid_from").alias("at"))
        opened = delta.join(F.broadcast(latest.select("at")), F.col("valid_from") == F.col("at"))
        side = before.select(F.lit(1).alias("_side")).unionAll(opened.select(F.lit(1))).unionAll(
            delta.select(F.lit(-1)))
        more.append(side.agg(
            F.count_if(F.col("_side") == -1).alias("n_checked"),
            F.coalesce(F.abs(F.sum("_side")), F.lit(0)).cast("bigint").alias("n_bad"),
        ).select(F.lit("history:rows_equal_old_and_opened").alias("check"), "n_checked", "n_bad"))
    return union_checks(
        *more,
        balance.select(
            F.lit("history:live_rows_equal_snapshot").alias("check"), "n_checked",
            F.coalesce("n_bad", F.lit(0)).cast("bigint").alias("n_bad"),
        ),
        duplicate_key_check("history:one_current_row", delta.filter("is_current = 1"), keys),
    )


def history_chain(
    snapshots: DataFrame, keys: Sequence[str], period: str,
    runs: Sequence[tuple[str, datetime | str]], ignored: Sequence[str] = IGNORED,
) -> DataFrame:
    """The history that stepping through all ``runs`` in order would leave behind.

    ``runs`` lists (period label, observation time), oldest first; a period outside it is
    an error. Instead of one join per run, each key's rows are ordered once: neighbours
    tell changes, gaps tell deletions and returns. A key has at most one row per run.
    """
    frame = snapshots.drop(period)
    guard_schema(frame, keys)
    names = _payload(frame.columns, keys)
    stamps = F.array(*[F.lit(stamp).cast("timestamp") for _, stamp in runs])
    order = F.array_position(F.array(*[F.lit(label) for label, _ in runs]), F.col(period))
    place = F.when(order > 0, order).otherwise(
        F.raise_error(F.concat(F.lit("period outside the runs: "), F.col(period))).cast("bigint"))
    by_run = Window.partitionBy(*keys).orderBy("_run")

    seen = snapshots.select(
        *keys, F.struct(*names).alias("_payload"),
        length_prefixed_md5([c for c in names if c not in ignored]).alias("_hash"),
        place.cast("int").alias("_run"),
    ).select(
        "*",
        F.lag("_run").over(by_run).alias("_run_before"),
        F.lag("_hash").over(by_run).alias("_hash_before"),
        F.lead("_run").over(by_run).alias("_run_after"),
    )
    twice = F.raise_error(F.concat(F.lit("a key occurs twice in run "), F.col("_run"))).cast("string")
    own = (
        F.when(F.col("_run_before").isNull(), "INITIAL")
        .when(F.col("_run") == F.col("_run_before"), twice)
        .when(F.col("_run") > F.col("_run_before") + 1, "REACTIVATED")
        .when(F.col("_hash") != F.col("_hash_before"), "CHANGE")
    )
    vanishes = F.coalesce(F.col("_run_after"), F.lit(len(runs) + 1)) > F.col("_run") + 1
    happened = F.filter(
        F.array(
            F.struct(F.col("_run").alias("at"), own.alias("change_type")),
            F.struct((F.col("_run") + 1).alias("at"), F.when(vanishes, "DELETE").alias("change_type")),
        ),
        lambda e: e["change_type"].isNotNull(),
    )
    events = seen.select(*keys, "_payload", "_hash", F.inline(happened))

    by_event = Window.partitionBy(*keys).orderBy("at")
    deleted = F.col("change_type") == "DELETE"
    versions = events.select(
        *keys, "at", "change_type",
        F.row_number().over(by_event).alias("version_no"),
        F.lead("at").over(by_event).alias("_until"),
        F.when(deleted, F.lag("_payload").over(by_event)).otherwise(F.col("_payload")).alias("_payload"),
        F.when(deleted, F.lag("_hash").over(by_event)).otherwise(F.col("_hash")).alias("row_hash"),
    )
    meta = {
        "version_no": F.col("version_no"),
        "valid_from": F.element_at(stamps, F.col("at")),
        "valid_to": F.when(F.col("_until").isNotNull(), F.element_at(stamps, F.col("_until"))),
        "is_current": F.when(F.col("_until").isNull(), 1).otherwise(0),
        "row_hash": F.col("row_hash"),
        "is_deleted": F.when(deleted, 1).otherwise(0),
        "change_type": F.col("change_type"),
    }
    return versions.select(
        *[F.col(f"_payload.{n}").alias(n) for n in names],
        *[meta[n].cast(t).alias(n) for n, t in META.items()],
    )


def history_lookup(history: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All versions of the wanted keys: those of one key together, in version order. Clustering
    the hits is enough for that; a global order would have to sample them first."""
    hits = history.join(wanted.select(*keys).distinct(), list(keys), "left_semi")
    return hits.repartition(*keys).sortWithinPartitions(*keys, "version_no")


def lookup_filter(wanted: Sequence[Mapping[str, object]]) -> Column:
    """Rows with one of the given keys, as comparisons that a Parquet scan can test against the
    least and the greatest key of a row group."""
    return reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in key.items()]) for key in wanted])


def run_history(
    history: DataFrame | None, snapshot: DataFrame, keys: Sequence[str], now: datetime,
    existing: DataFrame | None = None, ignored: Sequence[str] = IGNORED,
) -> tuple[DataFrame, bool]:
    """One guarded run over a history held in memory: baseline, checks, step.

    Returns the history and whether it changed. The stored form lives in ``storage.publish``.
    """
    if history is None or history.isEmpty():
        history = empty_history(snapshot, keys)
        if existing is not None:
            history = history_step(history, existing, keys, F.lit(now), ignored)
    current = history.filter("is_current = 1")
    enforce(input_checks(current, snapshot, keys))
    if not has_changes(current, snapshot, keys, ignored):
        return history, False
    stamp = next_stamp(current, now)
    return history_step(history, snapshot, keys, F.lit(stamp), ignored, checked=True), True

"""Packing token sequences by shortest-pack-first over the histogram of lengths.

A document's ids and an end id are cut into full pieces and one rest. Only the counts by length
(at most ``size``) reach the driver. There lengths are placed longest first, each into the open
packs with the most room that still hold it, and counts of packing patterns are kept instead of
packs. Each length's places are intervals of ranks, and pieces find theirs by their rank within
their length. The patterns number a few thousand at most, whatever the number of documents.

Null texts count as empty; an empty text is one piece with the end id alone. Repeated rows come
back repeated. Only the id and text columns are read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.bpe import vocabulary_encoder
from snapledger.llm.common import pick, rank_within, text_of, write_once

SIZE = 1024
END_ID = 0
ROWS_PER_BUCKET = 50_000
Pattern = tuple[int, tuple[int, ...]]  # packs of the kind, lengths in a pack


def plan(histogram: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Patterns that hold every length as often as ``histogram`` says."""
    by_room: dict[int, list[Pattern]] = {}
    rooms: list[int] = []  # largest first

    def add(count: int, lengths: tuple[int, ...]) -> None:
        room = size - sum(lengths)
        if room not in by_room:
            by_room[room] = []
            heapq.heappush(rooms, -room)
        by_room[room].append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = -rooms[0] if rooms else 0
            if room < length:
                each, rest = divmod(left, size // length)
                if each:
                    add(each, (length,) * (size // length))
                if rest:
                    add(1, (length,) * rest)
                break
            count, lengths = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                heapq.heappop(rooms)
            used = min(count, left)
            if used < count:
                add(count - used, lengths)
            add(used, (*lengths, length))
            left -= used
    return [pattern for patterns in by_room.values() for pattern in patterns]


def padding(patterns: list[Pattern], size: int = SIZE) -> int:
    """Ids of padding: packs are filled up to ``size`` unless their length is a power of two."""
    total = 0
    for count, lengths in patterns:
        used = sum(lengths)
        total += count * (size - used) if used & (used - 1) else 0
    return total


def intervals(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first rank, offset)."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            first = taken.get(length, 0)
            out.append((length, first, first + count, sequence, offset))
            taken[length] = first + count
            offset += length
        sequence += count
    return out


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                     ("ids", pa.list_(pa.int32()))])
_PIECES_SQL = ("doc_id long, start long, length long, doc_tokens long, ids_crc32 long, "
               "ids array<int>")


def _cut(batches: Iterator[pa.RecordBatch], json_path: str, ranks_path: str, size: int,
         end_id: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encode = vocabulary_encoder(json_path, ranks_path).encode
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
            raw = memoryview(ids.tobytes())
            for start in range(0, len(ids), size):
                part = ids[start:start + size]
                rows.append((doc_id, start, len(part), len(ids),
                             zlib.crc32(raw[4 * start:4 * (start + size)]),
                             part.astype("i4") if keep_ids else None))
        columns = zip(*rows, strict=True) if rows else ((),) * len(_PIECES)
        yield pa.record_batch([pa.array(column, kind) for column, kind in
                               zip(columns, _PIECES.types, strict=True)], schema=_PIECES)


def pieces(docs: DataFrame, json_path: str, ranks_path: str, id_col: str = "doc_id",
           text_col: str = "text", size: int = SIZE, end_id: int = END_ID,
           keep_ids: bool = True) -> DataFrame:
    """Each document's ids and the end id in pieces of at most ``size``, with a checksum of the ids."""
    texts = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    cut = partial(_cut, json_path=json_path, ranks_path=ranks_path, size=size, end_id=end_id,
                  keep_ids=keep_ids)
    out = texts.mapInArrow(cut, _PIECES_SQL)
    return out if keep_ids else out.drop("ids")


def place(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``; it is read twice, so pass a stored table."""
    spark: SparkSession = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(
        intervals(plan(histogram, size)),
        "_length long, _first long, _end long, _sequence long, offset long")
    buckets = 1 + sum(histogram.values()) // ROWS_PER_BUCKET
    ranked = rank_within(cut, "length", ["doc_id", "start", "ids_crc32"], "_rank", buckets)
    fits = ((F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first"))
            & (F.col("_rank") < F.col("_end")))
    return (
        ranked.join(F.broadcast(places), fits)
        .withColumn("sequence_id", F.col("_sequence") + F.col("_rank") - F.col("_first"))
        .drop("_rank", "_length", "_first", "_end", "_sequence")
    )


def pack(docs: DataFrame, json_path: str, ranks_path: str, id_col: str = "doc_id",
         text_col: str = "text", size: int = SIZE, end_id: int = END_ID,
         keep_ids: bool = True) -> DataFrame:
    """One row per piece with its sequence and offset; the pieces are stored once in between."""
    cut = pieces(docs, json_path, ranks_path, id_col, text_col, size, end_id, keep_ids)
    return place(write_once(cut, "pieces"), size)

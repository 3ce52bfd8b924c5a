"""Phrases whose words keep company, counted over a prefix-free parse of the corpus.

Punctuation and line ends cut texts into pieces of words. A word whose hash says so is a trigger: it
ends a chunk and begins the next one, and a chunk reaches on over three words of its successor, so that
every phrase of up to four words lies within the chunk its first word belongs to. Equal passages are
cut alike wherever they stand, so the distinct chunks with their frequencies are a dictionary of the
corpus, and phrases are counted inside it, weighted, each at the chunk that owns its first word.

Phrases travel as 96-bit hashes with one chunk that holds them, and only those that are met often enough
are looked up there. (Two of 10^12 phrases share a hash with a chance below 10^-4.) Words are counted
first, then pairs of frequent words, then phrases whose neighbouring words all form frequent pairs, by
maps of fixed size; a full map would let more phrases be counted and lose none. The counts are exact.

Defined results: a null text counts as empty, a null language as ``und``; ids are not read. Equal
scores are ordered by count, then by the phrase's bytes. Repeated rows count as often as they stand.
Very long texts are parsed in slices of whole pieces, a piece without punctuation as a whole. Other
columns are never read. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import pick, text_of, write_once

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a phrase
COVERED = 80  # percent of a phrase's occurrences inside a longer one that drop it
TOP = 2000
TRIGGER = 16  # one of so many words is a trigger
SCALE = 2_000_000
MAP_BITS = 26

_SLICE = 1_000_000  # bytes parsed at once
_PENDING = 1_000_000  # entries a task combines before it passes them on
# What separates pieces, what separates words, and A-Z, as bytes.
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(
    _BREAKS + b"\t" + bytes(range(65, 91)), b"\n" * len(_BREAKS) + b" " + bytes(range(97, 123)))
# Odd 64-bit numbers: the bases of two polynomial hashes, and multipliers that mix.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = np.uint64(0x94D049BB133111EB)


def _slices(texts: list[bytes]) -> Iterator[bytes]:
    """Texts joined by line ends, in bounded parts cut at line ends: words with one blank between
    them, pieces with one line end."""
    held, size = [], 0
    for text in texts:
        text = text.translate(_PLAIN)
        at = 0
        while len(text) - at > _SLICE:
            cut = text.rfind(b"\n", at, at + _SLICE)
            cut = text.find(b"\n", at + _SLICE) if cut <= at else cut
            if cut < 0:
                break
            yield _tidy(text[at:cut])
            at = cut
        held.append(text[at:] if at else text)
        size += len(held[-1])
        if size > _SLICE:
            yield _tidy(b"\n".join(held))
            held, size = [], 0
    yield _tidy(b"\n".join(held))


def _tidy(plain: bytes) -> bytes:
    plain = re.sub(rb"  +", b" ", plain).replace(b" \n", b"\n").replace(b"\n ", b"\n")
    return re.sub(rb"\n\n+", b"\n", plain).strip(b" \n")


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2 ** 64)
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (self.base, self.inverse))
        return self.up[:n], self.down


_POWERS = tuple(map(_Powers, _BASES))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
    """64-bit hashes of the spans: differences of one running polynomial, moved to its origin."""
    up, down = _POWERS[lane].of(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=running[1:])
    found = (running[ends] - running[starts]) * down[starts]
    found = (found ^ (found >> np.uint64(31))) * _MIX
    return (found ^ (found >> np.uint64(29))) * _STEP


def _chunks(plain: bytes, trigger: int) -> tuple[list[bytes], np.ndarray]:
    """The chunks of one slice, and how many words each owns."""
    if not plain:
        return [], np.zeros(0, np.int64)
    data = np.frombuffer(plain, np.uint8)
    gaps = np.flatnonzero((data == 32) | (data == 10))
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
    first = np.append(True, data[gaps] == 10)
    n = len(starts)
    opens = np.flatnonzero(first | (_hashes(data, starts, ends, 0) % np.uint64(trigger) == 0))
    closes = np.append(opens[1:], n)
    piece_ends = np.append(np.flatnonzero(first)[1:], n)
    within = piece_ends[np.cumsum(first)[opens] - 1]
    reach = np.minimum(closes + LONGEST - 1, within)
    spans = zip(starts[opens].tolist(), ends[reach - 1].tolist(), strict=True)
    return [plain[a:b] for a, b in spans], closes - opens


def parse(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", trigger: int = TRIGGER) -> DataFrame:
    """The dictionary: lang, chunk, own (words it owns, from its first on), n (its frequency)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for lang, text in zip(batch["lang"].to_pylist(), texts, strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for plain in _slices(texts):
                    chunks, own = _chunks(plain, trigger)
                    yield pa.record_batch([
                        pa.array([lang], pa.string()).take(pa.array(np.zeros(len(chunks), np.int32))),
                        pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(own.astype(np.int32)),
                    ], names=["lang", "chunk", "own"])

    texts = pick(docs, lang=lang_col, text=text_col).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), text_of().alias("text"))
    return (
        texts.mapInArrow(run, "lang string, chunk string, own int")
        .groupBy("lang", "chunk", "own").agg(F.count(F.lit(1)).alias("n")))


class _Phrases:
    """The phrases of some dictionary rows by number of words: where they start, and their hashes."""

    def __init__(self, batch: pa.RecordBatch):
        chunks = batch["chunk"].cast(pa.binary())
        bounds = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset:chunks.offset + len(chunks) + 1]
        whole = np.frombuffer(chunks.buffers()[2] or b"", np.uint8)
        self.data = whole[bounds[0]:bounds[-1]]
        bounds = (bounds - bounds[0]).astype(np.int64)
        blanks = np.flatnonzero(self.data == 32)
        self.starts = np.sort(np.concatenate([bounds[:-1], blanks + 1]), kind="stable")
        self.ends = np.sort(np.concatenate([bounds[1:], blanks]), kind="stable")
        heads = np.searchsorted(self.starts, bounds[:-1])
        marks = np.zeros(len(self.starts), np.int64)
        marks[heads[1:]] = 1
        self.row = np.cumsum(marks)
        self.owned = np.arange(len(self.row)) - heads[self.row] < batch["own"].to_numpy()[self.row]
        langs = batch["lang"].dictionary_encode()
        names = [x.encode() for x in langs.dictionary.to_pylist()]
        ends = np.cumsum([len(x) for x in names])
        data = np.frombuffer(b"".join(names), np.uint8)
        self.words = [
            _hashes(self.data, self.starts, self.ends, lane)
            + _hashes(data, ends - [len(x) for x in names], ends, lane)[langs.indices.to_numpy()][self.row] * _MIX
            for lane in (0, 1)]

    def of(self, start: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(k, starts, key, check) of the phrases of k words from these words on, for k from 1 on."""
        keys = [w[start] for w in self.words]
        for k in range(1, longest + 1):
            if k > 1:
                fits = start + (k - 1) < len(self.row)
                fits[fits] = self.row[start[fits] + (k - 1)] == self.row[start[fits]]
                start = start[fits]
                last = start + (k - 1)
                keys = [(x[fits] ^ (x[fits] >> np.uint64(32))) * _STEP + w[last] * _MIX
                        for x, w in zip(keys, self.words, strict=True)]
            key, check = ((x ^ (x >> np.uint64(30))) * _MIX for x in keys)
            yield k, start, key, (check >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def text(self, start: int, k: int) -> str:
        return self.data[self.starts[start]:self.ends[start + k - 1]].tobytes().decode("utf-8", "surrogatepass")


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


def _met(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    slot = _slot(keys, bits)
    return (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def hash_counts(dictionary: DataFrame, lengths: tuple[int, ...], least: int, part: int = 0, known=None,
                bits: int = MAP_BITS) -> DataFrame:
    """key, check, a, id: phrases of these lengths that are met ``least`` times or more, by their
    hashes, with the id of a dictionary row that holds them.

    With ``known``, a broadcast bitmap of the frequent phrases of ``part`` words, only phrases all of
    whose parts of that length are among them are counted: no other phrase can be frequent.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            key, check, n, row = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(key, kind="stable")
            key, check = key[order], check[order]
            new = np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1]))[:len(key)]
            at = np.flatnonzero(new)
            sums = np.add.reduceat(n[order], at) if len(at) else n
            held.clear()
            return pa.record_batch(
                [pa.array(key[at].view(np.int64)), pa.array(check[at]), pa.array(sums), pa.array(row[order][at])],
                names=["key", "check", "a", "id"])

        for batch in batches:
            phrases = _Phrases(batch)
            n, ids = batch["n"].to_numpy(), batch["id"].to_numpy()
            # parts also begin at words that a chunk doesn't own: a phrase may end there
            fine = np.ones(len(phrases.row) + LONGEST, bool)
            if known is not None:
                fine[:] = False
                for k, start, key, _ in phrases.of(np.arange(len(phrases.row)), part):
                    if k == part:
                        fine[start[_met(known.value, key, bits)]] = True
            first = np.flatnonzero(phrases.owned & fine[:len(phrases.row)])
            for k, start, key, check in phrases.of(first, max(lengths)):
                if k not in lengths:
                    continue
                if known is not None:
                    whole = np.logical_and.reduce([fine[start + i] for i in range(k - part + 1)])
                    start, key, check = start[whole], key[whole], check[whole]
                row = phrases.row[start]
                held.append((key, check, n[row], ids[row]))
                size += len(key)
            if size > _PENDING:
                yield flush()
                size = 0
        if held:
            yield flush()

    counted = dictionary.mapInArrow(run, "key long, check int, a long, id long").groupBy("key", "check").agg(
        F.sum("a").alias("a"), F.min("id").alias("id"))
    return counted.filter(F.col("a") >= least)


def bitmap(keys: DataFrame, bits: int = MAP_BITS):
    """A broadcast bitmap of hashes: 2 ** bits bits, whatever their number."""
    slots = keys.select(F.shiftrightunsigned("key", 64 - bits).alias("slot"))
    longs = slots.groupBy(F.shiftright("slot", 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS int))")).alias("word")).toPandas()
    whole = np.zeros(2 ** bits // 64, np.int64)
    whole[longs["at"].to_numpy()] = longs["word"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(whole.view(np.uint8))


def frequencies(dictionary: DataFrame, least: int = LEAST, bits: int = MAP_BITS) -> DataFrame:
    """lang, phrase, k, a: exact counts of all phrases met ``least`` times or more.

    ``dictionary`` must be stored, with an ``id`` for each row.
    """
    words = write_once(hash_counts(dictionary, (1,), least), "phrase-hashes")
    pairs = write_once(hash_counts(dictionary, (2,), least, 1, bitmap(words, bits), bits), "phrase-hashes")
    longer = tuple(range(3, LONGEST + 1))
    long = write_once(hash_counts(dictionary, longer, least, 2, bitmap(pairs, bits), bits), "phrase-hashes")
    found = words.unionByName(pairs).unionByName(long)
    # few rows of the dictionary hold a phrase to be looked up: the others need not travel
    wanted = bitmap(found.select(F.xxhash64("id").alias("key")), bits)

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = _met(wanted.value, batch["slot"].to_numpy().view(np.uint64), bits)
            yield batch.drop_columns(["slot"]).filter(pa.array(met))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases, out = _Phrases(batch), []
            langs, sought = batch["lang"].to_pylist(), batch["sought"].to_pylist()
            left = {(row, x["key"], x["check"]): x["a"] for row, some in enumerate(sought) for x in some}
            keys = np.unique(np.fromiter((key for _, key, _ in left), np.int64, len(left))).view(np.uint64)
            for k, start, key, check in phrases.of(np.flatnonzero(phrases.owned)):
                some = np.flatnonzero(np.isin(key, keys))
                for at, row, x, y in zip(start[some].tolist(), phrases.row[start[some]].tolist(),
                                         key[some].view(np.int64).tolist(), check[some].tolist(), strict=True):
                    n = left.pop((row, x, y), None)
                    if n is not None:
                        out.append((langs[row], phrases.text(at, k), k, n))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            types = [pa.string(), pa.string(), pa.int32(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                  names=["lang", "phrase", "k", "a"])

    # a row is sought for no more phrases than it holds
    by_row = found.groupBy("id").agg(F.collect_list(F.struct("key", "check", "a")).alias("sought"))
    held = dictionary.select("id", "lang", "chunk", "own", F.xxhash64("id").alias("slot")).mapInArrow(
        holders, "id long, lang string, chunk string, own int")
    return held.join(by_row, "id").select("lang", "chunk", "own", "sought").mapInArrow(
        look_up, "lang string, phrase string, k int, a long")


def word_totals(dictionary: DataFrame) -> DataFrame:
    """lang, total: all word occurrences. A chunk counts the words it owns."""
    return dictionary.groupBy("lang").agg(F.sum(F.col("own").cast("long") * F.col("n")).alias("total"))


def _part(first, length):
    return F.array_join(F.slice("words", first, length), " ")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, k, a, l, r, score of all phrases of two words or more, by their weakest cut."""
    phrases = counts.filter("k > 1").withColumn("words", F.split("phrase", " "))
    cuts = phrases.select(
        "lang", "phrase", "k", "a", F.explode(F.transform(
            F.sequence(F.lit(1), F.col("k") - 1),
            lambda i: F.struct(i.alias("at"), _part(F.lit(1), i).alias("head"),
                               _part(i + 1, F.col("k") - i).alias("rest")))).alias("cut"))
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    both = (
        cuts.select("lang", "phrase", "k", "a", "cut.*")
        .join(parts.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    # DIV of decimals is exact; a score is at most SCALE, as no part is rarer than the whole
    score = F.expr(f"CAST((CAST(a AS decimal(20,0)) * {SCALE}) DIV (CAST(l AS decimal(20,0)) + r) AS long)")
    weakest = F.min(F.struct(score.alias("score"), "at", "l", "r")).alias("weakest")
    return both.groupBy("lang", "phrase", "k", "a").agg(weakest).select(
        "lang", "phrase", "k", "a", "weakest.l", "weakest.r", "weakest.score")


def uncovered(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases that no longer one holds in ``COVERED`` percent or more of their occurrences."""
    longer = counts.filter("k > 2").withColumn("words", F.split("phrase", " "))
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("k") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1), lambda at: _part(at, size))))
    covers = longer.select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("f")).groupBy(
        "lang", "phrase").agg(F.max("f").alias("f"))
    covered = F.col("f").isNotNull() & F.expr(
        f"100 * CAST(f AS decimal(20,0)) >= {COVERED} * CAST(a AS decimal(20,0))")
    return phrases.join(covers, ["lang", "phrase"], "left").filter(~covered).drop("f")


def best(phrases: DataFrame, top: int = TOP, shards: int = 64) -> DataFrame:
    """The first phrases of each language with their ranks. A language is ranked in shards first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = phrases.withColumn("shard", F.pmod(F.xxhash64("phrase"), F.lit(shards)))
    inside = Window.partitionBy("lang", "shard").orderBy(*order)
    first = dealt.withColumn("rank", F.row_number().over(inside)).filter(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    return first.drop("shard").withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= top)


def stored(dictionary: DataFrame) -> DataFrame:
    return write_once(dictionary.withColumn("id", F.monotonically_increasing_id()), "chunks")


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP,
         trigger: int = TRIGGER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first phrases."""
    dictionary = stored(parse(docs, lang_col, text_col, trigger))
    counts = write_once(frequencies(dictionary, least), "phrases")
    ranked = best(uncovered(scored(counts), counts), top)
    return ranked.join(word_totals(dictionary), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), "score")


def oracle() -> str:
    """The same by plain counting of every phrase of every text."""
    return rf"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    sized AS (SELECT lang, w, unnest([1, 2, 3, {LONGEST}]) AS k FROM worded),
    spans AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized),
    f AS (SELECT lang, w[i:i + k - 1] AS w, k, count(*) AS a FROM spans GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    often AS (SELECT * FROM f WHERE a >= {LEAST}),
    cuts AS (SELECT lang, w, k, a, unnest(range(1, k)) AS c FROM often WHERE k > 1),
    parted AS (
      SELECT x.lang, x.w, x.k, x.a, x.c, y.a AS l, z.a AS r,
             (CAST({SCALE} AS HUGEINT) * x.a) // (y.a + z.a) AS score
      FROM cuts x JOIN often y ON y.lang = x.lang AND y.w = x.w[1:x.c]
                  JOIN often z ON z.lang = x.lang AND z.w = x.w[x.c + 1:]),
    weakest AS (
      SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, c) AS nth FROM parted),
    held AS (SELECT lang, w, k, a, unnest(range(2, k)) AS size FROM often WHERE k > 2),
    inner_spans AS (
      SELECT lang, w, a, size, unnest(range(1, k - size + 2)) AS i FROM held),
    covers AS (SELECT lang, w[i:i + size - 1] AS w, max(a) AS f FROM inner_spans GROUP BY ALL),
    kept AS (
      SELECT x.lang, array_to_string(x.w, ' ') AS phrase, x.a, x.l, x.r, CAST(x.score AS BIGINT) AS score
      FROM weakest x LEFT JOIN covers c ON c.lang = x.lang AND c.w = x.w
      WHERE x.nth = 1 AND (c.f IS NULL OR 100 * c.f < {COVERED} * x.a)),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
    FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= {TOP}"""

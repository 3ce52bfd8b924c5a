"""Byte-level BPE encoding of whole documents in overlapping chunks, and decoding.

A document of more than ``chunk`` characters is cut into chunks that overlap by ``overlap`` on
either side and are dealt to the cluster. Every chunk is pre-tokenised alone. Matching looks only
ahead, so as soon as two neighbours have a boundary in common they agree from there on: the first
common position that is a boundary in any context is the seam. Pieces between seams are encoded in parallel and put together by document.
Where the overlap holds no common boundary (a run longer than it), the piece is joined with its
neighbour before encoding, so the ids are those of the whole text in every case. Shorter documents
are encoded where they are read and never travel.

Null texts count as empty; empty texts have no ids. Repeated rows come back repeated. Only the id
and text columns are read; the id may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from public_tokenizers import PATTERN

from snapledger.llm.bpe import encoder
from snapledger.llm.common import pick, text_of

CHUNK = 65_536  # encoded in some 25 ms; smaller texts are not worth a shuffle
OVERLAP = 512
_PIECES = "doc_id long, digest string, seq long, ids array<int>"


def boundaries(body: str, low: int, high: int, last: bool, pattern=None) -> list[int]:
    """Where pre-tokens start in ``body[low:high]``; not the last start, unless the text ends there."""
    starts = [m.start() for m in (pattern or regex.compile(PATTERN)).finditer(body)]
    if not last:
        starts = starts[:-2]  # the end of the chunk may have cut the last match short
    return [at for at in starts if low <= at <= high]


def _certain(body: str, at: int) -> bool:
    """A boundary whatever stands left of it: a run of letters or digits ends, or white space begins."""
    if at == 0:
        return False
    left, right = body[at - 1], body[at]
    return (left.isalpha() and not right.isalpha() or left.isdigit() and not right.isnumeric()
            or not left.isspace() and right.isspace())


def _pretokenise(frames: Iterator[pd.DataFrame], chunk: int, overlap: int) -> Iterator[pd.DataFrame]:
    pattern = regex.compile(PATTERN)
    for df in frames:
        heads, tails = [], []
        for seq, base, body, n in zip(df.seq, df.base, df.body, df.n_chars, strict=True):
            own = seq * chunk - base  # where the chunk proper starts in its body
            last = base + len(body) >= n
            head = boundaries(body, 0, own + overlap, last, pattern) if seq else []
            tail = [] if last else boundaries(body, own + chunk - overlap, len(body), last, pattern)
            heads.append([base + at for at in head if _certain(body, at)])
            tails.append([base + at for at in tail])
        yield pd.DataFrame({"doc_id": df.doc_id, "digest": df.digest, "seq": df.seq,
                            "head": heads, "tail": tails})


def _encode(frames: Iterator[pd.DataFrame], ranks_path: str) -> Iterator[pd.DataFrame]:
    encode = encoder(ranks_path).encode
    for df in frames:
        yield pd.DataFrame({"doc_id": df.doc_id, "digest": df.digest, "seq": df.seq,
                            "ids": [encode(text).astype("int32") for text in df.piece]})


def chunks(docs: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, digest, n_chars, seq, base, body) of the documents longer than one chunk."""
    start = F.greatest(F.col("seq") * chunk - overlap, F.lit(0))
    return (
        docs.filter(F.length("text") > chunk)
        .select("doc_id", F.sha2("text", 256).alias("digest"), F.length("text").alias("n_chars"),
                "text", F.explode(F.sequence(
                    F.lit(0), ((F.length("text") - 1) / chunk).cast("int"))).alias("seq"))
        .withColumn("base", start)
        .select("doc_id", "digest", "n_chars", F.col("seq").cast("long").alias("seq"),
                F.col("base").cast("long").alias("base"),
                F.col("text").substr(F.col("base") + 1,
                                     (F.col("seq") + 1) * chunk + overlap - F.col("base")).alias("body"))
        # rows of one text repeat only where the document does
        .repartition("doc_id", "digest", "seq")
    )


def seams(cut: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """For each chunk: where its piece starts and ends, and the chunk its run of pieces starts with."""
    found = (
        cut.mapInPandas(partial(_pretokenise, chunk=chunk, overlap=overlap),
                        "doc_id long, digest string, seq long, head array<long>, tail array<long>")
        .dropDuplicates(["doc_id", "digest", "seq"])
    )
    by_text = Window.partitionBy("doc_id", "digest").orderBy("seq")
    common = F.array_min(F.array_intersect(F.lag("tail").over(by_text), "head"))
    first = F.col("seq") == 0
    return (
        found.withColumn("seam", F.when(first, F.lit(0)).otherwise(common))
        .withColumn("start", F.coalesce("seam", F.col("seq") * chunk))
        .withColumn("run", F.max(F.when(F.col("seam").isNotNull(), F.col("seq"))).over(
            by_text.rowsBetween(Window.unboundedPreceding, 0)))
        .select("doc_id", "digest", "seq", "start", "run",
                F.lead("start").over(by_text).alias("stop"),
                (F.lead("run").over(by_text) == F.col("run")).alias("goes_on"))
    )


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[DataFrame, DataFrame]:
    """Texts to encode alone, (doc_id, digest, seq, piece): of the short documents, of the long ones.

    A short document is one piece. Pieces of a long one follow each other by ``seq``; ``digest``
    tells apart different texts of one id.
    """
    columns = ["doc_id", "digest", "seq", "piece"]
    texts = pick(docs, doc_id=id_col, text=text_col).withColumn("text", text_of())
    short = texts.filter(F.length("text") <= chunk).select(
        "doc_id", F.lit("").alias("digest"), F.lit(0).cast("long").alias("seq"),
        F.col("text").alias("piece"))
    cut = chunks(texts, chunk, overlap)
    at = seams(cut, chunk, overlap).withColumnsRenamed(
        {"doc_id": "_doc", "digest": "_digest", "seq": "_seq"})
    # null-safe throughout: a null filter on one side only would keep Spark from reusing the shuffle
    same = (F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("digest").eqNullSafe(F.col("_digest"))
            & F.col("seq").eqNullSafe(F.col("_seq")))
    length = F.coalesce("stop", F.col("n_chars")) - F.col("start")
    parts = cut.join(at, same).withColumn(
        "piece", F.col("body").substr(F.col("start") - F.col("base") + 1, length))
    alone = (F.col("run") == F.col("seq")) & ~F.coalesce("goes_on", F.lit(False))
    joined = (
        parts.filter(~alone).groupBy("doc_id", "digest", "run")
        .agg(F.sort_array(F.collect_set(F.struct("seq", "piece"))).alias("parts"),
             F.count(F.lit(1)).alias("n"))
        # a repeated document has its parts more than once
        .select("doc_id", "digest", F.col("run").alias("seq"),
                F.array_join("parts.piece", "").alias("piece"),
                F.explode(F.sequence(F.lit(1), (F.col("n") / F.size("parts")).cast("int"))))
    )
    return short, parts.filter(alone).select(*columns).union(joined.select(*columns))


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The ids of every document by piece: (doc_id, digest, seq, ids); see ``pieces``."""
    short, long = pieces(docs, id_col, text_col, chunk, overlap)
    return short.union(long).mapInPandas(partial(_encode, ranks_path=ranks_path), _PIECES)


def _digest(ids_parts, decode) -> tuple[int, str, str]:
    """Number of ids, and SHA-256 of their decimal text and of their bytes, fed part by part."""
    n, numbers, raw = 0, sha256(), sha256()
    for ids in ids_parts:
        if len(ids):
            numbers.update(((" " if n else "") + " ".join(map(str, ids.tolist()))).encode())
            raw.update(decode(ids))
            n += len(ids)
    return n, numbers.hexdigest(), raw.hexdigest()


_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest_short(frames: Iterator[pd.DataFrame], ranks_path: str) -> Iterator[pd.DataFrame]:
    both = encoder(ranks_path)
    for df in frames:
        rows = [_digest([both.encode(text)], both.decode) for text in df.piece]
        out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        out.insert(0, "doc_id", df.doc_id.to_numpy())
        yield out


def _digest_long(group: pd.DataFrame, ranks_path: str) -> pd.DataFrame:
    times = int((group.seq == group.seq.min()).sum())
    parts = group.drop_duplicates("seq").sort_values("seq").ids
    row = _digest(parts, encoder(ranks_path).decode)
    out = pd.DataFrame([row] * times, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    out.insert(0, "doc_id", group.doc_id.iloc[0])
    return out


def digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
            chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the decoded bytes.

    The ids of a long document meet in one task for the digest, as one row's text does.
    """
    short, long = pieces(docs, id_col, text_col, chunk, overlap)
    ids = long.mapInPandas(partial(_encode, ranks_path=ranks_path), _PIECES)

    def together(group: pd.DataFrame) -> pd.DataFrame:
        return _digest_long(group, ranks_path)

    return short.mapInPandas(partial(_digest_short, ranks_path=ranks_path), _DIGESTS).union(
        ids.groupBy("doc_id", "digest").applyInPandas(together, _DIGESTS))

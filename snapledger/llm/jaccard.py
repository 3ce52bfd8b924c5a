"""Similarity join of documents on their sets of five-word shingles, and its components.

Texts with the same set form one node. Two nodes link when their sets' Jaccard similarity reaches
``PERCENT``. Sets are ordered rare-first by the counts of hashed buckets, a table of fixed size;
any two similar sets share a shingle among the first ones (the prefix), so the join is on prefix
shingles. A shingle only pairs nodes whose set sizes (length filter) and positions in the two
orders (positional filter) still allow the similarity.

Nodes first meet, under each of their shared shingles, the node that shares most of its own with
others; of near copies that is the least edited one. Two such partners per node are verified. Only
nodes that then still are in different components and share a shingle are paired in full, so a group
of near copies costs a few pairs per node and never all of its pairs; no link between components is
lost. These links give the components. The number of links of each document comes after, from all
pairs within a component, compared block by block. Each pair is verified once: a bound from the sizes of value ranges comes first (suffix
filter), then the exact count. Shingles are 64-bit hashes of five words' hashes.

Words: A-Z lower-cased, between ASCII white spaces. A text of fewer words is one shingle; without
words it has none and links with nothing. Null texts count as empty. Rows of one id are one
document for linking; rows without id link with nothing and have no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from snapledger.llm.common import each_text, pick, text_of, word_hashes, words, write_once
from snapledger.llm.components import components

WORDS, PERCENT = 5, 75
BUCKETS = 1 << 16
MASK_BITS = 1 << 25  # of the filter for nodes in pairs: 4 MB
BLOCK_NODES, BLOCK_SHINGLES = 256, 1 << 21  # of a component, compared with another block at a time
_COLUMNS = 4096
_SEEN = 200_000
_PRIMES = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                  0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
_LOW48 = np.uint64((1 << 48) - 1)


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    tokens = words(text)
    if not tokens:
        return np.zeros(0, np.uint64)
    h = word_hashes(tokens, len(tokens))
    width = min(WORDS, len(tokens))
    mixed = np.full(len(tokens) - width + 1, np.uint64(width))
    for k in range(width):
        mixed = (mixed ^ h[k:len(h) - width + 1 + k]) * _PRIMES[k]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def node_of(found: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes()))))


def prefix_length(n: int) -> int:
    """So many first shingles of a set; two similar sets have one of them in common."""
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def similar(a: np.ndarray, b: np.ndarray, pieces: int = 16) -> bool:
    """Whether two sorted sets link: 100 * intersection >= PERCENT * union."""
    total = len(a) + len(b)
    need = -(-PERCENT * total // (100 + PERCENT))
    if min(len(a), len(b)) < need:
        return False
    if len(a) > 4 * pieces:
        # suffix filter: within each range of values the smaller part bounds the overlap
        cuts = a[len(a) // pieces::len(a) // pieces]
        in_a = np.diff(np.searchsorted(a, cuts), prepend=0, append=len(a))
        in_b = np.diff(np.searchsorted(b, cuts), prepend=0, append=len(b))
        if np.minimum(in_a, in_b).sum() < need:
            return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return bool(np.count_nonzero(a[at] == b) >= need)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences by hashed bucket over all documents; ``BUCKETS`` numbers, whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for some in each_text(batch["text"]):
                found = np.concatenate([shingles(text) for text in some])
                total += np.bincount((found & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def signed(texts: DataFrame, counts: np.ndarray) -> DataFrame:
    """(doc_id, n, node, prefix), the prefix rarest first and only with a node's first row with an id in a task."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, nodes, prefixes = [], [], []
            texts_here = (text for some in each_text(batch["text"]) for text in some)
            for without_id, text in zip(batch["doc_id"].is_null().to_pylist(), texts_here, strict=True):
                found = shingles(text)
                node = node_of(found)
                sizes.append(len(found))
                nodes.append(node if len(found) else None)
                if without_id or not len(found) or node in seen:
                    prefixes.append(None)
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(node)
                often = shared.value[(found & np.uint64(BUCKETS - 1)).astype(np.int64)]
                first = np.lexsort((found, often))[:prefix_length(len(found))]
                # 48 bits are enough to propose pairs
                prefixes.append((found[first] & _LOW48).astype(np.int64))
            yield pa.record_batch([
                batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(prefixes, pa.list_(pa.int64()))], names=["doc_id", "n", "node", "prefix"])

    return texts.mapInArrow(sign, "doc_id long, n long, node long, prefix array<long>")


def _possible(n: Column, at: Column, other_n: Column, other_at: Column) -> Column:
    """Length and positional filter, exact for a pair's first common shingle."""
    need = F.ceil(F.lit(PERCENT) * (n + other_n) / (100 + PERCENT) - 1e-9)
    return ((F.least(n, other_n) * 100 >= F.greatest(n, other_n) * PERCENT)
            & (1 + F.least(n - at - 1, other_n - other_at - 1) >= need))


def shared_shingles(rows: DataFrame) -> DataFrame:
    """(shingle, node, n, at, size): prefix shingles that occur more than once, and how often.

    Copies in different tasks count apart. That lets some shingles of a single node through, which
    pair with nothing, and keeps nodes out of the larger of the two shuffles.
    """
    postings = rows.filter(F.col("prefix").isNotNull()).select(
        "node", "n", F.posexplode("prefix").alias("at", "shingle"))
    several = postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return postings.join(several, "shingle").select("shingle", "node", "n", "at", "size")


def _few_pairs(met: DataFrame) -> DataFrame:
    """Of rows (node, other, o_weight), two partners per node at most: the one met most often and the heaviest."""
    counted = met.groupBy("node", "other", "o_weight").agg(F.count(F.lit(1)).alias("times"))
    best = counted.groupBy("node").agg(
        F.max(F.struct("times", "other")).alias("most"), F.max(F.struct("o_weight", "other")).alias("heavy"))
    return best.select("node", F.explode(F.array("most.other", "heavy.other")).alias("other")).select(
        *_ordered()).distinct()


def _ordered(a: str = "node", b: str = "other") -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def id_mask(ids: DataFrame) -> np.ndarray:
    """Bits of the ids that occur, modulo ``MASK_BITS``; fixed in size, so others may share their bit."""
    bits = ids.select(F.pmod("id", F.lit(MASK_BITS)).alias("bit")).select(
        F.shiftright("bit", 5).alias("word"), F.expr("shiftleft(1L, cast(bit % 32 as int))").alias("mask"))
    mask = np.zeros(MASK_BITS // 32, np.uint32)
    for r in bits.groupBy("word").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        mask[r["word"]] = r["mask"]
    return mask


def _read(packed: bytes) -> np.ndarray:
    return shingles(zstandard.decompress(packed).decode("utf-8", "surrogatepass"))


def homes_of(rows: DataFrame) -> DataFrame:
    """(node, home): a document that holds each node, of rows (doc_id, node)."""
    return rows.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("home"))


def _in_mask(ids: pa.Array, mask: np.ndarray) -> np.ndarray:
    """Which ids may be in a mask; a null is not."""
    bit = np.mod(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), MASK_BITS)
    hit = (mask[bit >> 5] >> (bit & 31).astype(np.uint32) & 1).astype(bool)
    return hit & ids.is_valid().to_numpy(zero_copy_only=False)


def packed_texts(ids: DataFrame, texts: DataFrame, homes: DataFrame) -> DataFrame:
    """(node, n, packed): a text of each node in ``ids`` (id) with its number of shingles.

    Filters of fixed size over the documents and the nodes that occur keep most other texts from
    being cut into shingles and out of the shuffle.
    """
    ids = write_once(ids.select("id").distinct(), "wanted")
    context = ids.sparkSession.sparkContext
    shared = context.broadcast(id_mask(ids))
    shared_homes = context.broadcast(id_mask(
        ids.join(homes.withColumnRenamed("node", "id"), "id").select(F.col("home").alias("id"))))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, wanted, seen = zstandard.ZstdCompressor(), shared.value, set()
        for batch in batches:
            out = []
            column = batch["text"].filter(pa.array(_in_mask(batch["doc_id"], shared_homes.value)))
            for text in (text for some in each_text(column) for text in some):
                found = shingles(text)
                node = node_of(found)
                bit = node % MASK_BITS
                if not len(found) or node in seen or not int(wanted[bit >> 5]) >> (bit & 31) & 1:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(node)
                out.append((node, len(found), packer.compress(text.encode("utf-8", "surrogatepass"))))
            columns = list(zip(*out, strict=True)) if out else [[]] * 3
            types = [pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                  names=["node", "n", "packed"])

    # a node's texts differ at most in white space and case, one of them will do
    own = texts.select("doc_id", "text").mapInArrow(needed, "node long, n long, packed binary")
    return own.groupBy("node").agg(F.first("n").alias("n"), F.min("packed").alias("packed"))


def verified(pairs: DataFrame, texts: DataFrame, homes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that link, from the texts themselves."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            linked = []
            for a, packed_a, packed_b in zip(*(batch[c] for c in ("a", "packed_a", "packed_b")), strict=True):
                if last is None or a != last:
                    last, left = a, _read(packed_a.as_py())
                linked.append(similar(left, _read(packed_b.as_py())))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    one = packed_texts(pairs.select(F.explode(F.array("a", "b")).alias("id")), texts, homes).drop("n")
    left = pairs.join(one.withColumnsRenamed({"node": "b", "packed": "packed_b"}), "b")
    both = left.join(one.withColumnsRenamed({"node": "a", "packed": "packed_a"}), "a")
    return both.select("a", "b", "packed_a", "packed_b").mapInArrow(verify, "a long, b long")


def link_matrix(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``left`` link with which of ``right``."""
    if len(left) * len(right) <= 64:
        return np.array([[similar(a, b) for b in right] for a in left], bool).reshape(len(left), len(right))
    sizes = np.array([len(x) for x in left + right], np.int64)
    _, column, often = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    renumbered = np.cumsum(often > 1) - 1  # a shingle of one set only is in no intersection
    row, column = row[often[column] > 1], renumbered[column[often[column] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, int(renumbered[-1]) + 1, _COLUMNS):
        at = slice(*np.searchsorted(column, [low, low + _COLUMNS]))
        has = np.zeros((len(sizes), _COLUMNS), np.float32)
        has[row[at], column[at] - low] = 1
        both += np.rint(has[:len(left)] @ has[len(left):].T).astype(np.int64)
    total = sizes[:len(left), None] + sizes[None, len(left):]
    return (100 + PERCENT) * both >= PERCENT * total


def counted_links(members: DataFrame) -> DataFrame:
    """(a, b, n) of all linked pairs of nodes in both directions, from (root, node, n, single, special, packed).

    Where one of the two is special the pair is a row, without ``n``. Besides, for each node and block
    a row without ``b``: the sum of the linked nodes' ``single``. A component is dealt to blocks of
    bounded size by a hash of the node; each pair of blocks is one unit of work.
    """
    blocks = members.groupBy("root").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("total")).select(
        "root", F.greatest(F.ceil(F.col("nodes") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_SHINGLES)).alias("blocks"))
    several = write_once(blocks.filter("blocks > 1"), "blocks")
    dealt = members.join(several, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    units = dealt.select(
        "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("second"), "node", "single", "special", "packed")

    def unit(rows: list[tuple]) -> Iterator[tuple]:
        i, j = rows[0][1:3]
        first = [r for r in rows if not r[3]]
        second = first if i == j else [r for r in rows if r[3]]
        if not first or not second:
            return
        left = [_read(r[7]) for r in first]
        linked = link_matrix(left, left if i == j else [_read(r[7]) for r in second])
        if i == j:
            np.fill_diagonal(linked, False)
        for mine, others, hit in [(first, second, linked)] + ([(second, first, linked.T)] if i != j else []):
            sums = hit @ np.array([r[5] for r in others], np.int64)
            special = np.array([r[6] for r in others], bool)
            for k, r in enumerate(mine):
                if sums[k]:
                    yield r[4], None, int(sums[k])
                for m in np.flatnonzero(hit[k] & (special | bool(r[6]))):
                    yield r[4], others[m][4], None

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(found):
            return pd.DataFrame({"a": pd.array([f[0] for f in found], "Int64"),
                                 "b": pd.array([f[1] for f in found], "Int64"),
                                 "n": pd.array([f[2] for f in found], "Int64")})

        waiting: list[tuple] = []
        for df in frames:
            found = []
            for r in df.itertuples(index=False, name=None):
                if waiting and waiting[0][:3] != r[:3]:
                    found += unit(waiting)
                    waiting = []
                waiting.append(r)
            yield frame(found)
        if waiting:
            yield frame(list(unit(waiting)))

    return units.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInPandas(
        count, "a long, b long, n long")


def link_counts(rows: DataFrame, roots: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, by_node) and (doc_id, by_id): how many other documents a document links with.

    ``rows`` are (doc_id, node) with both set. The latter table holds the ids with several nodes, which
    the sums over nodes would count once for each; the former goes for all other ids.
    """
    ids = rows.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("high"))
    ids = write_once(ids, "ids")
    single = ids.filter("node = high").groupBy("node").agg(F.count(F.lit(1)).alias("single"))
    several = write_once(rows.join(ids.filter("node < high").select("doc_id"), "doc_id").select(
        "doc_id", "node").distinct(), "several")
    special = several.select("node").distinct().withColumn("special", F.lit(True))
    sizes = write_once(single.join(special, "node", "full_outer").select(
        "node", F.coalesce("single", F.lit(0)).alias("single"), F.coalesce("special", F.lit(False)).alias("special")),
        "sizes")
    placed = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    packed = packed_texts(placed.select(F.col("node").alias("id")), texts, homes_of(rows))
    members = write_once(placed.join(packed, "node").join(sizes, "node"), "members")
    found = write_once(counted_links(members), "counted")
    near = found.filter("b is not null").select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        special.select("node", F.col("node").alias("other")))
    sums = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    holders = several.select(F.col("node").alias("other"), F.col("doc_id").alias("o_id"))
    shared = near.join(holders, "other").groupBy("node").agg(F.count_distinct("o_id").alias("shared"))
    by_node = sizes.filter("single > 0").join(sums, "node", "left").join(shared, "node", "left").select(
        "node", (F.col("single") - 1 + F.coalesce("links", F.lit(0)) + F.coalesce("shared", F.lit(0))).alias("by_node"))
    reach = several.join(near, "node").select("doc_id", "other").distinct()
    alone = reach.join(sizes.withColumnRenamed("node", "other"), "other").groupBy("doc_id").agg(
        F.sum("single").alias("alone"))
    others = reach.join(holders, "other").groupBy("doc_id").agg(F.count_distinct("o_id").alias("others"))
    by_id = alone.join(others, "doc_id").select("doc_id", (F.col("alone") + F.col("others") - 1).alias("by_id"))
    return by_node.filter("by_node > 0"), by_id


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, node) by row, and verified links (a, b) that connect the nodes as all links do."""
    texts = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = write_once(signed(texts, bucket_counts(texts)), "signed")
    with_id = rows.filter(F.col("doc_id").isNotNull())
    shared = write_once(shared_shingles(with_id), "shared")
    with_id_texts = texts.filter(F.col("doc_id").isNotNull())
    other_possible = _possible(F.col("n"), F.col("at"), F.col("o_n"), F.col("o_at"))
    # each node with the ones that share most shingles with others: of near copies, the least edited
    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    top = shared.join(weights, "node").groupBy("shingle").agg(
        F.max(F.struct("weight", "node", "n", "at")).alias("p"))
    met = shared.join(top, "shingle").select(
        "node", "n", "at", F.col("p.node").alias("other"), F.col("p.weight").alias("o_weight"),
        F.col("p.n").alias("o_n"), F.col("p.at").alias("o_at"))
    tried = write_once(_few_pairs(met.filter((F.col("node") != F.col("other")) & other_possible)), "pairs")
    homes = write_once(homes_of(with_id), "homes")
    linked = write_once(verified(tried, with_id_texts, homes), "links")
    # all that are still in different components under one shingle
    open_ = write_once(_open(shared.select("shingle", "node", "n", "at"), components(linked)), "open")
    others = open_.select("shingle", F.col("node").alias("other"), F.col("n").alias("o_n"),
                          F.col("at").alias("o_at"), F.col("root").alias("o_root"))
    rest = write_once(
        open_.join(others, "shingle")
        .filter((F.col("node") < F.col("other")) & (F.col("root") != F.col("o_root")) & other_possible)
        .select(*_ordered()).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        linked = linked.union(verified(rest, with_id_texts, homes))
    return rows.select("doc_id", "n", "node"), linked


def _open(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """(shingle, node, n, at, root) of the shingles whose nodes lie in several components."""
    placed = placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter(
        "low < high").select("shingle")
    return placed.join(split, "shingle").distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links), n_links of every row.

    ``n_links`` is the number of other ids with a text that links with one of the id's texts, 0 for
    rows without id; without ``count_links`` it is neither found nor returned.
    """
    rows, linked = links(docs, id_col, text_col)
    roots = components(linked)
    if count_links:
        roots = write_once(roots, "roots")
    placed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = write_once(placed.select("doc_id", "n", "node", "root"), "placed")
    with_id = placed.filter(F.col("doc_id").isNotNull())
    by_root = with_id.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("least"))
    # an id with several texts joins their components
    joined = with_id.join(by_root, "root", "left").select(
        "doc_id", F.coalesce("least", "doc_id").alias("least"))
    several = write_once(joined.groupBy("doc_id").agg(F.min("least").alias("a"), F.max("least").alias("b")).filter(
        "a < b"), "several")
    ties = several if several.isEmpty() else joined.join(several.select("doc_id", "a"), "doc_id").filter(
        "a < least").withColumn("b", F.col("least"))
    merged = components(ties.select("a", "b"))
    named = placed.join(by_root, "root", "left").withColumn("least", F.coalesce("least", "doc_id"))
    named = named.withColumnsRenamed({"node": "own_node", "root": "own_root"})
    out = named.join(merged, F.col("least") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(merged["root"], F.col("least"))).alias("component_id"), "own_node")
    if not count_links:
        return out.drop("own_node")
    texts = pick(docs, doc_id=id_col, text=text_col).filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    by_node, by_id = link_counts(with_id.filter(F.col("node").isNotNull()).select("doc_id", "node"), roots, texts)
    return out.join(by_node.withColumnRenamed("node", "own_node"), "own_node", "left").join(by_id, "doc_id", "left").select(
        "doc_id", "n_shingles", "component_id",
        F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("by_id", "by_node", F.lit(0))).alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of the smallest id of each component; of its rows only one.

    Rows without id stay. Only rows that may have to go travel: a filter of fixed size over the ids
    in question tells most others apart.
    """
    own = "_"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    found = write_once(groups(docs, id_col, text_col, count_links=False), "groups")
    going = found.filter("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("component_id").alias("least")).filter(
        (F.col("rows") > 1) | (F.col("least") != F.col("doc_id"))).select(
        F.col("doc_id").alias(f"{own}id"), F.col("least").alias(f"{own}least"))
    going = write_once(going, "going")
    shared = docs.sparkSession.sparkContext.broadcast(id_mask(going.select(F.col(f"{own}id").alias("id"))))

    # only ids go to Python
    in_question = F.arrow_udf(
        lambda ids: pa.array(_in_mask(ids, shared.value)), "boolean", ArrowUDFType.SCALAR)(F.col(f"`{id_col}`"))
    sure, asked = docs.filter(~in_question), docs.filter(in_question)
    rows = Window.partitionBy(f"`{id_col}`").orderBy(f"`{text_col}`", F.xxhash64(*(f"`{c}`" for c in docs.columns)))
    stay = (
        asked.join(going, F.col(f"`{id_col}`") == F.col(f"{own}id"), "left")
        .filter(F.col(f"{own}id").isNull() | (F.col(f"{own}id") == F.col(f"{own}least")))
        .withColumn(f"{own}row", F.row_number().over(rows)).filter(F.col(f"{own}row") == 1)
    )
    return sure.union(stay.select(*(f"`{c}`" for c in docs.columns)))

"""The prefix trie of conversations, as burst tries swept by many tasks.

A conversation is cut into bands of ``BAND`` turns. The turns before a band name a trie head, by the
exclusive or of 128-bit hashes of (position, role, text), which a running aggregate gives for all bands
at once; below each head lies a container with the bands that follow it, as suffixes of turn ids, equal
ones held once with their number. A container with more than one of ``SHARE`` suffixes is burst: its
first turns become trie nodes and heads of smaller containers, at most ``BAND`` times over. All other
containers are dealt to tasks, sorted, and swept into nodes with no more than the open path in memory.

Sums over subtrees need no walk from the leaves: every node is a member's path up to where a member
with a smaller id leaves it, so leaves and saved tokens are sums over the members of a node, which a
second sweep adds up like the number of members.

Defined results: rows without conv_id are left out; a null turn comes first; turns with equal numbers
are ordered by the MD5 digest of role and text; repeated rows are repeated turns; null roles and texts
count as empty. Texts of any length are read as digest and byte count. Other columns are never read.
Without conversations there is no root.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import pick, text_of, write_once

BAND = 8  # turns of a suffix
SHARE = 2048  # a container with more than one of so many suffixes bursts,
LEAST = 256  # unless it holds so few
SIBLINGS = 5  # conversations that share their first turns with the first of them
LEADS = 9  # a conversation takes over fewer turns than this

_BLOCK = 1024  # turn numbers, bands or ids that are handled together
_HEAD = ["d", "ha", "hb"]
_ROWS = 50_000
_NO_ENDS = sha256(b"").hexdigest()


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """conv, pos (from 1), id, bytes of every turn. A long conversation is numbered in blocks."""
    named = pick(conversations, conv=conv, turn=turn, role=role, text=text).filter("conv IS NOT NULL")
    parts = F.concat(F.length(text_of("role")).cast("string"), F.lit(":"), text_of("role"), text_of("text"))
    turns = write_once(named.select(
        F.col("conv").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(parts.cast("binary"))).alias("id"), F.octet_length(text_of("text")).alias("bytes"),
        F.coalesce(F.expr(f"CAST(turn AS long) DIV {_BLOCK}"), F.lit(-2 ** 62)).alias("block")), "turns")
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = turns.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("rows")).select(
        "conv", "block", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "id")
    placed = turns.withColumn("row", F.row_number().over(inside)).join(starts, ["conv", "block"])
    return placed.select("conv", (F.col("start") + F.col("row")).alias("pos"), "id", "bytes")


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (conv) of each, and their turns."""
    return turns.select("conv").distinct(), turns


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that take over the first turns of the first one of their siblings.

    Of ``conv`` the first ``h`` turns are those of conv - conv % SIBLINGS, as far as it has them, and
    the rest are its own from the (h + 1)-th on; h is the crc32 of the id modulo LEADS.
    """
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("length"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % LEADS
    wanted = lengths.select("conv", h.alias("h"), F.expr(f"conv - conv % {SIBLINGS}").alias("base"))
    firsts = lengths.select(F.col("conv").alias("base"), F.col("length").alias("there"))
    convs = write_once(wanted.join(firsts, "base", "left").select(
        "conv", "h", "base", F.least("h", F.coalesce("there", F.lit(0))).alias("lead")), "conversations")
    own = turns.join(convs, "conv").filter("pos > h").select(
        "conv", F.expr("pos - h + lead").alias("pos"), "id", "bytes")
    heads = turns.filter((F.col("pos") < LEADS) & (F.col("conv") % SIBLINGS == 0))
    taken = heads.withColumnRenamed("conv", "base").join(convs, "base").filter("pos <= h").select(
        "conv", "pos", "id", "bytes")
    return convs.select("conv"), own.unionByName(taken)


def bands(turns: DataFrame) -> DataFrame:
    """conv, d, ha, hb, above, seq: each band with the head and the bytes of the turns before it."""
    lanes = turns.select(
        "conv", "pos", F.expr(f"(pos - 1) DIV {BAND}").alias("band"), F.col("bytes").cast("long").alias("w"),
        F.xxhash64(F.lit(1), "pos", "id").alias("a"), F.xxhash64(F.lit(2), "pos", "id").alias("b"))
    cut = lanes.groupBy("conv", "band").agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "w"))).alias("seq"),
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("w").alias("w"),
    ).withColumn("part", F.expr(f"band DIV {_BLOCK}"))
    cut = write_once(cut, "bands")
    before = Window.partitionBy("conv", "part").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # only conversations of more than one part have anything to move on
    parts = cut.groupBy("conv", "part").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("w").alias("w"))
    moved = parts.select(
        "conv", "part", F.bit_xor("a").over(earlier).alias("pa"), F.bit_xor("b").over(earlier).alias("pb"),
        F.sum("w").over(earlier).alias("pw")).filter("part > 0")
    local = cut.select(
        "conv", "part", "band", "seq", F.bit_xor("a").over(before).alias("a"),
        F.bit_xor("b").over(before).alias("b"), F.sum("w").over(before).alias("w"))
    zero = F.lit(0).cast("long")

    def both(x: str, y: str) -> Column:
        return F.coalesce(F.col(x), zero).bitwiseXOR(F.coalesce(F.col(y), zero))

    return local.join(moved, ["conv", "part"], "left").select(
        "conv", (F.col("band") * BAND).alias("d"), both("a", "pa").alias("ha"), both("b", "pb").alias("hb"),
        (F.coalesce("w", zero) + F.coalesce("pw", zero)).alias("above"),
        F.transform("seq", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["w"].alias("w"))).alias("seq"))


def ends(convs: DataFrame, suffixes: DataFrame) -> DataFrame:
    """conv, d, ha, hb, total: the node where each conversation ends, and its bytes."""
    last = suffixes.groupBy("conv").agg(F.max(F.struct("d", "ha", "hb", "above", "seq")).alias("s")).select(
        "conv", (F.col("s.d") + F.size("s.seq")).alias("d"),
        *(F.aggregate(F.col("s.seq")[lane], F.col(f"s.h{lane}"), lambda x, y: x.bitwiseXOR(y)).alias(f"h{lane}")
          for lane in "ab"),
        F.aggregate(F.col("s.seq")["w"], F.col("s.above"), lambda x, y: x + y).alias("total"))
    zero = F.lit(0).cast("long")
    return convs.join(last, "conv", "left").select(
        "conv", *(F.coalesce(c, zero).alias(c) for c in [*_HEAD, "total"]))


_SUMS = ["n", "shared", "leaves"]  # what a node adds up over its members
_NODE = "d long, ha long, hb long, pa long, pb long, above long, children long, " \
        "n long, shared long, leaves long, conv long, own long"


def _combined(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of members, and the smallest one with what it shares."""
    return rows.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in _SUMS), F.min(F.struct("conv", "own")).alias("least")).select(
        *keys, *_SUMS, "least.conv", "least.own")


def _burst(suffixes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(containers left, nodes made) by bursting oversized containers until none is left."""
    limit = max(LEAST, suffixes.count() // SHARE)
    left, made = [], []
    while True:
        # at most SHARE rows: each container holds more than one of SHARE suffixes
        over = write_once(
            suffixes.groupBy(*_HEAD).agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > limit), "oversized")
        if over.isEmpty():
            return [*left, suffixes], made
        heads = F.broadcast(over.select(*_HEAD))
        left.append(suffixes.join(heads, _HEAD, "left_anti"))
        first = F.col("seq")[0]
        stepped = suffixes.join(heads, _HEAD, "left_semi").select(
            (F.col("d") + 1).alias("d"), F.col("ha").bitwiseXOR(first["a"]).alias("ha"),
            F.col("hb").bitwiseXOR(first["b"]).alias("hb"), F.col("ha").alias("pa"), F.col("hb").alias("pb"),
            F.col("above").alias("over"), (F.col("above") + first["w"]).alias("above"),
            F.slice("seq", 2, BAND).alias("seq"), *_SUMS, "conv", "own")
        nodes = write_once(_combined(
            stepped.drop("above").withColumnRenamed("over", "above"), [*_HEAD, "pa", "pb", "above"]), "nodes")
        made.append(nodes.withColumn("children", F.lit(0).cast("long")))
        made.append(nodes.groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("ha"), F.col("pb").alias("hb"))
                    .agg(F.count(F.lit(1)).alias("children")))
        suffixes = write_once(
            stepped.filter(F.size("seq") > 0).select(*_HEAD, "above", "seq", *_SUMS, "conv", "own"), "suffixes")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes from suffixes sorted by head and turns. ``path`` holds the open nodes, the head first."""
    out: list[tuple] = []
    names = [c.split()[0] for c in _NODE.split(", ")]
    path: list[list] = []  # [d, ha, hb, above, bytes, children, n, shared, leaves, conv, own]
    turns: list[tuple] = []

    def close(depth: int) -> None:
        """Emit the open nodes below ``depth`` turns of the suffix and add them to what holds them."""
        while len(path) - 1 > depth:
            node, above = path.pop(), path[-1]
            turns.pop()
            out.append((*node[:3], above[1], above[2], node[3], *node[5:]))
            above[5] += 1
            for i in (6, 7, 8):
                above[i] += node[i]
            if above[9] is None or node[9:] < above[9:]:
                above[9:] = node[9:]

    def leave() -> None:
        close(0)
        if path:
            out.append((*path[0][:3], None, None, None, path[0][5], 0, 0, 0, None, None))
            path.clear()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    for batch in batches:
        seqs = batch["seq"]
        flat = seqs.flatten()
        lanes = list(zip(*(flat.field(x).to_pylist() for x in range(3)), strict=True))
        sizes = seqs.value_lengths().to_pylist()
        rows = zip(*(batch[c].to_pylist() for c in [*_HEAD, "above", *_SUMS, "conv", "own"]), strict=True)
        at = 0
        for (d, ha, hb, above, n, shared, leaves, conv, own), size in zip(rows, sizes, strict=True):
            seq = lanes[at:at + size]
            at += size
            if not path or path[0][:3] != [d, ha, hb]:
                leave()
                path.append([d, ha, hb, above, 0, 0, 0, 0, 0, None, None])
            same = 0
            while same < len(turns) and same < size and turns[same] == seq[same]:
                same += 1
            close(same)
            for a, b, w in seq[same:]:
                top = path[-1]
                path.append([top[0] + 1, top[1] ^ a, top[2] ^ b, top[3] + top[4], w, 0, 0, 0, 0, None, None])
                turns.append((a, b, w))
            last = path[-1]
            for i, value in zip((6, 7, 8), (n, shared, leaves), strict=True):
                last[i] += value
            if last[9] is None or [conv, own] < last[9:]:
                last[9:] = [conv, own]
            if len(out) >= _ROWS:
                yield batch_of(out)
                out.clear()
    leave()
    yield batch_of(out)


def _nodes(members: DataFrame) -> DataFrame:
    """All nodes but the root: key, parent, bytes above them, children, and what members add up to.

    ``members`` holds a row for each band of each conversation, with its sums, conv and own. The root
    has a row with its children only.
    """
    suffixes = write_once(_combined(members, [*_HEAD, "above", "seq"]), "suffixes")
    left, made = _burst(suffixes)
    dealt = reduce(DataFrame.unionByName, left).repartition(*_HEAD).sortWithinPartitions(*_HEAD, "seq")
    found = dealt.mapInArrow(_sweep, _NODE)
    whole = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), made, found)
    # a head has a row as the deepest node of its band, and one with its children as a head
    return whole.groupBy(*_HEAD).agg(
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.max("above").alias("above"),
        F.sum("children").alias("children"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS),
        F.max("conv").alias("conv"), F.max("own").alias("own"))


def _with_root(nodes: DataFrame, root: DataFrame) -> DataFrame:
    """``root`` has the sums of all conversations; its children come from the nodes."""
    key = {c: F.lit(0).cast("long") for c in [*_HEAD, "above", "children"]}
    rows = nodes.unionByName(root.withColumns(key), allowMissingColumns=True)
    is_root = F.col("d") == 0
    top = rows.filter(is_root).groupBy(*_HEAD).agg(*(
        F.max(c).alias(c) for c in ["pa", "pb", "above", "children", *_SUMS, "conv", "own"]))
    return rows.filter(~is_root).unionByName(top.filter("n > 0"))


def end_digests(members: DataFrame) -> DataFrame:
    """d, ha, hb, ends_sha256: of the ids that end at a node, ascending and joined by commas.

    Ids are joined in blocks first, so that even a node where very many end is read as few rows; the
    digest is fed block after block.
    """
    blocks = members.groupBy(*_HEAD, F.expr(f"conv DIV {_BLOCK}").alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = [pa.int64()] * 3 + [pa.string()]
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*_HEAD, "ends_sha256"])

        for batch in batches:
            for *node, ids in zip(*(batch[c].to_pylist() for c in [*_HEAD, "ids"]), strict=True):
                if node == key:
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = node, sha256()
                state.update(ids.encode())
            if len(out) >= _ROWS:
                yield batch_of(out)
                out.clear()
        if key:
            out.append((*key, state.hexdigest()))
        yield batch_of(out)

    ordered = blocks.repartition(*_HEAD).sortWithinPartitions(*_HEAD, "block").select(*_HEAD, "ids")
    return ordered.mapInArrow(feed, "d long, ha long, hb long, ends_sha256 string")


def _parents(nodes: DataFrame) -> DataFrame:
    """Nodes with ``parent_conv_id``. Parents of very many, at most SHARE, are broadcast."""
    up = nodes.filter("children > 0").select(
        (F.col("d") + 1).alias("d"), F.col("ha").alias("pa"), F.col("hb").alias("pb"),
        F.col("conv").alias("parent_conv_id"), "children")
    keys = ["d", "pa", "pb"]
    many = F.col("children") > max(LEAST, nodes.count() // SHARE)
    crowded = F.broadcast(up.filter(many).drop("children"))
    under = nodes.join(crowded, keys, "left")
    others = under.filter("parent_conv_id IS NULL").drop("parent_conv_id")
    return under.filter("parent_conv_id IS NOT NULL").unionByName(
        others.join(up.filter(~many).drop("children"), keys, "left"))


def build(conversations: DataFrame, rebuild=plain, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. ``rebuild`` turns the numbered turns into (conversations, their turns)."""
    turns = write_once(numbered(conversations, conv, turn, role, text), "numbered")
    convs, sequences = rebuild(turns)
    suffixes = write_once(bands(sequences), "heads")
    finals = write_once(ends(convs, suffixes), "ends")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    # first sweep: the smallest member of each node; a member owns its path from its first such node on
    tops = finals.select(one.alias("n"), zero.alias("shared"), zero.alias("leaves"), "conv", zero.alias("own"))
    first = write_once(_with_root(
        _nodes(suffixes.select(*_HEAD, "above", "seq", one.alias("n"), zero.alias("shared"), zero.alias("leaves"),
                               "conv", zero.alias("own"))),
        tops.agg(*(F.sum(c).alias(c) for c in _SUMS), F.min("conv").alias("conv"), F.min("own").alias("own"))),
        "trie")
    owned = first.groupBy("conv").agg(
        F.min("above").alias("start"), F.max((F.col("children") == 0).cast("long")).alias("leaf"))
    # what a member shares: the bytes before its own part, or all of them
    shares = write_once(finals.join(owned, "conv", "left").select(
        "conv", F.coalesce("start", "total").alias("shared"), F.coalesce("leaf", zero).alias("leaves")), "shares")

    # second sweep: the same nodes, adding up leaves and shared bytes
    weighted = shares.select("conv", one.alias("n"), "shared", "leaves", F.col("shared").alias("own"))
    nodes = write_once(_with_root(
        _nodes(suffixes.join(weighted, "conv").select(*_HEAD, "above", "seq", *_SUMS, "conv", "own")),
        weighted.agg(*(F.sum(c).alias(c) for c in _SUMS), F.min(F.struct("conv", "own")).alias("least"))
        .select(*_SUMS, "least.conv", "least.own")), "trie")
    saved = F.col("shared") - F.col("own") - (F.col("n") - 1) * F.col("above")
    return _parents(nodes).join(end_digests(finals), _HEAD, "left").select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))


def oracle() -> str:
    """The same from every prefix as a list, and subtrees by comparing prefixes."""
    return f"""
    WITH t AS (
      SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
    codes AS (SELECT DISTINCT c, list_transform(
      range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: ascii(CAST(c AS VARCHAR)[i])) AS bytes FROM t),
    crcs AS (SELECT c, xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(bytes, lambda x: CAST(x AS BIGINT))),
      lambda x, y: list_reduce(list_prepend(xor(x, y), list_transform(range(8), lambda z: CAST(z AS BIGINT))),
                            lambda u, v: xor(u >> 1, (u & 1) * 3988292384)))) AS crc FROM codes),
    h AS (SELECT c, c - c % {SIBLINGS} AS base, crc % {LEADS} AS h FROM crcs),
    parts AS (
      SELECT h.c, 0 AS part, t.pos, t.role, t.text FROM h JOIN t ON t.c = h.base WHERE t.pos <= h.h
      UNION ALL
      SELECT h.c, 1, t.pos, t.role, t.text FROM h JOIN t ON t.c = h.c WHERE t.pos > h.h),
    lists AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY part, pos) AS s FROM parts GROUP BY c),
    whole AS (SELECT h.c, coalesce(s, []) AS s FROM h LEFT JOIN lists USING (c)),
    steps AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM whole),
    nodes AS (
      SELECT d, s[1:d] AS p, min(c) AS conv, count(*) AS n,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends
      FROM steps GROUP BY ALL),
    family AS (
      SELECT x.d, x.p, x.conv, x.n, x.ends, y.conv AS up,
             (SELECT count(*) FROM nodes z WHERE z.d = x.d + 1 AND z.p[1:x.d] = x.p) AS children
      FROM nodes x LEFT JOIN nodes y ON y.d = x.d - 1 AND y.p = x.p[1:x.d - 1])
    SELECT x.conv AS conv_id, x.d AS depth, x.up AS parent_conv_id, x.n AS n_convs, x.children AS n_children,
           count(*) FILTER (y.children = 0) AS n_leaves,
           CAST(sum((y.n - 1) * CASE WHEN y.d = 0 THEN 0 ELSE strlen(y.p[y.d].text) END) AS BIGINT) AS saved_tokens,
           x.ends AS ends_sha256
    FROM family x JOIN family y ON y.d >= x.d AND y.p[1:x.d] = x.p
    GROUP BY x.p, x.d, x.conv, x.up, x.n, x.children, x.ends"""

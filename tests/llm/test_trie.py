from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import md5, sha256
from zlib import crc32

import pytest

from snapledger.llm import trie
from tests.llm.test_sql_operators import both

SCHEMA = "conv_id long, turn long, role string, text string, d long, seq string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA)


def sequences(rows):
    def digest(role, text):
        return md5(f"{len(role)}:{role}{text}".encode()).digest()

    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole[c] = own.get(base, [])[:h] + turns[h:]
    return own, whole


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(list)
    children = Counter()
    for node in members:
        children[node[:-1]] += bool(node)
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    out = Counter()
    for node, ids in members.items():
        ended = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below[node] if x)
        out[min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children[node],
            sum(not children[x] for x in below[node]), saved, sha256(ended.encode()).hexdigest()] += 1
    return out


def odd_rows(seed=13):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-7, 160), 10 ** 12, 10 ** 12 + 3]:
        if rng.random() < 0.1:
            continue
        for turn in range(rng.randint(1, 30)):
            text = rng.choice(["yes", "no", "é" * rng.randint(1, 3), f"text {rng.randrange(5)}", "", None])
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", "bot", "bot", None]), text))
    rows += [(200, 1, "a", "same turn"), (200, 1, "b", "same turn"), (200, 1, "a", "same turn"), (None, 1, "a", "b"),
             (201, -5, "a", "x"), (201, 2 ** 40, "a", "z"), (201, 0, "a", "y"), (202, 0, "ab", ""), (203, 0, "a", "b")]
    rows += [(c, t, "user", f"common {t}") for c in range(300, 400) for t in range(16)]
    rows += [(c, t, "user", "hot first" if t < 3 else f"{c} {t}") for c in range(500, 540) for t in range(6)]
    return rows + [(c, t, "user", "x" * 5000) for c in (600, 601, 611) for t in range(40)]


@pytest.mark.parametrize("least, share", [(1000, 2048), (3, 2048), (0, 2048), (0, 5)])
def test_matches_brute_force(spark, monkeypatch, least, share):
    monkeypatch.setattr(trie, "LEAST", least)
    monkeypatch.setattr(trie, "SHARE", share)
    rows = odd_rows()
    _, whole = sequences(rows)
    got = trie.build(frame(spark, rows).repartition(5), trie.rebuilt)
    assert Counter(map(tuple, got.collect())) == brute(whole)


@pytest.mark.parametrize("block", [1, 3])
def test_small_blocks_and_plain_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(trie, "_BLOCK", block)
    rows = odd_rows(3)
    own, whole = sequences(rows)
    assert Counter(map(tuple, trie.build(frame(spark, rows)).collect())) == brute(own)
    assert Counter(map(tuple, trie.build(frame(spark, rows), trie.rebuilt).collect())) == brute(whole)


def test_matches_sql(spark, tmp_path):
    rows = [r for r in odd_rows(5) if r[0] is None or r[0] < 40 or 198 < r[0] < 306]
    both(spark, tmp_path, "conversations", frame(spark, rows), lambda df: trie.build(df, trie.rebuilt), trie.oracle())


def test_turnless_conversations_and_empty_table(spark):
    rows = [(c, 0, "user", "t") for c in (6, 7, 8)]  # no conversation 5: what h cuts off is not replaced
    _, whole = sequences(rows)
    assert any(not turns for turns in whole.values())
    got = trie.build(frame(spark, rows), trie.rebuilt)
    assert Counter(map(tuple, got.collect())) == brute(whole)
    assert trie.build(frame(spark, []), trie.rebuilt).count() == 0
    assert trie.build(frame(spark, [(None, 0, "user", "t")])).count() == 0

from __future__ import annotations

import random

import numpy as np

from snapledger.llm import jaccard
from snapledger.llm.components import components

SCHEMA = "doc_id long, text string, node string, n int, prefix string"


def brute(rows):
    """doc_id, n_shingles, component_id by comparing all pairs of rows."""
    sets = []
    for _, text in rows:
        w = [x.lower() for x in (text or "").encode().split()]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, x) in enumerate(zip(rows, sets, strict=True)):
        for j in range(i):
            if a[0] is None or rows[j][0] is None:
                continue
            both = len(x & sets[j])
            if rows[j][0] == a[0] or both and 100 * both >= 75 * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i)) if d is not None else None)
                   for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(df).collect()), key=str)


def edit(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = str(rng.randrange(10 ** 6))
    return words


def test_matches_brute_force(spark):
    rng = random.Random(21)
    rows, doc_id = [], 100
    for _ in range(12):
        base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(40)) for _ in range(rng.choice([6, 30, 120, 300]))]
        chain = base
        for _ in range(rng.randint(1, 14)):
            doc_id += rng.randint(1, 5)
            chain = edit(rng, chain if rng.random() < 0.5 else base, rng.randint(0, max(1, len(base) // 25)))
            rows.append((doc_id, (" " if rng.random() < 0.5 else "\n").join(chain).title()))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(i, passage + " " + " ".join(str(rng.randrange(999)) for _ in range(rng.randint(5, 40)))) for i in range(40)]
    rows += [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE  two"), (905, "one"),
             (906, "É é"), (907, "é é"), (None, passage), (None, None), (908, "word " * 9000)]
    rows += [(909, rows[0][1]), (909, rows[-20][1]), (910, rows[0][1]), (910, rows[0][1])]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_large_group_of_copies_and_empty_table(spark):
    rng = random.Random(3)
    base = [str(i) for i in range(200)]
    rows = [(i, " ".join(edit(rng, base, rng.randint(0, 3)))) for i in range(300)]
    rows += [(1000 + i, " ".join(base)) for i in range(300)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_pairs_are_judged_at_the_limit():
    a = np.arange(100, dtype=np.uint64)
    assert jaccard.similar(a[:75], a) and not jaccard.similar(a[:74], a)
    assert jaccard.similar(a[:1], a[:1])
    for n in range(1, 300):
        common = -(-75 * n // 100)
        assert jaccard.prefix_length(n) == n - common + 1


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500 + i, 500) for i in range(80)] + [(7, 7), (3, 2)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {500 + i: 500 for i in range(1, 80)}


def test_row_without_id_before_its_copy(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(None, " ".join(base)), (1, " ".join(base)), (2, " ".join([*base[:-1], "other"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(df).collect()), key=str)
    assert got == brute(rows) and {c for d, _, c in got if d} == {1}


def test_id_with_several_texts_joins_all_their_components(spark):
    texts = [" ".join(f"{c}{i}" for i in range(50)) for c in "abcd"]
    rows = [(i + 1, t) for i, t in enumerate(texts)] + [(10, t) for t in texts] + [(10, "short"), (11, "short")]
    got = run(spark, rows)
    assert got == brute(rows) and {c for *_, c in got} == {1}


def brute_links(rows):
    """n_links by id: the other ids with a text that links with one of its texts."""
    sets = []
    for doc_id, text in rows:
        w = (text or "").lower().split()
        sets.append((doc_id, {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())))
    near = {}
    for a, x in sets:
        for b, y in sets:
            both = len(x & y)
            if None not in (a, b) and a != b and both and 100 * both >= 75 * len(x | y):
                near.setdefault(a, set()).add(b)
    return sorted(((a, len(near.get(a, ()))) for a, _ in rows), key=str)


def test_numbers_of_links(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 20)
    monkeypatch.setattr(jaccard, "_COLUMNS", 64)
    base = [str(i) for i in range(100)]
    rows = [(i, " ".join(edit(rng, base, rng.randint(0, 4)))) for i in range(90)]
    rows += [(200 + i, f"pair {i // 2} of a few words {i // 2} here and there {i // 2}") for i in range(8)]
    rows += [(300, rows[3][1]), (301, rows[-1][1]), (301, rows[5][1]), (301, rows[6][1]), (302, rows[5][1]),
             (302, "alone here"), (303, "alone  HERE"), (303, rows[7][1]), (None, rows[3][1]), (304, ""), (305, None),
             (306, "single"), (307, rows[3][1]), (307, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(((r.doc_id, r.n_links) for r in jaccard.groups(df).collect()), key=str) == brute_links(rows)

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from snapledger.llm import phrases
from tests.llm.test_sql_operators import both

SCHEMA = "doc_id long, text string, lang string, phrase string, k int, shard int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(n, t, lang, "x", n, 0) for n, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, least, top=2000):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        if any(other == lang and len(longer) > len(words) and 100 * b >= 80 * a
               and any(longer[i:i + len(words)] == words for i in range(len(longer)))
               for (other, longer), b in candidates.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return Counter(
        (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, items in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(items)[:top], 1))


def odd_rows(seed=12):
    rng = random.Random(seed)
    vocabulary = ["The", "new", "york", "é", "Ärger", "of", "a\x00b", "x\x1cy", " ", "漢字", "long" * 50]
    weights = [9, 5, 5, 2, 2, 6, 1, 1, 1, 1, 1]
    rows = []
    for _ in range(120):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", "  ", "\t", " ", " ", ". ", "\n", "\x0b", ", "]) for w in words)
        rows.append((text, rng.choice(["en", "en", "en", None, "und", "de"])))
    rows += [rows[3]] * 20 + [(None, "en"), ("", None), (" . ,\n", "fr"), ("one", "fr")]
    return rows + [("to be or not to be " * 3000, "es"), ("a b, " * 40, "es")]


@pytest.mark.parametrize("trigger", [1, 3, 16, 10 ** 9])
def test_matches_brute_force(spark, trigger):
    rows = odd_rows()
    got = phrases.mine(frame(spark, rows).repartition(3), least=5, trigger=trigger)
    assert Counter(map(tuple, got.collect())) == brute(rows, 5)


def test_matches_sql(spark, tmp_path):
    df = frame(spark, odd_rows()).select("lang", "text", "phrase", "k", "shard")
    both(spark, tmp_path, "documents", df, phrases.mine, phrases.oracle())


def test_slices_of_a_long_text_and_full_maps(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_SLICE", 200)
    rows = odd_rows(5)
    dictionary = phrases.stored(phrases.parse(frame(spark, rows).coalesce(1)))
    full = {(r["lang"], r["phrase"]): r["a"] for r in phrases.frequencies(dictionary, 4, bits=6).collect()}
    wide = {(r["lang"], r["phrase"]): r["a"] for r in phrases.frequencies(dictionary, 4).collect()}
    assert full == wide and wide["es", "not to be"] == 3000


def test_distinct_chunks_are_held_once(spark):
    rows = [("one two three four five six seven eight nine ten. and again", "en")] * 500
    dictionary = phrases.parse(frame(spark, rows)).collect()
    assert {r["n"] for r in dictionary} == {500}
    assert sum(r["own"] for r in dictionary) == 12


def test_top_and_large_counts(spark):
    counts = [("en", "a", 1, 4 * 10 ** 18), ("en", "b", 1, 2 * 10 ** 18), ("en", "a b", 2, 10 ** 18)]
    df = phrases.scored(spark.createDataFrame(counts, "lang string, phrase string, k int, a long"))
    assert [r["score"] for r in df.collect()] == [2_000_000 * 10 ** 18 // (6 * 10 ** 18)]
    rows = odd_rows(7)
    got = phrases.mine(frame(spark, rows), least=5, top=7)
    assert Counter(map(tuple, got.collect())) == brute(rows, 5, 7)


def test_empty_table(spark):
    assert phrases.mine(frame(spark, [])).count() == 0

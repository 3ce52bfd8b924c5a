from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

from snapledger.llm import fingerprint as fp

SCHEMA = "doc_id long, text string, key string, bucket int, guest int"


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        a, b, c = map(fp.of_text, (text, changed, after))
        yield (doc_id, len(text), sha256(changed.encode()).hexdigest(), a.hex(), b.hex(),
               fp.likeness(a, b), fp.likeness(a, c))


def run(spark, rows, buckets):
    df = spark.createDataFrame([(i, t, "k", 1, 0) for i, t in rows], SCHEMA)
    return Counter(map(tuple, fp.fingerprints(df, buckets=buckets).collect()))


def test_matches_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["one", "two", "three.\n", "é漢", "\n", "five"]
    rows = [(i * i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 90))))
            for i in rng.sample(range(500), 120)]
    rows += [(7, "x y z"), (7, "a b"), (None, "null id"), (11, None), (13, ""), (2 ** 60, "far\naway")]
    for buckets in (1, 2, 40):
        assert run(spark, rows, buckets) == Counter(brute(rows))


def test_single_row_and_empty_table(spark):
    assert run(spark, [(5, "only one here")], 8) == Counter(brute([(5, "only one here")]))
    assert not run(spark, [], 8)


def test_sums_are_homomorphic():
    a, b, c = b"first line here", b"", b"third \xc3\xa9 line"
    whole = fp.of_paragraphs([a, b, c, a])
    assert whole.hex() == fp.of_paragraphs([a, c, a, b]).hex()
    assert (whole - fp.of_paragraphs([a])).hex() == fp.of_paragraphs([a, b, c]).hex()
    assert (whole - fp.of_paragraphs([c]) + fp.of_paragraphs([c])).hex() == whole.hex()
    assert fp.of_text("a b").hex() != fp.of_text("a  b").hex() != fp.of_text("a\nb").hex()


def test_likeness_follows_shared_text():
    rng = random.Random(4)
    texts = [" ".join(str(rng.randrange(10 ** 6)) for _ in range(1000)) for _ in range(2)]
    a, b = map(fp.of_text, texts)
    half = fp.of_text(fp.edited(*texts))
    assert fp.likeness(a, a) == 1 and fp.likeness(a, b) < 0.25
    assert 0.35 < fp.likeness(a, half) < 0.65


def test_very_many_equal_shingles_do_not_wrap(spark):
    for text in ("word " * 60_000, "the same line\n" * 60_000):
        a, b = fp.of_text(text), fp.of_text(fp.edited(text, "another short text"))
        assert abs(a.shared.astype(int)).max() > 2 ** 15 and fp.likeness(a, b) > 0.99
    rows = [(1, "word " * 60_000), (2, "another short text")]
    assert run(spark, rows, 2) == Counter(brute(rows))

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from snapledger.llm import bpe, pack

JSON, RANKS = public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.path(bpe.RANKS)
SCHEMA = "doc_id long, text string, length int, offset string"


def test_plan_places_every_length_once():
    rng = random.Random(3)
    for kinds, size in ((1, 16), (5, 16), (300, 1024), (1024, 1024)):
        histogram = {length: rng.randint(1, 5000) for length in rng.sample(range(1, size + 1), min(kinds, size))}
        patterns = pack.plan(histogram, size)
        placed = Counter()
        for count, lengths in patterns:
            assert count > 0 and sum(lengths) <= size
            placed.update({length: 0 for length in lengths})
            for length in lengths:
                placed[length] += count
        assert placed == histogram


def test_short_lengths_share_packs():
    assert pack.padding(pack.plan({100: 1000})) <= 24 * 100 + 1024
    assert pack.plan({}) == []


def test_pieces_and_places(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta,", "gamma\n", "é"]) for _ in range(rng.choice([0, 3, 40, 900, 3000])))
             for _ in range(60)] + [None, "", "<|endoftext|> x", "same text"] + ["same text"] * 30
    rows = [(i, t, 9, "x") for i, t in enumerate(texts)] + [(None, "no id", 1, "")] + [(3, texts[3], 0, "")]
    got = pack.pack(spark.createDataFrame(rows, SCHEMA), JSON, RANKS).collect()
    full = Tokenizer.from_file(JSON)
    expected = Counter()
    for i, text, _, _ in rows:
        ids = full.encode(text or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 1024):
            part = ids[start:start + 1024]
            expected[i, start, len(part), len(ids), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32, tuple(r.ids)) for r in got) == expected
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_hot_length_is_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(pack, "ROWS_PER_BUCKET", 7)
    got = pack.pack(spark.createDataFrame([(i, "one two", 0, "") for i in range(400)], SCHEMA), JSON, RANKS,
                    keep_ids=False).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 400
    assert len({r.sequence_id for r in got}) == 2


def test_empty_table(spark):
    assert pack.pack(spark.createDataFrame([], SCHEMA), JSON, RANKS).count() == 0

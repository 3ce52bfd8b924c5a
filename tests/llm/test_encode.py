from __future__ import annotations

import random
from hashlib import sha256

import public_tokenizers
import tiktoken

from snapledger.llm import bpe, encode

PATH = public_tokenizers.path(bpe.RANKS)
SCHEMA = "doc_id long, text string, digest string, seq int"


def expected(text):
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN,
                              mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    ids = plain.encode_ordinary(text or "")
    return (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            sha256((text or "").encode()).hexdigest())


def check(spark, texts, **sizes):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    got = encode.digests(spark.createDataFrame(rows, SCHEMA), PATH, **sizes).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == [
        (i, *expected(t)) for i, t in enumerate(texts)]


def test_chunks_give_the_ids_of_the_whole_text(spark):
    rng = random.Random(7)
    pools = ["ab \n", "a", " ", "é漢 's1!,", "ab'll 12  \t　", "x'sy ", "!?", "漢字，。"]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 400)))
             for _ in range(40)]
    texts += ["".join(rng.choice(pool) for _ in range(300)) for pool in pools]
    texts += ["a" * 100 + " b" * 100 + " " * 90 + "c'll" * 30, None, ""]
    check(spark, texts, chunk=40, overlap=8)


def test_production_chunks(spark):
    check(spark, ["word and more, " * 5000, "z" * 50_000, None, "", "Short <|endoftext|> text"])


def test_repeated_rows_and_ids_are_kept(spark):
    long, other = "one two " * 50, "three\n" * 70
    rows = [(1, long, "", 0)] * 3 + [(1, other, "", 0), (None, long, "", 0), (None, "", "", 0)]
    got = encode.digests(spark.createDataFrame(rows, SCHEMA), PATH, chunk=60, overlap=10).collect()
    assert sorted((r.doc_id or 0, r.ids_sha256) for r in got) == sorted(
        (i or 0, expected(t)[1]) for i, t, _, _ in rows)


def test_empty_table(spark):
    assert encode.digests(spark.createDataFrame([], SCHEMA), PATH).count() == 0

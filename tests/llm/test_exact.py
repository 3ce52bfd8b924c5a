from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from snapledger.llm import exact
from tests.llm.test_sql_operators import both

SCHEMA = "doc_id long, text string, digest string, row int, item string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", n, None) for n, (i, t) in enumerate(rows)], SCHEMA)


def brute(rows):
    by_text = defaultdict(list)
    for i, t in rows:
        by_text[t or ""].append(i)
    out = Counter()
    for t, ids in by_text.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for n, i in enumerate(ids):
            out[i, ids[-1], len(ids), n == len(ids) - 1, sha256(t.encode()).hexdigest()] += 1
    return out


def odd_rows():
    rng = random.Random(11)
    rows = [(i, rng.choice(["hot text", f"text {rng.randrange(400)}"])) for i in range(3000)]
    return rows + [(5000, None), (5001, ""), (None, ""), (5002, "é" * 200_000), (5003, "é" * 200_000), (5004, "é "),
                   (5005, "E "), (None, "only null"), (None, "only null"), (7, "hot text"), (7, "hot text")]


@pytest.mark.parametrize("share", [1, 3, 1024])
def test_matches_brute_force(spark, share):
    rows = odd_rows()
    got = exact.groups(frame(spark, rows).repartition(7), share=share)
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_matches_sql(spark, tmp_path):
    both(spark, tmp_path, "documents", frame(spark, odd_rows()), exact.groups, exact.oracle())


def test_frequent_digests_are_found_and_bounded(spark):
    rows = exact.write_once(exact._digests(frame(spark, odd_rows()).repartition(5), "doc_id", "text"), "rows")
    hot = exact.frequent(rows, 4).collect()
    assert len(hot) == 1 and hot[0]["group_size"] > 1000
    many = spark.range(40_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN id % 9 ELSE id END AS doc_id", "id AS row",
        "unhex(sha2(CAST(CASE WHEN id % 3 = 0 THEN id % 9 ELSE id END AS string), 256)) AS digest")
    assert sorted(r["group_size"] for r in exact.frequent(many).collect()) == [4444, 4445, 4445]


def test_hot_texts_do_not_reach_the_shuffle(spark):
    rows = [(i, "hot" if i % 2 else f"t{i}") for i in range(4000)]
    plan = exact.groups(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_drop_copies_keeps_columns_and_one_row(spark):
    rows = odd_rows()
    left = exact.drop_copies(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "digest", "row", "item"]
    texts = Counter((r["text"] or "") for r in left.collect())
    assert set(texts) == {t or "" for _, t in rows} and set(texts.values()) == {1}


def test_empty_table(spark):
    assert exact.groups(frame(spark, [])).count() == 0 and exact.drop_copies(frame(spark, [])).count() == 0

"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm import (
    bpe,
    encode,
    exact,
    fingerprint,
    jaccard,
    licences,
    lm,
    neighbours,
    pack,
    phrases,
    quality,
    toxicity,
    trie,
    url_tree,
)
from snapledger.llm.common import table


def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op2_url_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_tree.judge(table(spark, sf_dir, "pages"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(bpe.VOCABULARY),
                     public_tokenizers.path(bpe.RANKS), keep_ids=False)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op10_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(bpe.RANKS))


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.build(table(spark, sf_dir, "conversations"), trie.rebuilt)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm": op1_lm,
        "op2_url_tree": op2_url_tree,
        "op3_licences": op3_licences,
        "op4_jaccard": op4_jaccard,
        "op5_quality": op5_quality,
        "op6_fingerprint": op6_fingerprint,
        "op7_toxicity": op7_toxicity,
        "op8_pack": op8_pack,
        "op9_neighbours": op9_neighbours,
        "op10_encode": op10_encode,
        "op11_exact": op11_exact,
        "op12_phrases": op12_phrases,
        "op13_trie": op13_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_tree": url_tree.oracle(),
        "op3_licences": licences.oracle(),
        "op11_exact": exact.oracle(),
        "op12_phrases": phrases.oracle(),
        "op13_trie": trie.oracle(),
    } | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

"""Row and key hashes. Each formula is part of the stored data, so none may change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TEXT = "<NULL>"


def _text_or_null_mark(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NULL_TEXT))


def delimited_md5(columns: Sequence[str]) -> Column:
    """Hash used by the valid-date rebuild. Ambiguous when values hold the delimiter."""
    return F.md5(F.concat_ws("|", *[_text_or_null_mark(c) for c in columns]))


def length_prefixed_md5(columns: Sequence[str]) -> Column:
    """Hash used by the observation-time history: every value carries its byte length."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        value = F.concat(F.lit("V"), F.octet_length(text).cast("string"), F.lit(":"), text, F.lit(";"))
        parts.append(F.coalesce(value, F.lit("N;")))
    return F.md5(F.concat(*parts))


def state_key(state: str) -> Column:
    return F.md5(F.col(state))


def district_key(state: str, district: str) -> Column:
    return F.md5(F.concat(F.col(state), F.lit("|"), F.col(district)))


def version_key(keys: Sequence[str], valid_from: str) -> Column:
    parts = [F.col(k).cast("string") for k in (*keys, valid_from)]
    joined = [p for part in parts for p in (F.lit("|"), part)][1:]
    return F.md5(F.concat(*joined))

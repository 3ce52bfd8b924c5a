"""Licence recognition by known sentences and ordered rules over their sequence, in SQL functions only.

A text is cut into sentences (at lines without letters and digits, and behind ``.``, ``!``, ``?`` or
``;`` with white space; not at a ``;`` within the GPL's first sentence). Those with a word that
licences use are normalised: A-Z lower-cased, everything but letters, digits and ``.+-`` made one
blank. A single line break is a blank too, so hard-wrapped sentences stay whole; but lines that are
a reference or notice by themselves are sentences of their own, and a line that is known by itself
starts one. A table of sentence patterns gives each known sentence an identifier. Rules, the most
specific first, look for their identifier sequence and consume it, so a weaker rule only sees what
is left. No row meets another, so nothing is shuffled or exploded.

Null and empty texts have no sentences. Repeated rows come back repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import pick, text_of

# Every pattern below holds one of these words.
KEYWORDS = "|".join(
    "".join(f"[{letter.upper()}{letter}]" for letter in word) for word in (
        "licen", "copy", "warran", "permis", "redist", "neither", "public", "rights", "under", "provided"))
SENTENCE_END = "[.!?;]+[ \\t\\r]+|[.!?;]*[\\r\\n]+"  # of the SQL counterpart, which knows no wrapped sentences
# Line ends are a line feed here.
WRAPPED_END = ("(?!;[^A-Za-z0-9]+([Yy]ou[^A-Za-z0-9]+can[^A-Za-z0-9]+redistribute|[Ee]ither[^A-Za-z0-9]+version))"
               "[.!?;]+[ \\t\\n]+"
               "|\\n[^A-Za-z0-9\\n]*\\n")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Names that a one-sentence reference can hold (fixed values: public licence names), by identifier.
REFERENCES = {
    "ApacheRef2": "apache licen[sc]e,? ?v?(ersion)? ?2(.0)?|apache-2.0( licen[sc]e)?",
    "MITRef": "mit( licen[sc]e)?|expat licen[sc]e",
    "AGPLRef3": "(gnu )?affero general public licen[sc]e v?(ersion)? ?3(.0)?|agpl(v| |-)?3(.0)?(-only|-or-later)?",
    "LGPLRef21": "(gnu )?lesser general public licen[sc]e v?(ersion)? ?2.1|lgpl(v| |-)?2.1(-only|-or-later)?",
    "LGPLRef3": "(gnu )?lesser general public licen[sc]e v?(ersion)? ?3(.0)?|lgpl(v| |-)?3(.0)?(-only|-or-later)?",
    "GPLRef2": "gnu general public licen[sc]e v?(ersion)? ?2(.0)?|gpl(v| |-)?2(.0)?(-only|-or-later)?",
    "GPLRef3": "gnu general public licen[sc]e v?(ersion)? ?3(.0)?|gpl(v| |-)?3(.0)?(-only|-or-later)?",
    "GPLRef": "gnu general public licen[sc]e|gpl",
    "MPLRef2": "mozilla public licen[sc]e v?(ersion)? ?2(.0)?|mpl-2.0",
    "EPLRef2": "eclipse public licen[sc]e v?(ersion)? ?2(.0)?|epl-2.0",
    "BSD2Ref": "(the )?(bsd 2-clause|simplified bsd|2-clause bsd)( licen[sc]e)?|bsd-2-clause",
    "BSD3Ref": "(the )?(bsd 3-clause|new bsd|modified bsd|3-clause bsd)( licen[sc]e)?|bsd-3-clause",
    "ISCRef": "isc( licen[sc]e)?",
    "CC0Ref": "cc0( 1.0)?( universal)?|cc0-1.0",
    "CCBYNCSARef": "(cc|creative commons) by-nc-sa( [0-9.]+)?",
    "CCBYNCNDRef": "(cc|creative commons) by-nc-nd( [0-9.]+)?",
    "CCBYNCRef": "(cc|creative commons) by-nc( [0-9.]+)?",
    "CCBYSARef": "(cc|creative commons) by-sa( [0-9.]+)?",
    "CCBYRef": "(cc|creative commons) by( [0-9.]+)?",
}
_SUBJECT = ("((this|the) (work|file|text|document|software|program|code|project|material|content|page)"
            "( and .{1,40})? (is|are) |all (content|text|code) (is|are) )?")
_VERB = ("(dual-)?(licen[sc]ed|released|distributed|published|available|made available|provided) under "
         "(the )?(terms of (the )?)?")
_TAIL = "( licen[sc]e| international| or later| or at your option any later version| the licen[sc]e)*"

# Sentences of licence texts and headers (fixed values: public licence wording), by identifier.
SENTENCES = {
    "GPLHeader3": "this program is free software you can redistribute it .*gnu general public licen[sc]e.*version 3.*",
    "GPLHeader2": "this program is free software you can redistribute it .*gnu general public licen[sc]e.*version 2.*",
    "MITPermission": "permission is hereby granted free of charge to any person obtaining a copy.*",
    "MITNotice": "the above copyright notice and this permission notice shall be included in all copies.*",
    "ISCPermission": "permission to use copy modify and or distribute this software for any purpose.*",
    "BSDSource": ".*redistributions of source code must retain the above copyright notice.*",
    "BSDBinary": ".*redistributions in binary form must reproduce the above copyright notice.*",
    "BSDName": ".*neither the name of .*nor the names of.*",
    "NoWarranty": ".*(software|program|library) is (provided|distributed) .*(as is|without any warranty|without warranty).*",
    "ApacheCopy": "you may obtain a copy of the licen[sc]e at.*",
    "ApacheNotUse": "you may not use this file except in compliance with the licen[sc]e",
    "PublicDomain": "(this (work|file|text|software) is )?(released |placed )?(in|into|to) the public domain.*",
    "AllRights": "(.*copyright.* )?all rights reserved",
    "Copyright": "copyright .*[0-9]{4}.*",
} | {name: f"{_SUBJECT}{_VERB}({phrase}){_TAIL}|spdx-licen[sc]e-identifier ({phrase})"
     for name, phrase in REFERENCES.items()}

# Patterns of whole lines; references may span lines. All others hold for a line that starts a sentence.
_WHOLE = [*REFERENCES, "ApacheNotUse", "AllRights", "Copyright"]
_WHOLE_LINES = "(?m)^(" + "|".join(
    f"({SENTENCES[name]})".replace(" ", "[ \\n]" if name in REFERENCES else " ") for name in _WHOLE) + ")$"
_FIRST_LINES = "(?m)^(?=(" + "|".join(f"({SENTENCES[name]})" for name in SENTENCES if name not in _WHOLE) + ")$)"

# Rules in order: the licence, and the identifiers that follow each other.
RULES = [
    ("BSD-3-Clause", ("BSDSource", "BSDBinary", "BSDName")),
    ("BSD-2-Clause", ("BSDSource", "BSDBinary")),
    ("MIT", ("MITPermission", "MITNotice", "NoWarranty")),
    ("MIT", ("MITPermission", "MITNotice")),
    ("ISC", ("ISCPermission",)),
    ("Apache-2.0", ("ApacheRef2", "ApacheNotUse", "ApacheCopy")),
    ("Apache-2.0", ("ApacheRef2",)),
    ("MIT", ("MITRef",)),
    ("AGPL-3.0", ("AGPLRef3",)),
    ("LGPL-2.1", ("LGPLRef21",)),
    ("LGPL-3.0", ("LGPLRef3",)),
    ("GPL-3.0", ("GPLHeader3", "NoWarranty")),
    ("GPL-3.0", ("GPLHeader3",)),
    ("GPL-3.0", ("GPLRef3",)),
    ("GPL-2.0", ("GPLHeader2", "NoWarranty")),
    ("GPL-2.0", ("GPLHeader2",)),
    ("GPL-2.0", ("GPLRef2",)),
    ("GPL", ("GPLRef",)),
    ("MPL-2.0", ("MPLRef2",)),
    ("EPL-2.0", ("EPLRef2",)),
    ("BSD-3-Clause", ("BSD3Ref",)),
    ("BSD-2-Clause", ("BSD2Ref",)),
    ("ISC", ("ISCRef",)),
    ("CC0-1.0", ("CC0Ref",)),
    ("CC-BY-NC-SA", ("CCBYNCSARef",)),
    ("CC-BY-NC-ND", ("CCBYNCNDRef",)),
    ("CC-BY-NC", ("CCBYNCRef",)),
    ("CC-BY-SA", ("CCBYSARef",)),
    ("CC-BY", ("CCBYRef",)),
    ("Public-Domain", ("PublicDomain",)),
    ("Proprietary", ("AllRights",)),
]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licences (in the order of the rules), sentence_ids, n_sentences, n_unknown by row.

    ``n_unknown`` counts sentences that speak of a licence without being known.
    """
    text = F.regexp_replace(text_of(), "\\r\\n?", "\n")
    sentences = F.when(text.rlike(KEYWORDS), F.split(text, WRAPPED_END)).otherwise(F.array().cast("array<string>"))

    def clean(sentence):
        """Its sentences: apart from itself, the lines that are known alone."""
        lower = F.regexp_replace(F.translate(sentence, _UPPER, _LOWER), "[^a-z0-9.+\\n-]+", " ")
        lines = F.regexp_replace(lower, "(?m)^[ .]+|[ .]+$", "")
        apart = F.regexp_replace(F.regexp_replace(lines, _WHOLE_LINES, "|$1|"), _FIRST_LINES, "|")
        cut = F.when(F.contains(lines, F.lit("\n")), F.split(apart, "[|]")).otherwise(F.array(lines))
        return F.transform(cut, lambda s: F.trim(F.translate(s, "\n", " ")))

    def known(sentence):
        out = F.when(F.lit(False), "")
        for name, pattern in SENTENCES.items():
            out = out.when(sentence.rlike(f"^({pattern})$"), name)
        return out.when(sentence.rlike("(^| )licen[sc]ed?( |$)"), "?")

    found = (
        pick(docs, doc_id=id_col, text=text_col)
        .select("doc_id", F.flatten(F.transform(F.filter(sentences, lambda s: s.rlike(KEYWORDS)), clean)).alias("s"))
        .select("doc_id", F.filter("s", lambda s: s.rlike(KEYWORDS)).alias("s"))
        .select("doc_id", F.filter(F.transform("s", known), lambda x: x.isNotNull()).alias("ids"))
    )
    rules = F.array(*(F.struct(F.lit(licence).alias("licence"), F.lit("," + ",,".join(ids) + ",").alias("wanted"))
                      for licence, ids in RULES))
    start = F.struct(F.concat(F.lit(","), F.array_join("ids", ",,"), F.lit(",")).alias("rest"),
                     F.array().cast("array<string>").alias("hits"))

    def apply(state, rule):
        new = F.contains(state["rest"], rule["wanted"]) & ~F.array_contains(state["hits"], rule["licence"])
        return F.struct(
            F.replace(state["rest"], rule["wanted"], F.lit("|")).alias("rest"),
            F.when(new, F.array_append(state["hits"], rule["licence"])).otherwise(state["hits"]).alias("hits"))

    known_ids = F.filter("ids", lambda x: x != "?")
    matched = F.aggregate(rules, start, apply, lambda state: state["hits"])
    return found.select(
        "doc_id", F.when(F.size("ids") > 0, F.array_join(matched, ",")).otherwise("").alias("licences"),
        F.array_join(known_ids, ",").alias("sentence_ids"), F.size(known_ids).cast("long").alias("n_sentences"),
        (F.size("ids") - F.size(known_ids)).cast("long").alias("n_unknown"))


def oracle(table: str = "documents") -> str:
    """The scan as DuckDB SQL, but with a sentence's end at every line break: wrapped texts differ."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    cases = " ".join(f"WHEN regexp_matches(s, {quoted(f'^({pattern})$')}) THEN {quoted(name)}"
                     for name, pattern in SENTENCES.items())
    steps = "".join(
        f""", r{k + 1} AS (SELECT doc_id, ids, replace(rest, {quoted(wanted)}, '|') AS rest,
    CASE WHEN contains(rest, {quoted(wanted)}) AND NOT list_contains(hits, {quoted(licence)})
    THEN list_append(hits, {quoted(licence)}) ELSE hits END AS hits FROM r{k})"""
        for k, (licence, wanted) in enumerate(
            (licence, "," + ",,".join(ids) + ",") for licence, ids in RULES))
    end = SENTENCE_END.replace("\\t", "\t")
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM {table}),
c AS (SELECT doc_id, CASE WHEN regexp_matches(text, {quoted(KEYWORDS)})
    THEN list_filter(string_split_regex(text, {quoted(end)}), lambda x: regexp_matches(x, {quoted(KEYWORDS)}))
    ELSE [] END AS raw FROM t),
n AS (SELECT doc_id, list_transform(raw, lambda x: regexp_replace(regexp_replace(
    translate(x, '{_UPPER}', '{_LOWER}'), '[^a-z0-9.+-]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g')) AS s FROM c),
k AS (SELECT doc_id, list_filter(list_transform(s, lambda s: CASE {cases}
    WHEN regexp_matches(s, '(^| )licen[sc]ed?( |$)') THEN '?' END), lambda x: x IS NOT NULL) AS ids FROM n),
r0 AS (SELECT doc_id, ids, ',' || coalesce(array_to_string(ids, ',,'), '') || ',' AS rest, CAST([] AS VARCHAR[]) AS hits FROM k)
{steps}
SELECT doc_id, coalesce(array_to_string(hits, ','), '') AS licences,
    coalesce(array_to_string(list_filter(ids, lambda x: x <> '?'), ','), '') AS sentence_ids,
    CAST(len(list_filter(ids, lambda x: x <> '?')) AS BIGINT) AS n_sentences,
    CAST(len(list_filter(ids, lambda x: x = '?')) AS BIGINT) AS n_unknown FROM r{len(RULES)}"""

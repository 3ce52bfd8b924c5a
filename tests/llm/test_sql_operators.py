"""The operators in SQL functions, next to their DuckDB counterparts on odd rows."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest

from snapledger.llm import licences, url_tree

APACHE = """Copyright 2020 The Authors. Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://example.org/LICENSE-2.0"""
BSD = """Redistributions of source code must retain the above copyright notice, this list;
Redistributions in binary form must reproduce the above copyright notice, this list;
Neither the name of the holder nor the names of its contributors may be used."""


def both(spark, tmp_path, name, df, run, sql):
    path = str(tmp_path / f"{name}.parquet")
    df.write.parquet(path)
    ours = run(spark.read.parquet(path))
    columns = sorted(ours.columns)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    cursor = db.execute(sql)
    at = [[d[0] for d in cursor.description].index(c) for c in columns]
    theirs = Counter(tuple(r[i] for i in at) for r in cursor.fetchall())
    assert Counter(map(tuple, ours.select(*columns).collect())) == theirs
    return {r[columns.index(df.columns[0])]: dict(zip(columns, r, strict=True)) for r in theirs}


def test_licences(spark, tmp_path):
    texts = [
        "Some prose.\nReleased under the MIT License.\nMore prose.", "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0.\r\nLicensed under the Apache License, Version 2.0.",
        APACHE, BSD, "x " + BSD.rsplit("\n", 1)[0] + "\n", "Licensed under the Fancy License. All rights reserved!",
        "SPDX-License-Identifier: GPL-2.0-or-later", None, "", " \n\n", "no words of interest; at all\n" * 3000,
        "RELEASED UNDER THE MIT LICENSE.", "a licence to think", "Lizenz é ſ \u212a", "MIT License"]
    rows = [(i, t, "c", 1) for i, t in enumerate(texts)] + [(1, texts[1], "c", 2), (None, texts[0], "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, s int")
    got = both(spark, tmp_path, "documents", df, licences.scan, licences.oracle())
    assert [got[i]["licences"] for i in range(9)] == [
        "MIT", "CC-BY-NC", "GPL-3.0", "Apache-2.0", "Apache-2.0", "BSD-3-Clause", "BSD-2-Clause",
        "Proprietary", "GPL-2.0"]
    assert got[7]["n_unknown"] == 1 and got[9]["licences"] == got[12]["licences"] == ""


URLS = ["https://A.Example.ORG/en/12?x", "http://example.org/es/1", "http://sub.example.org/es/1#f",
        "http://notexample.org/es/1", "http://x.com/fr/9.html", "http://x.com/de/9/", "http://com/de/", "ftp://x.net",
        "http://x.net/", "http://x.net//a//b", "x.net/en/1", "", None, "://", "a://b://c/d/e/f/g/h/i/j.html",
        "http://É.net/É/1", "http://h.net/a\nb/c.txt\n"]


def test_urls(spark, tmp_path):
    rng = random.Random(4)
    urls = URLS + [f"http://{rng.choice('abc')}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'fr'])}"
                   f"/{rng.choice(['post', 'tag', str(rng.randrange(10 ** 6))])}/{rng.randrange(500)}"
                   f"{rng.choice(['', '.html', '/'])}" for _ in range(2000)]
    urls += ["http://hot.com/de/1"] * 700
    rows = [(i, u, "t", 1) for i, u in enumerate(urls)] + [(None, urls[0], "", 0), (3, urls[3], "", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, template string, seg int")
    got = both(spark, tmp_path, "pages", df, url_tree.judge, url_tree.oracle())
    assert len(got) == len(urls) + 1
    assert (got[0]["host"], got[0]["path"], got[0]["rule"]) == ("a.example.org", "/en/12", "example.org/en/1")
    assert [got[i]["verdict"] for i in (0, 1, 2, 3, 4, 5, 6)] == [
        "block", "block", "block", "allow", "allow", "block", "block"]
    assert got[7]["path"] == got[10]["host"] == got[12]["path"] == "" and got[7]["rule"] is None


def _verdicts(spark, tmp_path, urls, rules):
    rows = [(i, u, "t", 1) for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, template string, seg int")
    return both(spark, tmp_path, "pages", df, lambda d: url_tree.judge(d, rules=rules), url_tree.oracle(rules))


def test_unlabelled_branches_are_not_merged_into_labelled_ones(spark, tmp_path):
    urls = [f"http://a.com/de/{i}" for i in range(40)] + [f"http://a.com/en/{i}" for i in range(400)]
    got = _verdicts(spark, tmp_path, urls, url_tree.RULES)
    assert all(got[i]["verdict"] == ("block" if i < 40 else "allow") for i in range(440))
    assert got[50]["template"] == "/en/*" and got[0]["template"] == "/de/*"


def test_many_even_sections_keep_their_labels(spark, tmp_path):
    """Sixty sections of one size, labelled in turn: no share of the host is too small to be told apart."""
    rules = [("h.net", f"/s{k}/x", ("allow", "block")[k % 2]) for k in range(60)]
    urls = [f"http://h.net/s{k}/{'x' * (i < 6)}{i}{k}" for k in range(60) for i in range(25)]
    got = _verdicts(spark, tmp_path, urls, rules)
    assert all(r["verdict"] == ("allow", "block")[int(r["path"].split("/")[1][1:]) % 2] for r in got.values())


def test_branches_deep_in_a_path_are_told_apart(spark, tmp_path):
    deep = "/".join("abcdefg")
    rules = [("h.net", f"/{deep}/{x}/1", v) for x, v in (("good", "allow"), ("bad", "block"))]
    urls = [f"http://h.net/{deep}/{x}/{i}" for x in ("good", "bad") for i in range(100, 160)]
    urls += [f"http://h.net/{deep}/{x}/{i}" for x in ("good", "bad") for i in range(200, 230)]
    urls += ["http://rare.net/" + "/".join("zyxwvutsrqp")]
    got = _verdicts(spark, tmp_path, urls, rules)
    assert [got[i]["verdict"] for i in (120, 149, 150, 179, 180)] == ["allow"] * 2 + ["block"] * 2 + ["allow"]
    assert got[180]["template"] == "/*" * 11


@pytest.mark.parametrize("run, name, schema", [
    (licences.scan, "documents", "doc_id long, text string"), (url_tree.judge, "pages", "page_id long, url string")])
def test_empty_tables(spark, run, name, schema):
    assert run(spark.createDataFrame([], schema)).count() == 0

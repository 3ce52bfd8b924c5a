"""Hard-wrapped licence texts, as they usually stand in files and comments."""

from __future__ import annotations

import pytest

from snapledger.llm import licences

MIT = """Copyright (c) 2020 The Authors

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
BSD3 = """    * Redistributions of source code must retain the above copyright
      notice, this list of conditions and the following disclaimer.
    * Redistributions in binary form must reproduce the above copyright
      notice, this list of conditions and the following disclaimer in the
      documentation and/or other materials provided with the distribution.
    * Neither the name of the <organization> nor the
      names of its contributors may be used to endorse or promote products
      derived from this software without specific prior written permission."""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
GPL3 = GPL.format(":", 3).replace("Foundation;", "Foundation,")


def comment(text):
    return "\r\n".join(f" * {line}".rstrip() for line in text.split("\n"))


@pytest.mark.parametrize("form", [str, comment])
def test_wrapped_texts(spark, form):
    cases = [
        (MIT, "MIT", "Copyright,MITPermission,MITNotice,NoWarranty"),
        (ISC, "ISC", "ISCPermission"), (BSD3, "BSD-3-Clause", "BSDSource,BSDBinary,BSDName"),
        (GPL3, "GPL-3.0", "GPLHeader3,NoWarranty"),
        (GPL.format(";", 2), "GPL-2.0", "GPLHeader2,NoWarranty"),
        ("Licensed under the GNU General Public License\nversion 3\nimport x", "GPL-3.0", "GPLRef3"),
        ("Some prose\nReleased under the MIT License\nMore prose", "MIT", "MITRef"),
        ("Copyright 2020 A\nAll rights reserved\nb", "Proprietary", "Copyright,AllRights"),
        ("This is free software; licensed under the MIT license", "MIT", "MITRef"),
        ("It has\na licence of its\nown", "", ""),
    ]
    df = spark.createDataFrame([(i, form(c[0])) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(df).collect()}
    assert [(got[i].licences, got[i].sentence_ids) for i in range(len(cases))] == [c[1:] for c in cases]
    assert got[len(cases) - 1].n_unknown == 1

import re

from tabprism.llm import license_rules as L
from tabprism.llm import queries
from tests.llm.helpers import SF, duck_rows, spark_rows


def brute(text):
    out, n = [], 0
    for s in re.split("\n", re.sub(r"[.!?;:][ \t\r]+", "\n", (text or "").lower())):
        s = re.sub(r"[^\w.]+|_", " ", s).strip(" .")
        s = re.sub(" +", " ", s)
        n += bool(s)
        if s in L.SENTENCES:
            out.append(L.SENTENCES[s])
    ids = list(out)
    for name, seq in L.RULES:  # earlier rules take theirs first
        i = 0
        while i + len(seq) <= len(ids):
            if ids[i:i + len(seq)] == seq:
                ids[i:i + len(seq)] = [("license", name)]
            i += 1
    return (n, len(out), "".join(f"<{i}>" for i in out), ",".join(i[1] for i in ids if isinstance(i, tuple)),
            "".join(f"<{i}>" for i in ids if isinstance(i, str)))


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. The software is provided "as is", without warranty of any kind, express or implied."""


def test_against_brute_force(spark):
    texts = [None, "", "no licence here. All rights are ours.", "Text\nReleased under the MIT License.\nmore", MIT, MIT.split("\n")[0],
             "# Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at: x",
             "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.", "all rights reserved", "ALL  RIGHTS\tRESERVED!!!",
             "All rights reserved. All rights reserved.\n" * 2000, MIT + "\nReleased under the MIT License.\n" + MIT, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
             "prefix Released under the MIT License", "Released under the MIT License, amended"]
    df = spark.createDataFrame([(i % 13, t, "x") for i, t in enumerate(texts)] + [(None, MIT, "x")], "doc_id long, text string, licenses string")
    got = sorted((str(r.doc_id), r.n_sentences, r.n_known, r.sentence_ids, r.licenses, r.left_over) for r in L.scan_licenses(df).collect())
    assert got == sorted([(str(i % 13), *brute(t)) for i, t in enumerate(texts)] + [("None", *brute(MIT))])
    assert L.scan_licenses(df.limit(0)).count() == 0


def test_rules_are_ordered_and_a_parameter(spark):
    df = spark.createDataFrame([(1, "one.\ntwo.\nthree.\ntwo.")], "doc_id long, text string")
    known = {"one": "1", "two": "2", "three": "3"}
    r = L.scan_licenses(df, sentences=known, rules=[("AB", ["1", "2"]), ("B", ["2"])]).first()
    assert (r.licenses, r.left_over) == ("AB,B", "<3>")
    r = L.scan_licenses(df, sentences=known, rules=[("B", ["2"]), ("AB", ["1", "2"])]).first()
    assert (r.licenses, r.left_over) == ("B,B", "<1><3>")
    assert L.scan_licenses(df, sentences={}, rules=[]).first().n_known == 0


def test_query_matches_sql(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        got = spark_rows(queries.op4_license_rules(spark, sf))
        assert got == duck_rows(queries.OP4_SQL, sf)
        assert any(r["licenses"] for r in got)


MIT_FILE = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_FILE = """Copyright (c) 2020, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
ISC_FILE = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
GPL3_NOTICE = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""
GPL2_NOTICE = """/*
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 */
"""
LGPL_NOTICE = """# This library is free software; you can redistribute it and/or
# modify it under the terms of the GNU Lesser General Public
# License as published by the Free Software Foundation; either
# version 2.1 of the License, or (at your option) any later version.
"""
MPL_NOTICE = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
CC0_FILE = """CC0 1.0 Universal

Statement of Purpose

The laws of most jurisdictions throughout the world automatically confer
exclusive Copyright and Related Rights (defined below) upon the creator
and subsequent owner(s) (each and all, an "owner") of an original work of
authorship and/or a database (each, a "Work").
"""
APACHE_NOTICE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0
"""


def test_published_texts(spark):
    bsd2 = BSD_FILE[:BSD_FILE.index("3. ")] + BSD_FILE[BSD_FILE.index("THIS SOFTWARE IS"):]
    agpl, lgpl3 = (GPL3_NOTICE.replace("GNU", f"GNU {kind}") for kind in ("Affero", "Lesser"))
    cases = [("MIT", MIT_FILE), ("BSD-3-Clause", BSD_FILE), ("BSD-2-Clause", bsd2), ("ISC", ISC_FILE), ("GPL-3.0-or-later", GPL3_NOTICE), ("GPL-2.0-or-later", GPL2_NOTICE),
             ("LGPL-2.1-or-later", LGPL_NOTICE), ("LGPL-3.0-or-later", lgpl3), ("AGPL-3.0-or-later", agpl), ("MPL-2.0", MPL_NOTICE), ("CC0-1.0", CC0_FILE), ("Apache-2.0", APACHE_NOTICE)]
    unwrapped = [(name, re.sub(r"(?<=\S)\n[ *#]*(?=[^\s/*#])", " ", t)) for name, t in cases]
    crlf = [(name, t.replace("\n", "\r\n")) for name, t in cases]
    cases += unwrapped + crlf + [("", "This program is free software.\nyou can redistribute"), ("MIT,BSD-3-Clause", MIT_FILE + BSD_FILE),
                                 ("", "Released under.\nthe MIT License"), ("", "Released under\n\nthe MIT License"), ("MIT", "see\nReleased under\nthe MIT License\nhere")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    for i, (name, text) in enumerate(cases):
        assert got[i].licenses == name, text
        assert not name or got[i].left_over == "", text
    assert got[len(cases) - 1].n_sentences == 3  # a wrapped known sentence is one

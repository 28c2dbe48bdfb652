"""Queries that SQL can express, against it, and edge cases of their operators."""

import zlib

import pytest
from llm_fixtures import SF_SMALL, awkward, awkward_rows, empty
from oracle_compare import compare, connect

from siltworks.llm import licenses, sharding, warc
from siltworks.llm.oracles import ORACLES
from siltworks.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_SMALL), connect(SF_SMALL), ORACLES[name]) == []


def test_all_are_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def scanned(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r.licenses for r in licenses.scan(rows).orderBy("id").collect()]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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

APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""

GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""

GPL3 = GPL2.replace("software; you", "software: you").replace("Foundation; either version 2", "Foundation, either version 3")

LGPL3 = GPL3.replace("GNU General", "GNU Lesser General")

MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""

ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
"""

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""


def test_licence_texts_are_recognised_as_wholes(spark):
    mixed = "Some prose.\nReleased under the MIT License. More prose.\nLicensed under CC BY-NC 4.0."
    one_line = " ".join(MPL.replace("*", " ").split())
    assert scanned(spark, MIT, APACHE, BSD, GPL2, GPL3, LGPL3, MPL, one_line, ISC, mixed, "the mit license", None, "") == [
        "MIT",
        "Apache-2.0",
        "BSD-3-Clause",
        "GPL-2.0-or-later",
        "GPL-3.0-or-later",
        "LGPL-3.0-or-later",
        "MPL-2.0",
        "MPL-2.0",
        "ISC",
        "MIT CC-BY-NC-4.0",
        "",
        "",
        "",
    ]


def test_whole_notices_leave_no_sentence_over(spark):
    """The rule for the full text fires, not one for a part of it."""
    texts = [MIT, APACHE, BSD, GPL2, GPL3, LGPL3, MPL, ISC]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.id: (r.n_known, r.unmatched) for r in rows} == {k: (n, "") for k, n in enumerate((4, 5, 4, 6, 5, 5, 3, 1))}


def test_licences_of_awkward_rows(spark):
    assert licenses.scan(awkward(spark)).count() == len(awkward_rows())
    assert licenses.scan(empty(spark)).count() == 0


def jump(key: int, shards: int) -> int:
    b, j, key = -1, 0, key & (1 << 64) - 1
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards_of_awkward_rows(spark):
    rows = sharding.place(awkward(spark), shards=5).collect()
    assert len(rows) == len(awkward_rows())
    wanted = sorted((i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in awkward_rows())
    assert sorted((r.id or 0, r.size, r.text_crc32) for r in rows) == wanted
    for r in rows:
        assert (r.shard, r.grown_shard) == (jump(r.id or 0, 5), jump(r.id or 0, 6))
        assert r.grown_shard in (r.shard, 5)
    for s in range(5):
        own = [r.slot for r in rows if r.shard == s]
        assert sorted(own) == list(range(len(own)))
    assert sharding.place(empty(spark)).count() == 0


def test_slots_have_no_gap_under_one_hot_id(spark):
    rows = spark.range(0, 4000, 1, 7).selectExpr("CASE WHEN id % 3 = 0 THEN 11 ELSE id END AS doc_id", "'x' AS text")
    placed = sharding.place(rows).toPandas()
    assert len(placed) == 4000
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in placed.groupby("shard"))


PAGES = "page_id long, url string, html string, digest string, leader int"


def test_archives_hold_what_was_written(spark):
    rows = [
        (1, "http://a/\r\nX: y", "same", "x", 1),
        (5, None, "same", "x", 1),
        (5, None, "same", "x", 1),
        (2, "http://b", "ünï\r\n\r\nbody", "x", 1),
        (3, "http://c", "", "x", 1),
        (4, "http://d", None, "x", 1),
        (None, "http://e", "same", "x", 1),
        (6, "http://f", "long " * 100_000, "x", 1),
    ]
    index = warc.write_archives(spark.createDataFrame(rows, PAGES))
    read = warc.read_records(index, payloads=True).collect()
    assert len(read) == len(rows)
    found = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in read))
    assert found == [
        (0, "revisit", 5, 4),
        (1, "revisit", 5, 4),
        (2, "response", None, 13),
        (3, "revisit", 4, 0),
        (4, "response", None, 0),
        (5, "response", None, 4),
        (5, "response", None, 4),
        (6, "response", None, 500_000),
    ]
    by_id = {r.page_id: r for r in read}
    assert by_id[2].payload.decode() == rows[3][2] and by_id[6].payload == rows[7][2].encode()
    assert all(r.payload_digest == warc.base32_sha1(r.payload) for r in read if r.payload is not None)
    assert by_id[1].url == "http://a/%0D%0AX:%20y" and by_id[5].url is None


def test_one_record_is_read_by_its_place(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i}") for i in range(200)], "page_id long, url string, html string")
    index = warc.write_archives(pages)
    read = warc.read_records(index.filter("url IN ('http://x/7', 'http://x/150')"), payloads=True).collect()
    assert sorted(r.payload.decode() for r in read) == ["page 150", "page 7"]


def test_small_payloads_need_not_be_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    read = warc.read_records(warc.write_archives(pages, min_revisit_bytes=3)).collect()
    assert sorted((r.page_id, r.record_type) for r in read) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_no_pages(spark):
    index = warc.write_archives(spark.createDataFrame([], PAGES))
    assert index.count() == 0 and warc.read_records(index).count() == 0

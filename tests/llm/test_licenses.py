"""Notices that are no template themselves: wrapped headers, comments, licence files, SPDX lines, and texts without a licence."""

import pytest
from compare import differences, sql_engine

from agrometry.llm import license_scan, queries

GPL3 = """# Copyright (C) 2019 Some Body <some@body.example>
#
# This file is part of Thing.
# Thing is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
import os"""
AGPL = """/*
 * This program is free software: you can redistribute it and/or modify it
 * under the terms of the GNU Affero General Public License as published by the Free
 * Software Foundation, either version 3 of the License, or (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
 * even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
 * Affero General Public License for more details.
 */
int main() { return 0; }"""
GPL2 = AGPL.replace("Affero General", "General").replace("version 3", "version 2")
LGPL = AGPL.replace("Affero General", "Lesser General").replace("program", "library").replace("version 3", "version 2.1")
APACHE = """// Copyright 2020 The Authors
//
// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//      http://www.apache.org/licenses/LICENSE-2.0
//
// Unless required by applicable law or agreed to in writing, software
// distributed under the License is distributed on an "AS IS" BASIS,
// WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
// See the License for the specific language governing permissions and
// limitations under the License.
package main"""
MIT = """Copyright (c) 2021 Some Body

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
ISC = "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."
MPL = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\nvar x = 1;"
BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
BSD2 = BSD3.split("3. Neither")[0]
NOTICES = [
    ("BSD-2-Clause", BSD2),
    ("GPL-3.0", GPL3), ("AGPL-3.0", AGPL), ("GPL-2.0", GPL2), ("LGPL-2.1", LGPL), ("Apache-2.0", APACHE), ("MIT", MIT), ("ISC", ISC), ("MPL-2.0", MPL), ("BSD-3-Clause", BSD3),
    ("MIT", "#!/bin/sh\n# SPDX-License-Identifier: MIT\necho"), ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-or-later\ncode"), ("Apache-2.0", "/* SPDX-License-Identifier: Apache-2.0 */"),
    ("AGPL-3.0", "-- SPDX-License-Identifier: AGPL-3.0-only"), (None, "# SPDX-License-Identifier: Zlib\ncode"), (None, "a program that is free and useful, in general, for the public"),
    (None, "see the licence of the software you use"), (None, "the terms and conditions of the contract are subject to change without notice"),
]


@pytest.fixture(scope="module")
def scanned(spark, folder):
    """The notices among the documents of the smallest tables, so that terms weigh as in a corpus."""
    corpus = [(f"corpus/{r['doc_id']}/x.txt", r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = [(f"n{k}/code.txt", "first lines\nof something\n\n" * 3 + text) for k, (_, text) in enumerate(NOTICES)]
    rows += [(f"m{k}/LICENSE", text) for k, (_, text) in enumerate(NOTICES)] + [(f"m{k}/sub/code.txt", "nothing here") for k in range(len(NOTICES))]
    found = license_scan.scan(spark.createDataFrame(corpus + rows, "path string, text string").repartition(6))
    return {r["path"]: (r["license"], r["evidence"]) for r in found.collect()}


@pytest.mark.parametrize("k", range(len(NOTICES)))
def test_notices_are_told(scanned, k):
    name = NOTICES[k][0]
    assert scanned[f"n{k}/code.txt"] == ((name, "notice") if name else (None, "none"))
    assert scanned[f"m{k}/LICENSE"] == ((name, "notice") if name else (None, "none"))
    assert scanned[f"m{k}/sub/code.txt"] == ((name, "inherited") if name else (None, "none"))


def test_sql_of_texts_with_headers(spark, tmp_path, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(10_000 + k, NOTICES[k % len(NOTICES)][1], "en", "src1", 1) for k in range(90)]
    docs.union(spark.createDataFrame(rows, docs.schema)).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    engine = sql_engine(folder)
    engine.execute(f"create or replace view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert differences(queries.op6_licenses(spark, str(tmp_path)), engine, queries.oracle_sql()["op6_licenses"]) == []


def test_runs_are_compared_inside_their_row(spark):
    files = spark.createDataFrame([("a/x.py", APACHE, 1), ("a/y.py", "code", 2)], "path string, text string, copy bigint")
    plan = license_scan.own_notices(files, license_scan.templates())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(path") == plan.count("Exchange") == 1
    assert "BroadcastHashJoin" not in plan


def test_a_row_twice_counts_its_terms_once(spark):
    text = "the code of some author " + ISC.replace("\n", " ")
    once, twice = ([(path, text) for path in paths] + [("c/z.py", "other words")] for paths in (("a/x.py", "b/x.py"), ("a/x.py", "a/x.py")))
    once, twice = (license_scan.scan(spark.createDataFrame(rows, "path string, text string")).where("path = 'a/x.py'").distinct().collect() for rows in (once, twice))
    assert once == twice and once[0]["license"] == "ISC"

import pytest

from candela.llm.licenses import license_scan, license_scan_digest, license_scan_sql
from llm_corpora import SF_ORACLE


def scan(make_docs, *texts):
    rows = license_scan(make_docs(list(enumerate(texts)))).collect()
    return {r["doc_id"]: r for r in rows}


def test_notices_and_order(make_docs):
    found = scan(
        make_docs,
        "Some text. Licensed under the Apache License, Version 2.0. More.",
        "THIS WORK IS LICENSED under the GNU General Public License, version 3.",
        "Released under the MIT License.\nLicensed under CC BY-NC 4.0.",
        None,
        "",
        "nothing here",
    )
    assert found[0]["licenses"] == ["Apache-2.0"]
    assert found[1]["licenses"] == ["GPL-3.0"]
    assert found[2]["sentence_ids"] == ["mit-notice", "cc-by-nc-notice"]
    assert found[2]["licenses"] == ["CC-BY-NC-4.0", "MIT"]
    assert [found[i]["licenses"] for i in (3, 4, 5)] == [[], [], []]


def test_sequences_need_their_order(make_docs):
    free = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"
    later = "either version 3 of the License, or (at your option) any later version."
    found = scan(make_docs, f"{free};\n{later}", f"{later}\n{free}.", f"{free}; other words stand here. {later}")
    assert found[0]["rules"] == ["GPL-3.0:3"]
    assert found[1]["rules"] == []
    assert found[2]["rules"] == ["GPL-3.0:3"]


def test_longer_rule_wins_but_not_elsewhere(make_docs):
    notice = "Licensed under the Apache License, Version 2.0."
    comply = "You may not use this file except in compliance with the License."
    found = scan(make_docs, f"{notice}\n{comply}", f"{notice}\n{comply}\n{notice}")
    assert found[0]["rules"] == ["Apache-2.0:2"]
    assert found[1]["rules"] == ["Apache-2.0:2", "Apache-2.0:1"]


def test_native_empty_and_repeated(make_docs):
    df = license_scan_digest(make_docs([]))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    rows = license_scan_digest(make_docs([(1, "MIT License"), (1, "MIT License"), (None, "x" * 100_000)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_known"]) for r in rows) == [(0, 0), (1, 1), (1, 1)]


MIT = """MIT License

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
BSD = """Copyright (c) 2020, Some One

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
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
APACHE = """   Copyright 2020 Some One

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
GPL_3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
GPL_2 = GPL_3.replace("version 3", "version 2").replace("software: you", "software; you").replace("Foundation, either", "Foundation; either")
WHOLE = {"MIT:4": MIT, "BSD-3-Clause:4": BSD, "Apache-2.0:4": APACHE, "GPL-3.0:2": GPL_3, "GPL-2.0:3": GPL_2}


def unwrapped(text):
    return "\n\n".join(" ".join(p.split()) for p in text.split("\n\n"))


def test_whole_licence_texts_wrapped_and_unwrapped(make_docs):
    texts = list(WHOLE.values())
    forms = (
        texts,
        [unwrapped(t) for t in texts],
        [t.replace("\n", "\r\n") for t in texts],
        ["".join(f"# {line}".rstrip() + "\n" for line in t.splitlines()) for t in texts],
    )
    for form in forms:
        found = scan(make_docs, *form)
        assert [found[i]["rules"] for i in range(len(texts))] == [[r] for r in WHOLE]


def test_lines_of_their_own_stay_known(make_docs):
    found = scan(make_docs, "one | two |\nAll rights reserved\nthree", "The MIT License (MIT)\nCopyright Some One\n", "\n" * 50_000 + "MIT License")
    assert [found[i]["licenses"] for i in range(3)] == [["Proprietary"], ["MIT"], ["MIT"]]


def test_sql_agrees_on_unwrapped_texts_and_given_documents(spark, make_docs):
    duckdb = pytest.importorskip("duckdb")
    from candela.llm.common import table

    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_ORACLE, "documents").collect()]
    rows += [(100_000 + i, unwrapped(t)) for i, t in enumerate(WHOLE.values())]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = sorted(map(tuple, license_scan_digest(make_docs(rows)).collect()), key=str)
    assert got == sorted(db.execute(license_scan_sql()).fetchall(), key=str)


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
""",
    "Zlib": """Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
""",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n",
    "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003\n\nDistributed under the Boost Software License, Version 1.0.\n",
}


def test_wrapped_licences_by_operator_and_sql(spark):
    """The SQL reads wrapped sentences as the operator does."""
    import duckdb
    import pandas as pd

    rows = [(i, f"Some words first.\n\n{text}\nMore words.", name) for i, (name, text) in enumerate(WRAPPED.items())]
    rows += [(100 + i, text.replace("\n", " "), name) for i, (name, text) in enumerate(WRAPPED.items())] + [(200, None, ""), (201, "", "")]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: r.asDict() for r in license_scan_digest(docs).collect()}
    for i, _, name in rows:
        if name and i < 100:
            assert name in got[i]["licenses"].split(","), (name, got[i])
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([r[:2] for r in rows], columns=["doc_id", "text"]))
    names = [d[0] for d in con.sql(license_scan_sql()).description]
    assert {r[0]: dict(zip(names, r, strict=True)) for r in con.sql(license_scan_sql()).fetchall()} == got

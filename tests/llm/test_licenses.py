"""Known license texts with their lines broken anew."""

from __future__ import annotations

import textwrap
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from compare import difference

from almacen.llm import licenses, queries, sql

WHOLE = [(name, text) for name, text in licenses.KNOWN if len(text) > 300]
NOTICES = ["Copyright (c) 2020 Ann Smith", "Copyright 1998, 2001 The Regents of the University. All rights reserved."]


def broken(text, width):
    """The paragraphs of a text at a width, or all of it on one line."""
    if width is None:
        return " ".join(text.split())
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in text.split("\n\n"))


@pytest.mark.parametrize("notice", [None, *NOTICES])
def test_known_texts_at_every_width(spark, notice):
    rows = []
    for name, text in WHOLE:
        title, _, body = text.partition("\n")
        given = [text] if notice is None else [f"{notice}\n\n{text}"]
        if notice and "License" in title:
            given.append(f"{title}\n\n{notice}\n\n{body}")
        widths = (*range(20, 100, 3), 10**6, None)
        rows += [(f"{name} {w} {i}", name, broken(x, w)) for i, x in enumerate(given) for w in widths]
    docs = spark.createDataFrame(rows, "doc_id string, name string, text string")
    found = {(r["doc_id"], r["license"]) for r in licenses.scan(docs).collect()}
    assert {x for x in found if x[0].split()[0] != x[1]} == set()


def test_only_notices_are_left_out(spark):
    body = ["copyright notice and this", "COPYRIGHT HOLDERS BE LIABLE", "copyright owner or entity", "copyrighted work"]
    body += ["(c) You must retain", "copyright law"]
    notices = ["Copyright (c) 2020 Ann", "copyright 2020 Ann", "© all of us", "(C) 2020", "Copyright Acme Ltd."]
    rows = [(line, f"first\n{line}\nlast") for line in body + notices]
    df = spark.createDataFrame(rows, "line string, text string")
    found = {r[0]: r[1] for r in df.select("line", licenses.canonical(df["text"])).collect()}
    assert {line for line, form in found.items() if form == "first last"} == set(notices)
    assert all(form.count(" ") > 2 for line, form in found.items() if line in body)


def test_a_notice_line_keeps_the_license_it_names(spark):
    docs = spark.createDataFrame([(1, "Copyright 2020 Ann. Released under the MIT License.")], "doc_id int, text string")
    assert licenses.scan(docs).first()["notices"] == "MIT"


@pytest.mark.parametrize("between", ["\n", "\n\n"])
def test_notices_of_any_number_of_holders_are_left_out(spark, between):
    holders = "\n".join(f"Copyright (c) {1980 + i % 40} Holder Number {i} <h{i}@example.org>" for i in range(300))
    docs = spark.createDataFrame([(1, holders + between + licenses.KNOWN[0][1])], "doc_id int, text string")
    assert licenses.scan(docs).first()["license"] == "MIT"


def test_scan_matches_its_sql_on_notices_and_body_lines(spark, tmp_path):
    mit = licenses.KNOWN[0][1]
    texts = [mit, f"Copyright 2020 Ann\n{mit}", f"x\nCopyright notice of body\n{mit}", "copyright holders and\nmore"]
    texts += ["(c) 2020 A\nB\nC\nReleased under the MIT License.", "© A\n\nlicensed under CC BY 4.0.", "no (c) here"]
    texts += ["see copyright 2020 Ann. Licensed under CC BY-SA 4.0. more", "copyright\n", "Copyright Ann\nText", None, ""]
    texts += ["SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0", "well- known\nsub-\nlicense", mit]
    frame = pd.DataFrame({"doc_id": [1, None, 3, 3, *range(5, len(texts) + 1)], "text": texts})
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    frame.to_parquet(tmp_path / "documents.parquet")
    with duckdb.connect() as connection:
        connection.execute(f"create view documents as from '{tmp_path}/documents.parquet'")
        assert difference(queries.op9_license_scan(spark, str(tmp_path)), connection, sql.LICENSES) is None


def test_rows_without_a_key_have_their_own_notices(spark):
    rows = [(None, "Released under the MIT License."), (None, "plain"), (1, "Licensed under CC BY 4.0."), (1, "x")]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["notices"], r["n_notices"]) for r in found) == [
        (0, "", 0), (0, "MIT", 1), (1, "", 0), (1, "CC-BY-4.0", 1)
    ]


#: Where Debian keeps whole license texts.
FOLDER = Path("/usr/share/common-licenses")
FILES = {
    "Apache-2.0": "Apache-2.0",
    "GPL-1.0": "GPL-1",
    "GPL-2.0": "GPL-2",
    "GPL-3.0": "GPL-3",
    "LGPL-2.0": "LGPL-2",
    "LGPL-2.1": "LGPL-2.1",
    "LGPL-3.0": "LGPL-3",
    "MPL-1.1": "MPL-1.1",
    "MPL-2.0": "MPL-2.0",
    "CC0-1.0": "CC0-1.0",
    "GFDL-1.2": "GFDL-1.2",
    "GFDL-1.3": "GFDL-1.3",
    "Artistic-1.0-Perl": "Artistic",
}
#: These end with a form whose notice is a line of its own, which breaking lines anew would move.
WITH_FORM = ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "GFDL-1.2", "GFDL-1.3")


@pytest.mark.skipif(not FOLDER.is_dir(), reason="no license texts on this machine")
def test_whole_licenses_known_by_digest(spark):
    rows = []
    for name, file in FILES.items():
        text = (FOLDER / file).read_text()
        changed = [text, text.upper(), text.replace("https://", "http://")]
        if name not in WITH_FORM:
            changed += [broken(text, 60), broken(text, 200)]
        changed.append(text.replace("license", "licence").replace("\n", "\r\n"))
        rows += [(f"{name} {i}", name, t) for i, t in enumerate(changed)]
        rows.append((f"- {name}", None, text + "\n\nNot for use on Mondays."))
        rows.append((f"-- {name}", None, text[: len(text) // 2]))
    docs = spark.createDataFrame(rows, "doc_id string, name string, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.scan(docs).collect()}
    assert {k: v for k, v in found.items() if v != (None if k[0] == "-" else k.split()[0])} == {}
    with duckdb.connect() as db:
        db.register("documents", pd.DataFrame(rows, columns=["doc_id", "name", "text"]))
        by_sql = dict(db.execute(f"select doc_id, license from ({sql.LICENSES})").fetchall())
    assert by_sql == found


def test_every_digest_names_one_license():
    digests = [digest for _, digest in licenses.WHOLE_DIGESTS]
    assert len(set(digests)) == len(digests)
    assert {name for name, _ in licenses.WHOLE_DIGESTS} == set(FILES)

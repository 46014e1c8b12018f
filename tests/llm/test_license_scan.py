"""Whole texts of long licences, copyright lines behind comment marks, and odd inputs."""

import os
import re

import pytest

from meridian.llm.license_scan import license_scan
from meridian.llm.license_texts import MIT

SHELF = "/usr/share/common-licenses"
FILES = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "MPL-2.0": "MPL-2.0",
         "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3"}


@pytest.mark.skipif(not os.path.isdir(SHELF), reason="no licence texts on this machine")
def test_whole_texts_of_long_licences(spark):
    rows = []
    for f, name in FILES.items():
        text = open(f"{SHELF}/{f}").read()
        rows += [(name, text), (name, re.sub(r"\bLICENSE\b", "LICENCE", text.upper())), (None, text + "\nand more")]
    df = spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(rows)], "doc_id long, text string, license string")
    got = {r.doc_id: r.license for r in license_scan(df).collect()}
    assert [got[i] for i in range(len(rows))] == [n for n, _ in rows]


def test_comment_marks_and_reserved_rights(spark):
    noted = "\n".join("# " + x for x in ["Copyright 2020 A. Body", "All rights reserved.", "", *MIT.split("\n")])
    star = "/*\n * Copyright (c) 2020 A. Body\n * All Rights Reserved\n *\n" + "\n".join(" * " + x for x in MIT.split("\n")) + "\n */"
    rows = [(1, noted), (2, star), (3, None), (4, ""), (5, "x " * 200_000), (6, MIT.replace("sublicense", "sublicence")), (6, noted)]
    got = sorted((r.doc_id, r.license, tuple(r.notices)) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [x[:2] for x in got] == [(1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (6, "MIT"), (6, "MIT")]


def test_empty_table(spark, none):
    assert license_scan(none).count() == 0

import re

import numpy as np

from cinerank.llm.licenses import fit, scan
from tests.conftest import SF_MID

PLAIN = [("apache", r"Licensed under the Apache License"), ("gpl", r"licensed under the GNU General Public"), ("cc-by-nc", r"Licensed under CC BY-NC"),
         ("mit", r"Released under the MIT License"), ("proprietary", r"All rights reserved")]


def test_whole_table_equals_plain_patterns(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    want = {(r["doc_id"], k, f) for r in docs.collect() for k, p in enumerate((r["text"] or "").split("\n"))
            for f, pattern in PLAIN if re.search(pattern, p, re.I)}
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in scan(docs).collect()}
    assert len(want) > 5
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.02 * len(want) + 1


def test_variants_unknowns_and_awkward_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = fit(docs)
    texts = ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and more", "// SPDX-License-Identifier: MPL-2.0",
             "a line\nThis work is licensed under a Creative Commons Attribution-ShareAlike 4.0 license\nb", "the license of the driver is under review by the public",
             "mit", "general public version 3 terms", None, "", "word " * 50000, "is the of a " * 3000 + "released under the MIT license"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "Released under the MIT License.", "x")],
                               "doc_id long, text string, family string")
    got = {(r["doc_id"], r["paragraph"]): r["family"] for r in scan(df, model).collect()}
    assert got.get((9, 0)) == "mit"     # a statement at the end of a long paragraph
    assert got.get((0, 0)) == "mit" and got.get((1, 0)) == "mpl" and got.get((None, 0)) == "mit"
    assert not {k for k in got if k[0] in (3, 4, 5, 6, 7, 8)}
    assert scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


HEADERS = {
    "gpl": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "lgpl": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "agpl": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or""",
    "mpl": """This Source Code Form is subject to the terms of the
Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this""",
    "mit": """Permission is hereby granted, free of
charge, to any person obtaining
a copy of this software and associated documentation files""",
    "bsd": """Redistribution and use in
source and binary forms, with or
without modification, are permitted provided that""",
    "cc-by-nc": """This work is licensed under a Creative Commons Attribution
NonCommercial 4.0 International License.""",
    "apache": """you may not use
this file except in
compliance with the License."""}


def test_wrapped_headers(spark):
    model = fit(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    for family, header in HEADERS.items():
        for mark in ("", " * ", "# "):
            text = "some prose before\n\n" + "\n".join(mark + x for x in header.split("\n")) + "\n\nand after it"
            got = [(k, f) for k, f, _, _ in model.statements(text)]
            assert [f for _, f in got] == [family] and 2 <= got[0][0] <= 3, (family, mark, got)
    two = "Released under the MIT License.\nLicensed under the Apache\nLicense, Version 2.0\nAll rights reserved."
    assert [(k, f) for k, f, _, _ in model.statements(two)] == [(0, "mit"), (1, "apache"), (3, "proprietary")]
    assert not list(model.statements("it under the terms of the GNU General\n\nfree software you can redistribute"))


def test_spdx_ids_by_family(spark):
    model = fit(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    ids = {"GPL-2.0": "gpl", "GPL-2.0-only": "gpl", "GPL-3.0-or-later": "gpl", "GPL-2.0+": "gpl", "LGPL-2.1-or-later": "lgpl", "LGPL-3.0-only": "lgpl",
           "AGPL-3.0-only": "agpl", "BSD-2-Clause": "bsd", "BSD-3-Clause": "bsd", "0BSD": "bsd", "Apache-2.0": "apache", "MIT": "mit", "MIT-0": "mit",
           "MPL-1.1": "mpl", "MPL-2.0": "mpl", "CC-BY-4.0": "cc-by", "CC-BY-SA-3.0": "cc-by-sa", "CC-BY-NC-4.0": "cc-by-nc", "CC-BY-NC-SA-4.0": "cc-by-nc",
           "CC0-1.0": "cc0", "Zlib": None, "CC-BY-ND-4.0": None}
    got = {i: [f for _, f, _, _ in model.statements(f"// SPDX-License-Identifier: {i}")] for i in ids}
    assert got == {i: [f] if f else [] for i, f in ids.items()}


def test_repeated_lines_enter_the_sample_once(spark):
    lines = [f"prose about the use of {'abcdefgh'[i % 8] * (i + 3)} in public work" for i in range(60)]
    one = fit(spark.createDataFrame([(x,) for x in lines], "text string"), sample=60)
    many = fit(spark.createDataFrame([(x,) for x in lines + ["\n".join(lines[::3] * 40)]], "text string").repartition(5), sample=60)
    assert np.allclose(one.w, many.w) and one.least == many.least

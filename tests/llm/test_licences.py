import re

import pytest

from daymark.llm import licences
from daymark.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.odd import documents, odd_rows


@pytest.fixture(scope="module")
def scanner(spark):
    return licences.train(spark)


def test_templates_and_others(spark, scanner):
    rows = [(i, t) for i, (_, t) in enumerate(licences.TEMPLATES)]
    rows += [(100 + i, t) for i, t in enumerate(licences.OTHER)]
    found = {r.doc_id: r for r in licences.scan(documents(spark, rows), scanner).collect()}
    assert {i: found[i].family for i in found} == {i: f for i, (f, _) in enumerate(licences.TEMPLATES)}
    assert all(r.confirmed and r.probability > scanner.threshold for r in found.values())


def test_changed_wording_and_place(spark, scanner):
    text = "Intro.\n  LICENSED under the Apache License, version 2.0!  \nReleased under MIT License\nThe end."
    found = licences.scan(documents(spark, [(1, text)]), scanner).collect()
    assert sorted((r.paragraph, r.family, r.confirmed) for r in found) == [(1, "Apache-2.0", True), (2, "MIT", True)]


def test_odd_documents_hold_none(spark, scanner):
    assert licences.scan(documents(spark, odd_rows()), scanner).collect() == []
    assert licences.scan(documents(spark, []), scanner).collect() == []
    twice = [(None, "All rights reserved."), (None, "All rights reserved.")]
    assert licences.scan(documents(spark, twice), scanner).count() == 2


def test_whole_table_against_the_planted_lines(spark):
    planted = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "All rights reserved.": "reserved",
    }
    got = {r.doc_id: r.licences for r in QUERIES["op9_licence_scan"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    for d in docs:
        assert got[d.doc_id] == ",".join(sorted({planted[x] for x in d.text.split("\n") if x in planted}))


def test_no_python_in_the_plan(spark, scanner):
    plan = licences.scan(documents(spark, odd_rows()), scanner)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_the_gate_finds_whole_words():
    gate = re.compile(licences._any_of(["mit", "gpl-3.0", "license", "licensed"]))
    for text in ("mit", "the mit license.", "(gpl-3.0)", "licensed.", "x mit.\n"):
        assert gate.search(text)
    for text in ("emit", "mitten", "licenses", "gpl-3.01", "x.mit-y"):
        assert not gate.search(text)


MIT_TEXT = """The MIT License (MIT)

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer."""
GPL_TEXT = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
APACHE_TEXT = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License."""


def confirmed(spark, scanner, texts):
    rows = licences.scan(documents(spark, list(enumerate(texts))), scanner).filter("confirmed").collect()
    return [sorted((r.paragraph, r.family) for r in rows if r.doc_id == i) for i in range(len(texts))]


def test_wrapped_texts(spark, scanner):
    got = confirmed(spark, scanner, [MIT_TEXT, BSD_TEXT, GPL_TEXT, APACHE_TEXT])
    assert got[0] == [(0, "MIT"), (4, "MIT"), (11, "MIT")]
    assert got[1] == [(0, "BSD"), (3, "BSD")]
    # Lines that are enough by themselves.
    assert got[2] == [(1, "GPL")] and got[3] == [(0, "Apache-2.0"), (1, "Apache-2.0")]
    # A blank line parts paragraphs.
    assert confirmed(spark, scanner, ["Mozilla Public\n\nLicense Version 2.0"]) == [[]]


def test_headers(spark, scanner):
    headers = {
        "MIT License": "MIT",
        "The MIT License (MIT)": "MIT",
        "Apache License, Version 2.0": "Apache-2.0",
        "Apache License\n   Version 2.0, January 2004": "Apache-2.0",
        "GNU GENERAL PUBLIC LICENSE": "GPL",
        "GNU LESSER GENERAL PUBLIC LICENSE": "LGPL",
        "Mozilla Public License Version 2.0": "MPL",
        "BSD 3-Clause License": "BSD",
        "BSD 2-Clause License": "BSD",
    }
    assert confirmed(spark, scanner, list(headers)) == [[(0, f)] for f in headers.values()]


def test_spdx_ids_without_a_template(spark, scanner):
    ids = {
        "GPL-2.0-only": "GPL",
        "GPL-2.0+": "GPL",
        "LGPL-3.0-or-later": "LGPL",
        "BSD-2-Clause": "BSD",
        "MPL-1.1": "MPL",
        "MIT-0": "MIT",
        "CC-BY-3.0": "CC-BY",
        "CC-BY-SA-3.0": "CC-BY-SA",
        "CC-BY-NC-2.0": "CC-BY-NC",
    }
    got = confirmed(spark, scanner, [f"# SPDX-License-Identifier: {i}" for i in ids])
    assert got == [[(0, f)] for f in ids.values()]


def test_every_family_of_a_paragraph(spark, scanner):
    got = confirmed(
        spark,
        scanner,
        [
            "Licensed under either of Apache License, Version 2.0 or the MIT License.",
            "SPDX-License-Identifier: MIT OR Apache-2.0",
        ],
    )
    assert got == [[(0, "Apache-2.0"), (0, "MIT")]] * 2


def test_what_only_sounds_alike_is_not_confirmed(spark, scanner):
    texts = [
        "Er kam mit dem Bus.\nThe license of the driver was lost.",
        "The public\nof the general store was free to choose the version of the story.",
        "She kept a copy of the contract without warranty.",
    ]
    assert confirmed(spark, scanner, texts) == [[], [], []]

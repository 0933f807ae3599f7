import pytest

from meterlake.llm import licences as L
from tests.llm.helpers import ODD_TEXTS, docs, empty, read

NOTICES = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Released under the MIT License.": "MIT",
    "released under the mit license": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "All rights reserved.": "Proprietary",
}
OTHER = ["He was licensed to drive the version of the car.", "The public has general rights.", "Permission was not given to the person."]


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_families_are_told_and_confirmed(spark, model):
    texts = [f"Some first line.\n\n{n}\r\nlast line" for n in NOTICES] + ["\n".join(OTHER)]
    got = L.scan(docs(spark, texts, extra=True), model).where("confirmed").collect()
    assert sorted((r.doc_id, r.para_no, r.family) for r in got) == [(i, 2, f) for i, f in enumerate(NOTICES.values())]
    assert 0.5 <= model.threshold <= 0.95 and all(r.probability >= model.threshold for r in got)


def test_table_against_the_known_notices(spark, model):
    df = read(spark, "documents")
    want = sorted(
        (r.doc_id, i, NOTICES[line]) for r in df.collect() for i, line in enumerate((r.text or "").split("\n")) if line in NOTICES
    )
    got = L.scan(df, model)
    assert sorted((r.doc_id, r.para_no, r.family) for r in got.where("confirmed").collect()) == want and want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_odd_rows_and_empty(spark, model):
    texts = [*ODD_TEXTS, "All rights reserved.", "All rights reserved.", " - \n . \n", "All rights reserved. " * 3000]
    got = L.scan(docs(spark, texts, [None] * len(texts), extra=True), model)
    assert got.where("paragraph = 'All rights reserved.'").count() == 2
    assert L.scan(empty(spark), model).count() == 0


def test_training_without_documents(spark):
    model = L.train(empty(spark))
    assert L.scan(docs(spark, ["Released under the MIT License."]), model).collect()[0].family == "MIT"


GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD_3 = """Redistribution and use in source and binary forms,
with or without modification,
are permitted provided that the
following conditions are met:"""


def test_hard_wrapped_notices_are_confirmed_as_paragraphs(spark, model):
    wrapped = {GPL_3: "GPL-3.0", MIT: "MIT", BSD_3: "BSD"}
    texts = [f"First line.\n \n{n}\n\nlast line" for n in wrapped]
    texts += ["/*\n" + "\n".join(f" * {x}".rstrip() for x in n.split("\n")) + "\r\n *\n */\r\nint x;" for n in wrapped]
    got = L.scan(docs(spark, [*texts, texts[0]], [*range(len(texts)), 0], extra=True), model).where("confirmed").collect()
    want = [(i, 2, f) for i, f in enumerate(wrapped.values())] + [(3 + i, 1, f) for i, f in enumerate(wrapped.values())]
    assert sorted((r.doc_id, r.para_no, r.family) for r in got) == sorted([*want, want[0]])
    assert {r.paragraph for r in got if r.doc_id < 3} == set(wrapped)


def test_paragraphs_are_lines_and_runs_of_lines(spark):
    got = L.paragraphs(docs(spark, ["\n\na\n\t\n--\nb\tc\n d\r\n\n\ne"])).drop("doc_id", "text_hash")
    assert sorted(tuple(r) for r in got.collect()) == [
        (2, 2, False, "a"), (5, 5, False, "b\tc"), (5, 5, True, "b\tc\n d\r"), (5, 6, False, " d\r"), (9, 9, False, "e")
    ]


def test_common_notices_and_copies_of_one_text_hide_nothing(spark):
    """Each notice in a fifth of the lines, one text in most of the rows."""
    plain = [f"Line {i} of a plain text with the word {i * i}, and nothing of the kind." for i in range(300)]
    often = ["All rights reserved.", "Licensed under the MIT license.", "Licensed under the Apache License, Version 2.0."]
    texts = [f"{p}\n\n{n}" for p in plain for n in often[:1]] + [f"{p}\n\n{often[1]}\n\n{often[2]}" for p in plain]
    train = docs(spark, texts + [often[0]] * 900)
    model = L.train(train)
    assert all(model.shares[w] > L.COMMON for w in ("rights", "reserved", "all", "mit", "apache"))
    got = L.scan(docs(spark, [*often, *plain[:20]]), model).where("confirmed").collect()
    assert sorted((r.doc_id, r.family) for r in got) == [(0, "Proprietary"), (1, "MIT"), (2, "Apache-2.0")]


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_every_match_of_a_template_holds_a_gate_word(share):
    import re

    shares = {w: share for _, t in L.TEMPLATES for w in re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", t.lower())}
    gate = set(L.gate_words(shares, L.COMMON, L.OVERLAP))
    for _, t in L.TEMPLATES:
        w = re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", t.lower())
        pairs = set(zip(w, w[1:]))
        assert sum(gate.isdisjoint(p) for p in pairs) < L.OVERLAP * len(pairs)


def test_other_versions_are_not_confirmed(spark, model):
    near = [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 2.1.",
        "Licensed under CC BY-SA 3.0.",
        "Licensed under CC BY 2.5.",
        "Licensed under the Apache License, Version 1.1.",
        "This work is licensed under the GNU General Public License, version 1.",
        "Released under the BSD 2-Clause License.",
    ]
    exact = [n for _, n in L.TEMPLATES]
    got = L.scan(docs(spark, [*near, *exact]), model).where("confirmed").collect()
    assert not [r for r in got if r.doc_id < len(near)]
    # each notice itself is confirmed, as its own family
    found = {r.doc_id - len(near): r.family for r in got}
    assert found == {i: f for i, (f, _) in enumerate(L.TEMPLATES)}


def test_the_threshold_lies_between_held_out_notices_and_background(spark, model):
    assert model.threshold > L.FLOOR and model.missed <= 0.05 and model.false <= L.FALSE_SHARE
    assert L.calibrate([(0.9, True), (0.8, True)], [0.1, 0.6], 0.5) == (pytest.approx(0.7), 0.0, 0.0)
    assert L.calibrate([(0.9, True), (0.7, False)], [0.1, 0.2], 0.5)[1:] == (0.5, 0.0)
    # background among the notices: none of it may be named
    assert L.calibrate([(0.9, True), (0.6, True)], [0.7], 0.5) == (pytest.approx(0.8), 0.5, 0.0)
    assert L.calibrate([], [], 0.5)[1:] == (0.0, 0.0)


OTHER_FAMILIES = {
    "// SPDX-License-Identifier: MIT": "MIT",
    "/* SPDX-License-Identifier: Apache-2.0 */": "Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
    "# SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0",
    "SPDX-License-Identifier: LGPL-3.0-or-later": "LGPL-3.0",
    "SPDX-License-Identifier: ISC": "ISC",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies.": "ISC",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
    "https://www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)": "BSL-1.0",
    "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
    "The code is released under the MIT License, see LICENSE.": "MIT",
    "Source is licensed under the Apache License, Version 2.0 (the License);": "Apache-2.0",
    "Copyright 2020 A. Person. All rights reserved.": "Proprietary",
}
NEAR_MISSES = [
    "SPDX-License-Identifier: Zlib",
    "SPDX-License-Identifier: LGPL-2.1-only",
    "SPDX-License-Identifier: CC-BY-SA-3.0",
    "SPDX-License-Identifier: BSD-2-Clause",
    "Licensed under CC BY-ND 3.0.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 1.0.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    "The band was released from its contract under the terms of the agreement.",
    "Permission to enter was granted, free of charge, to any person with a ticket.",
    "The rights of all people are reserved in the constitution.",
]


def test_precision_and_recall_by_family(spark, model):
    texts = [*NOTICES, *OTHER_FAMILIES, *NEAR_MISSES]
    want = dict(enumerate([*NOTICES.values(), *OTHER_FAMILIES.values()]))
    got = {r.doc_id: r.family for r in L.scan(docs(spark, texts), model).where("confirmed").collect()}
    for family in sorted(set(want.values()) | set(got.values())):
        named, own = {d for d, f in got.items() if f == family}, {d for d, f in want.items() if f == family}
        assert named == own, (family, [texts[d] for d in named ^ own])


def test_every_paragraph_is_scored_also_without_a_gate_word(spark):
    """The scan's rows are those of the classifier over all lines, also of lines
    that hold only words that are common in the corpus."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    plain = [f"Line {i} of a plain text with the word {i * i}." for i in range(200)]
    common = ["All rights reserved.", "Licensed under the MIT license.", "Released under the MIT License."]
    model = L.train(docs(spark, plain + [x for x in common for _ in range(200)]))
    cut = [" ".join(w[i:j]) for w in ([*x.rstrip(".").split()] for x in common) for i in range(len(w)) for j in range(i + 1, len(w) + 1)]
    texts = [*cut, *plain[:20], "Nothing of it"]
    rows = L._with_words(L.paragraphs(docs(spark, texts)))
    scored = model.model.transform(L._with_features(rows, model.vocabulary))
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(model.families)))
    want = {r.doc_id: r.words for r in scored.where(best >= model.threshold).collect()}
    assert {r.doc_id for r in L.scan(docs(spark, texts), model).collect()} == set(want)
    gate = set(L.gate_words(model.shares, L.COMMON, L.OVERLAP))
    assert any(gate.isdisjoint(w) for w in want.values())


def test_features_are_the_words_and_pairs_of_the_vocabulary(spark):
    vocabulary = ["a", "a b", "b", "b c", "c"]
    texts = ["a b c", "a x b c", "x a", "a  b", "x", "c a b b", ""]
    rows = L._with_features(L._with_words(docs(spark, texts).withColumnRenamed("text", "paragraph")), vocabulary)
    got = {r.doc_id: [vocabulary[int(i)] for i in r.features.indices] for r in rows.collect()}
    want = {}
    for i, t in enumerate(texts):
        w = t.split()
        want[i] = sorted(g for g in {*w, *map(" ".join, zip(w, w[1:]))} if g in vocabulary)
    assert got == want

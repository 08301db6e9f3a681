import re
import textwrap

import numpy as np
import pytest

from loomwright.llm import op05_licences as op5

PLANTED = {"This work is licensed under the GNU General Public License, version 3.": "GPL", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
#: Notices in words that no template has.
UNSEEN = [
    ("Distributed under the MIT License. See the file LICENSE for more information.", "MIT"),
    ("Foo is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or any later version.", "GPL"),
    ("Copyright 2019 The Authors. Licensed under the Apache License, Version 2.0; you may not use these files except in compliance with the License.", "Apache-2.0"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted for any purpose provided that these conditions are met", "BSD"),
    ("Our handbook is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License and may be shared.", "CC-BY-SA"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this program and associated files, to deal in it without restriction", "MIT"),
    ("You may use this module under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "LGPL"),
    ("This source file is subject to the terms of the Mozilla Public License version 2.0", "MPL-2.0"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return op5.train(docs)


def family(model, text):
    return [f for _, f, _ in model.scan(text)]


def test_templates_and_planted(model):
    for line, f in PLANTED.items():
        assert family(model, line) == [f]
    right = [family(model, t) == [f] for f, ts in op5.NOTICES.items() for t in ts]
    assert sum(right) / len(right) > 0.93
    assert not any(family(model, n) for n in op5.OTHERS)


def test_unseen_and_wrapped_notices(model):
    right = [family(model, t) == [f] for t, f in UNSEEN]
    assert sum(right) >= len(UNSEEN) - 1
    for f in ("MIT", "Apache-2.0", "BSD", "GPL"):
        whole = op5.NOTICES[f][0]
        for mark in ("", "# ", " * ", "// "):
            wrapped = "\n".join(mark + line for line in textwrap.wrap(whole, 60))
            assert family(model, f"some title\n\n{wrapped}\n\nmore text") == [f]
            assert [k for k, _, _ in model.scan(f"some title\n\n{wrapped}\n\nmore text")] == [1]


def test_notice_within_long_prose(model, docs):
    prose = " ".join(w for w in " ".join(r.text or "" for r in docs.limit(40).collect()).split() if w.isalpha())
    assert set(family(model, prose[:20000] + " Released under the MIT License. " + prose[:9000])) == {"MIT"}


def naive(model, text):
    """Every span of every paragraph, classified from its n-grams one by one."""
    out = []
    for k, p in enumerate(x for x in re.split(r"\n[ \t\r\f\v]*(?:(?:#+|//+|\*+|;+|--+)[ \t\r]*)?(?=\n)", text or "") if re.search(r"[^\W_]", x)):
        w = re.findall(r"[^\W_]+", p.lower())
        starts = [0] if len(w) <= op5.SPAN else range(0, len(w) - op5.SPAN // 2, op5.SPAN // 2)
        best = {}
        for a in starts:
            part = w[a : a + op5.SPAN]
            grams = {tuple(part[i : i + n]) for n in (1, 2, 3) for i in range(len(part) - n + 1)}
            z = model.weights[-1] + sum((model.weights[model.at[g]] for g in grams if g in model.at and any(x in model.telling for x in g)), np.zeros(len(model.classes)))
            p_ = np.exp(z / model.temperature - (z / model.temperature).max())
            p_ /= p_.sum()
            c, pairs = int(p_.argmax()), set(zip(part, part[1:], strict=False)) or {tuple(part)}
            if c and p_[c] >= op5.LEAST_SCORE and any(len(pairs & t) >= op5.CONFIRM * min(len(pairs), len(t)) and len(pairs & t) >= min(2, len(t)) for t in model.templates[model.classes[c]]):
                best[model.classes[c]] = max(best.get(model.classes[c], 0), p_[c])
        out += [(k, f, round(best[f], 6)) for f in sorted(best)]
    return out


def test_against_brute_force(spark, docs, model):
    got = {r.doc_id: [(f.paragraph, f.family, round(f.score, 6)) for f in r.findings] for r in op5.licences(docs, model).collect()}
    for r in docs.collect():
        if len(r.text) < 30000:
            assert got[r.doc_id] == naive(model, r.text)
        for line, f in PLANTED.items():
            assert line not in r.text.split("\n") or f in {x for _, x, _ in got[r.doc_id]}


def test_clean_documents(docs, model):
    for r in docs.collect():
        if not re.search("(?i)licen[sc]e|copyright|redistrib|public domain|permission", r.text):
            assert model.scan(r.text) == []


def test_awkward(spark, model):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "word " * 200000 + "\n\nReleased under the MIT License."), (5, "é Released under the MIT License."), (None, "x"), (4, "y"), (4, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as findings", "2 as id")
    got = op5.licences(df, model).collect()
    assert len(got) == 8 and sorted(len(r.findings) for r in got) == [0] * 6 + [1, 1]
    assert op5.licences(df.limit(0), model).count() == 0
    assert family(op5.train(df.limit(0)), "Released under the MIT License.") == ["MIT"]

from chronomart.llm import licence_scan
from chronomart.llm.queries import QUERIES
from tests.llm.fixtures import prose

UNSEEN = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the Software without restriction.",
    "apache-2.0": "// Licensed under the Apache License, Version 2.0: you may not use this file except in compliance with the License",
    "gpl": "This file is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2",
    "cc-by-nc": "Photo: licensed under CC BY-NC 4.0",
    "bsd": "Redistribution and use in source and binary forms, with or without changes, are permitted provided that the following conditions are met",
}
OTHER = [
    "The city granted a fishing license to any person over twelve, free of charge, subject to the weather.",
    "She released the report under the name of her brother.",
    "A new version of the program may be published by the foundation.",
    "This work is hard and the terms of the general public are not known.",
    "license license license", "", "of the of the of the",
]


def test_unseen_notices_and_other_text(spark):
    import random

    rng = random.Random(1)
    rows = [(i, f"{prose(rng, 30)}\n\n{text}\n{prose(rng, 10)}") for i, text in enumerate(UNSEEN.values())]
    rows += [(100 + i, t) for i, t in enumerate(OTHER)] + [(200, None), (None, "Released under the MIT License."), (0, rows[0][1])]
    rows.append((300, "word " * 60_000 + "\nReleased under the MIT License."))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, found int")
    found = licence_scan.licence_paragraphs(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: [(p.line, p.family) for p in r.found] for r in found}
    assert [by[i] for i in range(len(UNSEEN))] == [[(2, f)] for f in UNSEEN]
    assert all(by[100 + i] == [] for i in range(len(OTHER)))
    assert by[200] == [] and by[None] == [(0, "mit")] and by[300] == [(1, "mit")]
    assert licence_scan.licence_paragraphs(docs.limit(0)).count() == 0


def test_held_out_copies_are_told_apart():
    import random

    import pyarrow as pa

    model, rng = licence_scan.model(), random.Random(77)
    texts, labels = model._examples(rng)
    found = {doc: family for doc, _, family, _ in model.judge(pa.array(texts))}
    licences = [i for i, y in enumerate(labels) if y < len(licence_scan.NAMES)]
    right = sum(found.get(i) == model.families[labels[i]] for i in licences)
    wrong = sum(found.get(i, model.families[labels[i]]) != model.families[labels[i]] for i in licences)
    # Damage may take the only word that tells two families apart (Lesser, Affero, NonCommercial).
    assert right >= 0.9 * len(licences) and wrong <= 0.04 * len(licences)
    other = [i for i, y in enumerate(labels) if y == len(licence_scan.NAMES)]
    assert sum(i in found for i in other) <= 0.005 * len(other)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    names = {"GNU General": "gpl", "BY-NC": "cc-by-nc", "MIT Lic": "mit", "Apache Lic": "apache-2.0"}
    for r in QUERIES["op1_licence_scan"](spark, sf).collect():
        expected = {f for n, f in names.items() if n in texts[r.doc_id]}
        assert {f for f in r.families.split(",") if f} == expected, texts[r.doc_id][-200:]

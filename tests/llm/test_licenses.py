import random
import re

import pytest

from stpanel.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    places = [
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    labels, score = {label for _, label in places}, 1.0 if places else 0.0
    for template, label in licenses.TEMPLATES.items():
        wanted = set(template.split())
        reach = len(template.split()) - 1
        needed = -(-len(wanted) * 80 // 100)
        for i, w in enumerate(words):
            if w in wanted:
                found = len(wanted & set(words[max(0, i - reach) : i + reach + 1]))
                if found >= needed:
                    labels.add(label)
                    score = max(score, found / len(wanted))
    starts = [i for i, _ in places]
    base = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), base, ",".join(sorted(labels)), score


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, row int")
    got = licenses.scan(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got), key=key) == sorted(((d, *plain(t)) for d, t in rows), key=key)


ODD = [
    None, "", "cc by", "CC BY-NC 4.0", "licensed under cc-by-nc", "apache license apache license", "mit\nlicense",
    "MIT License. mit license, the MIT-LICENSE", "gnu general public", "K mit license İ", "license mit", "x" * 100_000 + " cc by",
    " ".join(["license"] * 3000), "gnu general public license gnu general public license", "GNU GENERAL public\tlicense cc\x00by",
]


def test_odd_texts(spark):
    check(spark, [(i, t) for i, t in enumerate(ODD)] + [(None, "mit license"), (1, "mit license"), (1, "mit license")])


@pytest.mark.parametrize("seed", range(3))
def test_random_blocks(spark, seed):
    r = random.Random(seed)
    vocabulary = [w for t in [*licenses.PHRASES, *licenses.TEMPLATES] for w in t.split()] + ["the", "of", "été"]
    lines = [*licenses.PHRASES, *licenses.TEMPLATES]

    def text():
        out = []
        for _ in range(r.randint(0, 8)):
            line = r.choice(lines).split()
            if r.random() < 0.5:
                line[r.randrange(len(line))] = r.choice(vocabulary)
            if r.random() < 0.3:
                r.shuffle(line)
            out += [*line, *(r.choice(vocabulary) for _ in range(r.randint(0, 5)))]
        return r.choice([" ", "\n", "--"]).join(out)

    check(spark, [(i, text()) for i in range(120)])


ORIGINALS = {
    "This work is licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under CC BY-SA 4.0.": "cc-by-sa",
    "under a Creative Commons Attribution 4.0 International License.": "cc-by",
    "the GNU Lesser General Public License": "lgpl",
    "the GNU Affero General Public License": "agpl",
    "the Mozilla Public License, v. 2.0": "mpl",
    "the Eclipse Public License 2.0": "epl",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:": "bsd",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
    "the License. You may obtain a copy of the License at": "apache",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation": "gpl",
    "It is hereby released into the public domain.": "public-domain",
}


def test_original_sentences(spark):
    rows = [(i, f"some words before {t} and some words after") for i, t in enumerate(ORIGINALS)]
    check(spark, rows)
    # The Apache header names no phrase here, so only the template can find it.
    header = next(t for t in ORIGINALS if "Apache" in t).replace("Apache License,", "Apache 2.0 License,")
    docs = spark.createDataFrame([*rows, (len(rows), header)], "doc_id long, text string")
    found = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(docs).collect()}
    for i, label in enumerate([*ORIGINALS.values(), "apache"]):
        assert label in found[i]


def test_long_texts(spark):
    """Prose with common template words, and a text of almost nothing else."""
    r = random.Random(3)
    prose = " ".join(r.choice(["the", "of", "a", "in", "you", "not"]) if r.random() < 0.15 else f"w{r.randrange(9000)}" for _ in range(100_000))
    vocabulary = sorted({w for t in [*licenses.PHRASES, *licenses.TEMPLATES] for w in t.split()})
    dense = " ".join(r.choice(vocabulary) if r.random() < 9 / 14 else "x" for _ in range(16_000))
    docs = spark.createDataFrame([(1, prose + " mit license"), (2, dense), (3, "the " * 50_000)], "doc_id long, text string")
    found = {x["doc_id"]: x for x in licenses.scan(docs).collect()}
    assert (found[1]["n_base"], found[1]["first_word"], found[1]["labels"]) == (1, 100_000, "mit")
    assert found[2]["n_words"] == 16_000 and found[3]["labels"] == ""


def test_empty(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(spark, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])

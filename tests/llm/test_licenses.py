"""License scans against a plain search."""

import re

from epochal.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def base(text):
    words = WORD.findall(lower(text))
    places = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(df):
    got = sorted(((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(df).collect()), key=str)
    want = sorted(((str(r.doc_id), *base(r.text)) for r in df.select("doc_id", "text").collect()), key=str)
    assert got == want


def test_documents(docs, sf, spark):
    check(docs)
    check(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet"))


def test_odd(odd, empty):
    check(odd)
    assert licenses.scan(empty).count() == 0


def test_spans(spark):
    rows = [
        (1, "Permission is hereby granted, free of charge, to any persons obtaining a copy of this software and associated documentation files"),
        (2, "under the MIT license and under the mit LICENSE; Apache License, Version 2.0. CC-BY-NC"),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "the mit license alone, and KK under the mİt license"),
        (5, "permission is granted to a person"),
        (6, "cc by nc cc by nc " * 200),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df)
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[1].labels == "mit" and 0.7 < got[1].score < 1 and got[1].n_base == 0
    assert got[2].labels == "apache-2,cc-by-nc,mit" and got[2].score == 1.0 and got[2].n_base == 4
    assert got[3].labels == "gpl-3" and got[3].score == 1.0
    assert got[5].labels == "" and got[5].score < 0.3
    assert got[6].n_base == 400

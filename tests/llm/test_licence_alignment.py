"""Licences with words put in, left out and replaced: the index against an alignment along whole files."""

import random

import numpy as np
import pytest

from stratus.llm.licenses import MATCH, TEMPLATES, Index, index_for, scan
from stratus.llm.licenses import words_of as licence_words

DOCS = "doc_id bigint, text string"


def slow_found(index, ids):
    """Labels by plain edit distances of every template against every end of the file."""
    out = set()
    for t, body in enumerate(index.templates):
        n, edits = len(body), int((1 - MATCH) * len(body) + 1e-9)
        column = list(range(n + 1))
        for e, w in enumerate(ids.tolist()):
            new = [0]
            for i in range(1, n + 1):
                new.append(min(column[i] + 1, new[i - 1] + 1, column[i - 1] + (body[i - 1] != w)))
            column = new
            if column[n] <= edits:
                part = ids[max(0, e + 1 - n - edits) : e + 1].tolist()
                if all(any(part[k : k + len(p)] == p.tolist() for k in range(len(part))) for p in index.required[t]):
                    out.add(index.labels[t])
    return out


def changed(r, body, required, share):
    """About a share of the words edited, none of the mandatory ones."""
    must = set(" ".join(required).split())
    words, out, left = [w.decode() for w in licence_words(body)], [], int(share * len(licence_words(body)))
    for w in words:
        if left and w not in must and r.random() < 2 * share:
            left -= 1
            kind = r.choice("idr")
            out += [w, "inserted"] if kind == "i" else [] if kind == "d" else ["replaced"]
        else:
            out.append(w)
    return " ".join(out)


@pytest.mark.parametrize("seed", range(3))
def test_every_template_is_found_with_words_edited(seed):
    r = random.Random(seed)
    index = Index.of().weighed(np.array([0.0, *(r.random() for _ in Index.of().numbers)]))
    filler = lambda n: " ".join(r.choice(("the", "of", "software", "xq", "zv", "and")) for _ in range(n))
    for label, body, required in TEMPLATES:
        for share in (0.0, 0.1, 0.18):
            text = f"{filler(r.randint(0, 60))} {changed(r, body, required, share)} {filler(r.randint(0, 60))}"
            assert label in {x[0] for x in index.found(index.ids(text))}, (label, share)


def test_labels_are_those_of_an_exhaustive_search():
    r = random.Random(5)
    short = [x for x in TEMPLATES if len(licence_words(x[1])) < 45]
    index = Index.of(short)
    index.weighed(np.array([0.0, *(r.random() for _ in index.numbers)]))
    words = [w.decode() for w in index.numbers] + ["q"] * 20
    some = 0
    for _ in range(150):
        parts = [" ".join(r.choice(words) for _ in range(r.randint(0, 25)))]
        for _ in range(r.randint(1, 3)):
            _, body, required = r.choice(short)
            parts += [changed(r, body, required if r.random() < 0.7 else (), r.choice((0, 0.1, 0.2, 0.25, 0.4))), " ".join(r.choice(words) for _ in range(r.randint(0, 12)))]
        ids = index.ids(" ".join(parts))
        found = {x[0] for x in index.found(ids)}
        assert found == slow_found(index, ids)
        some += bool(found)
    assert 50 < some


def test_one_inserted_word_in_a_notice():
    index = Index.of()
    text = "This program is free software: you can redistribute it and/or modify XX it under the terms of the GNU General Public License as published by the Free Software Foundation"
    assert "gpl" in {x[0] for x in index.found(index.ids(text))}


def test_long_files_nulls_repeats_and_places(spark):
    body = TEMPLATES[5][1]
    long = "the license of software " * 60_000 + body + " and the terms " * 60_000
    rows = [(1, long), (2, body), (2, body), (3, None), (None, ""), (4, (body + " x ") * 30)]
    df = spark.createDataFrame(rows, DOCS)
    got = scan(df, index_for(df)).collect()
    assert len(got) == 6
    for x in got:
        labels = set(x.labels.split(","))
        assert ({"gpl", "gpl-3.0"} <= labels) == (x.doc_id in (1, 2, 4))
    places = {x.doc_id: [m for m in x.matches.split(",") if m.startswith("gpl-3.0@")] for x in got}
    assert places[2] == ["gpl-3.0@0"] and places[1] == ["gpl-3.0@240000"] and len(places[4]) == 30


def test_query_over_the_smallest_tables(spark):
    from stratus.llm.licenses import op8_rare_token_licences

    got = {r.doc_id: r for r in op8_rare_token_licences(spark, "/root/testdata/sf0.001").collect()}
    index = Index.of()
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = index.ids(r.text)
        want = {f[0] for f in index.found(ids)} | {label for phrase, label in index.phrases if len(index.places(ids, phrase))}
        assert set(got[r.doc_id].labels.split(",")) - {""} == want

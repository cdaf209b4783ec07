"""Licences and benchmark passages."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.llm.decontaminate import MIN_MATCH, Items, contaminated, drop_contaminated, words_of
from stratus.llm.licenses import PHRASES, TEMPLATES, Index, index_for, scan
from stratus.llm.licenses import words_of as licence_words

DOCS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"


def slow_tiles(doc, item):
    """Greedy string tiling by trying every pair of places, longest first, then by place in the item and the document."""
    in_doc, in_item = [False] * len(doc), [False] * len(item)
    while True:
        best = None
        for b in range(len(item)):
            for a in range(len(doc)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and not in_doc[a + n] and not in_item[b + n]:
                    n += 1
                if n >= MIN_MATCH and (best is None or n > best[0]):
                    best = (n, b, a)
        if best is None:
            return sum(in_item)
        n, b, a = best
        for k in range(n):
            in_doc[a + k] = in_item[b + k] = True


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("pqrs"), max_size=60), st.lists(st.sampled_from("pqrs"), min_size=MIN_MATCH, max_size=20))
def test_tiles_against_brute_force(doc, item):
    found = Items.of([(1, " ".join(item))]).matches(" ".join(doc))
    assert (found[0][1] if found else 0) == slow_tiles(doc, item)


def test_reordered_and_edited_passages(spark):
    r = random.Random(2)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    items = [words(40) for _ in range(6)]
    around = lambda body: " ".join(words(200) + body + words(200))
    parts = lambda x: x[20:30] + words(3) + x[0:10] + x[30:40] + x[10:20]
    rows = [(0, around(items[0])), (1, around(parts(items[1]))), (2, around(items[2][:10])), (3, around([])), (4, around(items[3][:18] + ["changed"] + items[3][19:])), (5, " ".join(items[4]).upper() + "."), (6, None), (7, ""), (8, "one two")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("item_id", "coverage")})
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(98, None), (99, "too short item"), (0, " ".join(items[0]))], ITEMS)
    got = {(x.doc_id, x.item_id): x for x in contaminated(docs, bench).collect()}
    assert set(got) == {(0, 0), (1, 1), (4, 3), (5, 4)}
    assert got[(0, 0)].coverage == 1.0 and got[(1, 1)].tiles == 4 and got[(1, 1)].matched_words == 40
    clean = drop_contaminated(docs, bench)
    assert sorted(x.doc_id for x in clean.collect()) == [2, 3, 6, 7, 8] and clean.columns == docs.columns


def test_blocks_give_the_same_and_empty_tables_nothing(spark, monkeypatch):
    from stratus.llm import decontaminate

    docs = spark.createDataFrame([(i, f"x{i} " * 3 + f"a{i} b c d e f g{i} h") for i in range(20)], DOCS)
    bench = spark.createDataFrame([(i, f"a{i} b c d e f g{i} h") for i in range(20)], ITEMS)
    whole = sorted(map(tuple, contaminated(docs, bench).collect()))
    blocks = list(decontaminate.blocks(bench, block_bytes=200))
    assert len(blocks) > 1 and sum(len(b.ids) for b in blocks) == 20
    monkeypatch.setattr(decontaminate, "blocks", lambda b: iter(blocks))
    assert sorted(map(tuple, contaminated(docs, bench).collect())) == whole and {r[0] for r in whole} == set(range(20))
    monkeypatch.undo()
    assert contaminated(docs, bench.limit(0)).count() == 0 and drop_contaminated(docs, bench.limit(0)).count() == 20
    assert contaminated(docs.limit(0), bench).count() == 0


def test_a_passage_repeated_many_times(spark):
    item = "q w e r t y u i o p"
    assert Items.of([(1, item)]).matches((item + " ") * 3000) == [(0, 10, 1)]
    assert Items.of([(1, "a a a a a a a a")]).matches("a " * 2000)[0][1] == 8


def slow_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["gnu", "GENERAL", "public", "license", "apache", "cc", "by", "MIT", "é", "x", ",", "CC-BY", "2.0"]), max_size=30), st.sampled_from([" ", "\n", "-", " "]))
def test_base_phrases_against_brute_force(words, gap):
    text = gap.join(words)
    index = Index.of()
    seq = index.ids(text)
    hits = sorted(int(p) for phrase, _ in index.phrases for p in index.places(seq, phrase))
    n, n_base, first, last, _ = slow_licences(text)
    assert (len(seq), len(hits), hits[0] if hits else None, hits[-1] if hits else None) == (n, n_base, first, last)


def test_every_template_is_found_in_a_file_with_changes(spark):
    r = random.Random(4)
    filler = lambda n: " ".join("".join(r.choice("bcdfg") for _ in range(5)) for _ in range(n))
    rows = [(i, f"{filler(80)}\n * {body.upper()}\n{filler(80)}") for i, (_, body, _) in enumerate(TEMPLATES)]
    for i, (_, body, required) in enumerate(TEMPLATES):
        words = body.split()
        free = [k for k, w in enumerate(words) if not set(w.decode() for w in licence_words(w)) & set(" ".join(required).split())]
        if len(words) > 14:
            words[free[0]] = "odd"
            rows.append((100 + i, f"{filler(50)} {' '.join(words)} {filler(50)}"))
    rows += [(200, filler(300)), (201, None), (202, ""), (203, "a license to use this software without restriction"), (203, "a license to use this software without restriction")]
    df = spark.createDataFrame(rows, DOCS).withColumn("labels", F.lit("clash"))
    got = {x.doc_id: x for x in scan(df, index_for(df)).collect()}
    for i, (label, _, _) in enumerate(TEMPLATES):
        assert label in got[i].labels.split(",") and got[i].score >= 0.8, (label, got[i])
        if 100 + i in got:
            assert label in got[100 + i].labels.split(",")
    for k in (200, 201, 202, 203):
        assert (got[k].labels, got[k].score) == ("", 0.0)
    for k, t in rows:
        n, n_base, first, last, labels = slow_licences(t)
        x = got[k]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == (n, n_base, first, last, labels)
        assert set(x.base_labels.split(",")) - {""} <= set(x.labels.split(","))
    assert scan(df.limit(0), index_for(df.limit(0))).count() == 0


def test_several_licences_in_one_file(spark):
    every = " \n ".join(body for _, body, _ in TEMPLATES)
    df = spark.createDataFrame([(1, every), (2, "nothing of the kind")], DOCS)
    got = {x.doc_id: x for x in scan(df, index_for(df)).collect()}
    assert {label for label, _, _ in TEMPLATES} <= set(got[1].labels.split(",")) and got[2].labels == ""


def test_mandatory_phrases_count():
    index = Index.of()
    assert not [f for f in index.found(index.ids("Licensed under the Apache License, Version 3.0")) if f[0] == "apache-2.0"]
    assert [f for f in index.found(index.ids("Licensed under the Apache License, Version 2.0")) if f[0] == "apache-2.0"]


def test_document_frequencies_count_every_document(spark):
    from stratus.llm.licenses import document_frequencies

    df = spark.createDataFrame([(1, "license license"), (2, "License x"), (3, None)], DOCS).repartition(3)
    index = Index.of()
    n, freq = document_frequencies(df, index)
    assert n == 3 and freq[index.numbers[b"license"]] == 2 and freq[index.numbers[b"apache"]] == 0


@pytest.mark.parametrize("text", ["É x", "a\x00b", "Ünï cödé 12", "<tag>", "’s"])
def test_words(text):
    assert [w.decode() for w in licence_words(text)] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    assert [w.decode() for w in words_of(text)] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())

"""Tiles of repetitive texts: the same as by trying every pair of places, within bounds of time and memory."""

import random
import resource
import time

import pytest
from test_scans import DOCS, ITEMS, slow_tiles

from stratus.llm.decontaminate import MIN_MATCH, Items, contaminated, drop_contaminated


@pytest.mark.parametrize("letters", ["p", "pq", "pqr", "pqrstuvw"])
def test_longer_repetitive_texts_against_brute_force(letters):
    r = random.Random(len(letters))
    for _ in range(60):
        period = [r.choice(letters) for _ in range(r.randint(1, 7))]
        item = [r.choice(letters) if r.random() < 0.15 else period[i % len(period)] for i in range(r.randint(MIN_MATCH, 40))]
        doc = [r.choice(letters) if r.random() < 0.1 else period[i % len(period)] for i in range(r.randint(0, 120))]
        found = Items.of([(1, " ".join(item))]).matches(" ".join(doc))
        assert (found[0][1] if found else 0) == slow_tiles(doc, item)


def test_a_share_leaves_out_only_what_cannot_reach_it():
    r = random.Random(9)
    items = [" ".join(r.choice("abcdef") for _ in range(30)) for _ in range(40)]
    block = Items.of(list(enumerate(items)))
    for _ in range(30):
        doc = " ".join(r.choice("abcdef") for _ in range(400))
        every = block.matches(doc)
        for share in (0.3, 0.6, 0.9):
            assert [x for x in block.matches(doc, share) if x[1] >= share * 30] == [x for x in every if x[1] >= share * 30]


def test_a_million_repeated_words_against_periodic_items():
    items = [(k, " ".join((["a"] * (k % 5 + 1) + ["b"]) * 12)) for k in range(50)] + [(100 + k, "a " * (40 + k)) for k in range(50)]
    block = Items.of(items)
    doc = "a " * 1_000_000
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
    found = {k: n for k, n, _ in block.matches(doc, 0.6)}
    # Of the items with a "b" in between, only those with runs of MIN_MATCH words share windows: five of six words.
    assert found == {50 + k: 40 + k for k in range(50)} | {k: 60 for k in range(4, 50, 5)}
    assert time.perf_counter() - began < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000


def test_null_item_ids_and_bytes_that_are_no_text(spark):
    docs = spark.createDataFrame([(1, "x one two three four five six y"), (None, "one two three four five six"), (3, "other")], DOCS)
    bench = spark.createDataFrame([(None, "one two three four five six"), (2, None)], ITEMS)
    assert sorted(((r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()), key=str) == [(1, None), (None, None)]
    assert [r.doc_id for r in drop_contaminated(docs, bench).collect()] == [3]
    raw = b"\xff one two three four five six \xff".hex()
    broken = spark.sql(f"select 5L doc_id, cast(unhex('{raw}') as string) text")
    assert [r.item_id for r in contaminated(broken, bench).collect()] == [None]
    assert drop_contaminated(broken.union(docs.where("doc_id = 3")), bench).count() == 1


def test_documents_dropped_block_by_block(spark, monkeypatch):
    from stratus.llm import decontaminate

    docs = spark.createDataFrame([(i, f"x{i} y " * 3 + (f"a{i} b c d e f g{i} h" if i % 3 else "nothing here")) for i in range(12)], DOCS)
    bench = spark.createDataFrame([(i, f"a{i} b c d e f g{i} h") for i in range(12)], ITEMS)
    blocks = list(decontaminate.blocks(bench, block_bytes=100))
    assert len(blocks) > 2
    monkeypatch.setattr(decontaminate, "blocks", lambda b: iter(blocks))
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench).collect()) == [0, 3, 6, 9]
    assert {r.doc_id for r in contaminated(docs, bench).collect()} == {1, 2, 4, 5, 7, 8, 10, 11}

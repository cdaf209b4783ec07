import random

import corpus_pipeline
from pyspark.sql import functions as F

from stratus.llm import neardup
from stratus.llm.neardup import drop_near_duplicates

COLUMNS = "doc_id bigint, text string, lang string"


def slow_set(text):
    words = (text or "").lower().split()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def slow_kept(texts):
    """Least index of each component of the texts with similarity 0.8 or more."""
    sets, root = [slow_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for j, b in enumerate(sets):
        for i, a in enumerate(sets[:j]):
            if len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in root}


def edited(r, body, n):
    out = list(body)
    for i in r.sample(range(len(out)), n):
        out[i] = f"new{r.randrange(10**6)}"
    return out


def test_near_copies_that_differ_by_several_words(spark):
    r = random.Random(4)
    texts = []
    for _ in range(60):
        body = [f"w{r.randrange(3000)}" for _ in range(r.choice((4, 40, 200, 400)))]
        texts += [" ".join(body), " ".join(body).upper()]
        texts += [" ".join(edited(r, body, k)) for k in range(1, 9) if k < len(body) / 10]
    texts += [None, "", " \n", "one", "One", "one two"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], COLUMNS).repartition(5)
    want = slow_kept(texts)
    assert {x.doc_id for x in corpus_pipeline.near_duplicate_stage(spark, df, "").collect()} == want
    assert len(want) < 200


def test_large_buckets_link_across_heads(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HEADS", 3)
    monkeypatch.setattr(neardup, "ROUND_HEADS", 30)
    r = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    texts, chain = [], base
    for _ in range(40):
        chain = edited(r, chain, 3)
        texts.append(" ".join(chain))
    texts += [" ".join(edited(r, base, r.choice((1, 5, 9, 14)))) for _ in range(40)]
    r.shuffle(texts)
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], COLUMNS)
    assert {x.doc_id for x in drop_near_duplicates(df).collect()} == slow_kept(texts)


def test_rounds_bounded_by_bytes_link_the_same(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HEADS", 3)
    monkeypatch.setattr(neardup, "HEAD_BYTES", 5000)
    r = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(edited(r, base, r.choice((1, 4, 7, 10)))) for _ in range(16)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], COLUMNS)
    assert {x.doc_id for x in drop_near_duplicates(df).collect()} == slow_kept(texts)


def test_one_row_of_each_group_stays(spark):
    copy = "a b c d e f g"
    rows = [(7, copy, "en"), (7, copy, "en"), (7, copy, "de"), (None, copy, "en"), (9, copy.upper(), "en"), (None, "q", None), (None, "q", "de"), (None, None, "q"), (4, None, None), (4, "r s", "en")] + [(3, "t", "en")] * 5
    df = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit("clash") for c in ("row", "class", "bands", "n")}).repartition(4)
    out = drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((str(x.doc_id), str(x.text)) for x in out.collect()) == sorted([("7", copy), ("None", "q"), ("4", "None"), ("4", "r s"), ("3", "t")])
    assert drop_near_duplicates(df.limit(0)).count() == 0


def test_a_column_may_have_the_row_hashs_name(spark):
    df = spark.createDataFrame([(1, "a b c", "kept"), (2, "a b c", "gone"), (3, "x", None)], "doc_id bigint, text string, __row string")
    assert sorted((r.doc_id, r["__row"]) for r in drop_near_duplicates(df).collect()) == [(1, "kept"), (3, None)]


def test_classes_of_many_rows_go_by_broadcast(spark, monkeypatch):
    from stratus.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 3)
    rows = [(i, ("same text of five words", "another text of six words here", f"own {i}")[min(i % 4, 2)], "en") for i in range(60)] + [(None, "same text of five words", "en")] * 5
    kept = sorted((str(r.doc_id), r.text) for r in drop_near_duplicates(spark.createDataFrame(rows, COLUMNS)).collect())
    assert kept == sorted([("0", "same text of five words"), ("1", "another text of six words here"), *((str(i), f"own {i}") for i in range(60) if i % 4 > 1)])


def test_candidates_come_from_fingerprints_too(spark, monkeypatch):
    """Without any band in common copies that differ in few bits are found by multi-index SimHash, and unlike texts with equal bits are told apart."""
    r = random.Random(8)
    base = [r.choice("abcdefghijklmnopqrstuvwxyz") * r.randrange(1, 9) + str(r.randrange(10**6)) for _ in range(4000)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(["other", *base[1:]])), (3, " ".join(reversed(base)))], "doc_id bigint, text string")
    rows = neardup._sketches(docs, "doc_id", "text").withColumn("bands", F.array().cast("array<bigint>"))
    classes = rows.select("class", "row", "fp", "bands")
    fps = {x.doc_id: x.fp & (2**64 - 1) for x in rows.collect()}
    assert bin(fps[1] ^ fps[2]).count("1") <= 2
    of = {x.doc_id: x["class"] for x in rows.collect()}
    roots = {x.node: x.root for x in neardup.links(docs, classes).collect()}
    assert roots == {of[1]: min(of[1], of[2]), of[2]: min(of[1], of[2])}
    same = classes.withColumn("fp", F.lit(5).cast("bigint"))
    assert {(min(x.a, x.b), max(x.a, x.b)) for x in neardup.by_fingerprint(same).collect()} == {(min(of.values()), c) for c in of.values() if c != min(of.values())}
    assert {x.node for x in neardup.links(docs, same).collect()} <= {of[1], of[2]}

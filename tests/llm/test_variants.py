"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratus.llm import variants
from stratus.llm.variants import chain_ends, forms, near_pairs, one_edit, word_of, words

DOCS = "doc_id bigint, text string"


def slow_words(docs):
    out = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_forms(counts):
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, of in near.items():
        best = min(of, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def dense(seed, n, letters="abc", lengths=(6, 7, 8)):
    r = random.Random(seed)
    return sorted({"".join(r.choice(letters) for _ in range(r.choice(lengths))) for _ in range(n)})


@pytest.mark.parametrize("seed, n, letters", [(1, 900, "ab"), (2, 700, "abc"), (3, 400, "aé÷z")])
@pytest.mark.parametrize("hot", [False, True])
def test_every_one_edit_pair_is_met(spark, monkeypatch, seed, n, letters, hot):
    if hot:
        monkeypatch.setattr(variants, "HOT_LEAST", 20)
    held = dense(seed, n, letters, (6, 7, 8, 12)) + ["a" * k for k in (6, 7, 8, 9, 300, 301)] + ["b" + "a" * 300]
    held = sorted(set(held))
    df = spark.createDataFrame(list(enumerate(held)), "id bigint, word string")
    found = [(r.a, r.b) for r in near_pairs(df).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(i, j) for i, a in enumerate(held) for j, b in enumerate(held) if is_near(a, b)}


def test_light_edges_are_few(spark):
    held = dense(7, 3000, "abcdef", (6, 7, 8, 9))
    df = spark.createDataFrame(list(enumerate(held)), "id bigint, word string")
    most = variants.light_edges(df, variants.heavy_children(df)).groupBy("id").count().agg(F.max("count")).first()[0]
    assert most <= len(held).bit_length()


def test_one_edit_on_texts(spark):
    held = ["", "a", "b", "ab", "ba", "aab", "abb", "abc", "axc", "éb", "éab", "\U0001d518ab", "ab\U0001d518"]
    pairs = [(a, b) for a in held for b in held]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert all(r.e == is_near(r.a, r.b) for r in df.select("a", "b", one_edit(F.col("a"), F.col("b")).alias("e")).collect())


def sample_documents(seed=11):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdefghéß") for _ in range(r.randrange(5, 11))) for _ in range(60)]
    docs = []
    for i in range(260):
        body = []
        for _ in range(90):
            w = base[min(int(r.expovariate(0.08)), 59)]
            if r.random() < 0.12:
                k = r.randrange(len(w))
                w = r.choice((w[:k] + w[k + 1 :], w[:k] + "x" + w[k + 1 :], w[:k] + "x" + w[k:]))
            body.append(r.choice((w, w.capitalize(), w.upper())))
        docs.append((i, r.choice((" ", ", ", "1")).join(body)))
    return docs


def test_documents_against_brute_force(spark):
    docs = sample_documents()
    docs += [(None, docs[0][1]), (None, None), (3, ""), docs[5], docs[5]]
    counts = slow_words(docs)
    df = spark.createDataFrame(docs, DOCS).select("*", F.lit(1).alias("n"), F.lit("x").alias("word"), F.lit(2).alias("id"))
    assert {r.word: r.n for r in words(df).collect()} == counts
    want = slow_forms(counts)
    assert got(forms(words(df))) == want
    assert sum(w[1] is not None for w in want) > 20 and len({w[2] for w in want}) > 10


def test_the_query_agrees_with_its_sql(spark):
    import duckdb

    from stratus.llm.queries import oracle_sql

    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(oracle_sql()["op12_errata_trie_variants"]).fetchall()
    rows = [tuple(r) for r in variants.op12_errata_trie_variants(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr) and len(rows) > 500


def test_damage_takes_one_character():
    struck = [(k, w) for k in range(4000) for w in ("example",) if zlib.crc32(f"{k}:{w}".encode()) % 199 == 0]
    assert struck and all(is_near(word_of(w, k), w) for k, w in struck) and word_of("example", 0) == "example"


def test_chains_and_ties(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "zzzzzz": 5, "zzzzzx": 40, "zzzzzy": 40, "single": 9}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert got(forms(df)) == slow_forms(counts)
    steps = spark.createDataFrame([(i, i + 1) for i in range(27)], "id bigint, to bigint")
    assert {r.to for r in chain_ends(steps).collect()} == {27}


def test_empty_and_very_long(spark):
    assert got(forms(words(spark.createDataFrame([], DOCS)))) == []
    long = "ab" * 40_000
    docs = [(i, long if i % 2 else long + "c") for i in range(1, 13)]
    counts = slow_words(docs)
    assert len(counts) == 2 and got(forms(words(spark.createDataFrame(docs, DOCS)))) == slow_forms(counts)

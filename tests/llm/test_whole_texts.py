"""What a text gives does not depend on where it is cut or how long it is."""

import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.llm import langid, pii


def slow_grams(text):
    c = [ord(x) for x in " " + re.sub(r"[\W\d_]+", " ", text.lower()) + " "]
    m = (1 << 32) - 1
    out = np.zeros(langid.BUCKETS, dtype=np.int64)
    pair = lambda a, b: (a * 0x9E3779B1 + b * 0x85EBCA77 + 0x27D4EB2F) & m
    for i, x in enumerate(c):
        out[(x * 0x2C1B3C6D & m) >> 18] += 1
        if i + 1 < len(c):
            out[pair(x, c[i + 1]) >> 18] += 1
        if i + 2 < len(c):
            out[((pair(x, c[i + 1]) * 0xC2B2AE3D + c[i + 2] * 0x165667B1) & m) >> 18] += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aBcΣσ 1_.é-\n"), min_size=1, max_size=60), st.integers(1, 70))
def test_grams_of_windows_are_those_of_the_whole(text, window):
    old = langid.WINDOW
    try:
        whole = langid.gram_counts(text)
        langid.WINDOW = window
        assert (langid.gram_counts(text) == whole).all() and (whole == slow_grams(text)).all()
    finally:
        langid.WINDOW = old


def test_document_frequencies_and_plain_steps(spark):
    """The counts over all learnable documents, and one pass of the learner, against plain versions."""
    rows = [(i, ("the and of " if i % 3 else "und der die ") * (i % 4 + 1), "en" if i % 3 else "de") for i in range(60)] + [(None, "x", "en"), (4, None, "en"), (5, "q", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    usable = [(i, t) for i, t, lang in rows if i is not None and lang and t and zlib.crc32(str(i).encode()) % 4 != 2]
    n, df = langid.document_frequencies(docs)
    assert n == len(usable) and (df == sum((slow_grams(t) > 0).astype(int) for _, t in usable)).all()
    idf = langid.inverse_frequencies(n, df)
    train = sorted(langid.training_rows(docs, 40), key=lambda r: r[2])
    model = langid.fit(train, idf)
    # Plain follow-the-regularised-leader, coordinate by coordinate.
    labels = sorted({r[2] for r in train})
    z, q = {}, {}
    bz, bq = [0.0] * 2, [0.0] * 2

    def weight(zz, qq, l1=langid.L1):
        return 0.0 if abs(zz) <= l1 else -(zz - np.sign(zz) * l1) / ((langid.BETA + qq**0.5) / langid.ALPHA + langid.L2)

    data = [({int(b): c / counts.sum() * idf[b] * langid.SCALE / 10 for b, c in zip(buckets, counts, strict=True)}, labels.index(lang)) for buckets, counts, lang in train]
    for _ in range(langid.EPOCHS):
        for i, (x, y) in enumerate(data):
            if i % 5 == 0:
                continue
            w = {b: [weight(z.get((b, k), 0.0), q.get((b, k), 0.0)) for k in range(2)] for b in x}
            bias = [weight(bz[k], bq[k], 0.0) for k in range(2)]
            s = [sum(x[b] * w[b][k] for b in x) + bias[k] for k in range(2)]
            p = [np.exp(v - max(s)) for v in s]
            for k in range(2):
                g = p[k] / sum(p) - (k == y)
                for b in x:
                    step, old = x[b] * g, q.get((b, k), 0.0)
                    z[b, k] = z.get((b, k), 0.0) + step - ((old + step**2) ** 0.5 - old**0.5) / langid.ALPHA * w[b][k]
                    q[b, k] = old + step**2
                bz[k] += g - ((bq[k] + g**2) ** 0.5 - bq[k] ** 0.5) / langid.ALPHA * bias[k]
                bq[k] += g**2
    for b in {b for x, _ in data for b in x}:
        for k in range(2):
            assert model.weights[b, k] == pytest.approx(weight(z.get((b, k), 0.0), q.get((b, k), 0.0)) * idf[b] * langid.SCALE / 10, abs=1e-9)
    assert model.bias == pytest.approx([weight(bz[k], bq[k], 0.0) for k in range(2)], abs=1e-9)


def test_every_language_has_its_share(spark):
    from stratus.llm.common import least_hashes_of_each

    rows = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") % 1000 == 0, "rare").when(F.col("id") % 3 == 0, "some").otherwise("hot").alias("v"))
    got = least_hashes_of_each(rows.union(rows.where("v = 'hot'")), "k", "v", 90).collect()
    for v, n in (("rare", 20), ("some", 30), ("hot", 30)):
        want = [r.k for r in rows.where(F.col("v") == v).orderBy(F.xxhash64("k"), "k").limit(n).collect()]
        assert sorted(r.k for r in got if r.v == v) == sorted(want)
    same = spark.range(20_000).select((F.col("id") % 40).alias("k"), F.lit("v").alias("v"))
    assert sorted(r.k for r in least_hashes_of_each(same, "k", "v", 30).collect()) == sorted(r.k for r in same.distinct().orderBy(F.xxhash64("k"), "k").limit(30).collect())
    assert least_hashes_of_each(rows.limit(0), "k", "v", 5).count() == 0


def test_shapes_see_whole_tokens():
    long = "x." * 200
    assert pii.shape(long + "555-123-4567") == "a." * 200 + "d3-d3-d4"
    assert pii.shape(long + "@mail.org") == "a." * 200 + "@a.a"
    names = [set(f) for f in pii.features([long + "1", long + "@a"])]
    assert names[0] != names[1]


def test_long_tokens_and_texts():
    crf = pii.train()
    filler = "w1 " * 60_000
    text = filler + "call 212-555-0199 or jane(at)host.org now " + "y" * 300_000 + " mail a@b.com"
    base, every = pii.spans_of([text], crf)[0]
    assert [text[a:b] for _, a, b in base] == ["a@b.com"] and {"212-555-0199", "jane(at)host.org"} <= {text[a:b] for _, a, b in every}

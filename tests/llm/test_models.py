"""Quality and language: learned from small tables, judged on what was held out."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import langid, quality

DATA = "/root/testdata/sf0.01"


def test_trees_learn_a_rule_and_the_arrays_agree_with_a_walk():
    r = np.random.default_rng(0)
    x = r.normal(size=(1200, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.5)).astype(float)
    t = quality.fit(x[:800], y[:800], trees=40)
    assert ((t.predict(x[800:]) >= 0.5) == y[800:]).mean() > 0.93

    def walk(row):
        total = t.base
        for f, th, v in zip(t.feature, t.threshold, t.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > th[node])
            total += v[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(t.predict(x[:50]), [walk(row) for row in x[:50]])


def test_trees_without_two_classes():
    assert quality.fit(np.zeros((0, 3)), np.zeros(0)).predict(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (quality.fit(np.zeros((5, 3)), np.ones(5)).predict(np.zeros((2, 3))) > 0.5).all()
    assert quality.fit(np.zeros((5, 3)), np.ones(5)).predict(np.zeros((0, 3))).shape == (0,)


def test_statistics_of_odd_texts():
    for t in (None, "", " \n ", "x", "\n\n", "é", "a" * 100_000, " "):
        row = quality.statistics(t)
        assert len(row) == len(quality.FEATURES) and np.isfinite(row).all()


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.score(docs.withColumn("score", F.lit("clash")), quality.classifier(docs, labels)).join(labels, "doc_id").toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95
    assert ((got.score >= 0.5).astype(int) == got.predicted).all() and got.score.between(0, 1).all()


def test_labels_that_are_held_out_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.training_rows(docs, labels, 100), quality.training_rows(docs, turned, 100)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and len(a[1]) == 100


def test_least_hashes_against_a_sort_of_all(spark):
    from stratus.llm.common import least_hashes

    rows = spark.range(5000).select((F.col("id") % 3000).alias("k"), (F.col("id") % 2).alias("v"))
    for bound in (1, 7, 100, 10_000):
        want = rows.distinct().orderBy(F.xxhash64("k"), "k", "v").limit(bound).collect()
        assert least_hashes(rows, "k", bound).collect() == want
    hot = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    assert least_hashes(hot, "k", 50).collect() == hot.distinct().orderBy(F.xxhash64("k"), "k").limit(50).collect()
    assert least_hashes(rows.limit(0), "k", 5).count() == 0


def test_repeated_documents_are_learned_from_once(spark):
    """Documents 1 and 8 are held out of neither training."""
    docs = spark.createDataFrame([(1, "one text", "en")] * 400 + [(1, "another", "en"), (8, "ein", "de")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (8, 0)], "doc_id bigint, quality int")
    assert sorted(r[2] for r in langid.training_rows(docs)) == ["de", "en"]
    x, y = quality.training_rows(docs, labels)
    assert y.tolist() == [0, 1, 0] and x[0].tolist() == x[1].tolist() == min(quality.statistics("one text"), quality.statistics("another"))


def test_quality_with_nulls_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "good words here"), (1, "good words here"), (2, None), (None, ""), (3, "a" * 50_000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 0)], "doc_id bigint, quality int")
    trees = quality.classifier(docs, labels)
    rows = quality.score(docs, trees).collect()
    assert len(rows) == 5 and len({r.score for r in rows if r.doc_id == 1}) == 1
    assert quality.keep(docs, trees, at_least=0.0).count() == 5 and quality.keep(docs, trees, at_least=1.1).count() == 0
    assert quality.score(docs.limit(0), quality.classifier(docs.limit(0), labels)).count() == 0
    assert quality.keep(docs.limit(0), trees).columns == docs.columns


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.fit(langid.training_rows(docs, 400))
    assert (model.weights == 0).mean() > 0.3
    got = langid.identify(docs.withColumn("lang_pred", F.lit("clash")), model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert abs(held.score.mean() - (held.lang_pred == held.lang).mean()) < 0.05


def test_language_of_odd_texts(spark):
    train = [(i, "the and of that " * 20 if i % 2 else "der und die ein " * 20, "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(train, "doc_id bigint, text string, lang string")
    model = langid.fit(langid.training_rows(docs))
    texts = [None, "", "123 !!", "the and of", "und die der", "The AND of " * 200_000]
    assert model.predict(texts)[0] == ["und", "und", "und", "en", "de", "en"]
    assert model.predict([None])[1] == [0.0]
    odd = spark.createDataFrame([(None, None), (2, "the of"), (2, "the of"), (3, "")], "doc_id bigint, text string")
    assert langid.identify(odd, model).count() == 4
    nobody = langid.fit(langid.training_rows(docs.where("false")))
    assert nobody.predict(["the"]) == (["und"], [0.0])
    assert langid.identify(odd.limit(0), model).count() == 0


@pytest.mark.parametrize("lang", [None])
def test_documents_without_a_language_teach_nothing(spark, lang):
    docs = spark.createDataFrame([(1, "the", lang), (3, "and", "en")], "doc_id bigint, text string, lang string")
    assert {r[2] for r in langid.training_rows(docs)} <= {"en"}


def test_windows_cover_the_whole_text(monkeypatch):
    text = "abc def" * 50
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "WINDOW", 64)
    parts = langid.gram_counts(text)
    assert (parts >= 0).all() and ((parts > 0) | (whole == 0)).all()

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from stratus.llm import decontaminate, packing, pii, quality

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def five_word_shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(base / name))
        after = spark.read.parquet(str(base / name))
        out.append((name, docs, after))
        docs = after
    return out


def test_order_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    assert all(after.columns == COLUMNS for _, _, after in stages[:-1])


def test_each_stage_against_brute_force(spark, stages):
    step = {n: (b.toPandas(), a.toPandas(), b) for n, b, a in stages}
    before, after, docs = step["quality"]
    trees = quality.classifier(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert set(after.doc_id) == {i for i, p in zip(before.doc_id, trees.predict(quality.matrix(list(before.text))), strict=True) if p >= 0.5}

    before, after, _ = step["near_duplicates"]
    sets = {i: five_word_shingles(t) for i, t in zip(before.doc_id, before.text, strict=True)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if a < b else 0
            if a < b and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(after.doc_id) == {i for i in sets if find(i) == i} and len(after) < len(before)

    before, after, _ = step["decontamination"]
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").toPandas()
    whole = [" ".join(w.decode() for w in decontaminate.words_of(t)) for t in items.text]
    held = {i for i, t in zip(before.doc_id, before.text, strict=True) if any(x in " ".join(w.decode() for w in decontaminate.words_of(t)) for x in whole)}
    assert held and not held & set(after.doc_id) and set(after.doc_id) | held == set(before.doc_id)

    before, after, _ = step["pii"]
    assert list(before.doc_id) == list(after.doc_id) and not any(pii.base_spans(t) for t in after.text)
    assert all(n == len(t) for n, t in zip(after.n_chars, after.text, strict=True))
    changed = sum(a != b for a, b in zip(before.text, after.text, strict=True))
    assert changed == sum(bool(every) for _, every in pii.spans_of(list(before.text), pii.train()))

    before, after, _ = step["packing"]
    assert after.groupby("doc_id").length.sum().to_dict() == {i: len(packing.token_ids(t)) for i, t in zip(before.doc_id, before.text, strict=True)}


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, DATA)
    assert got.count() == stages[-1][2].count() and corpus_pipeline.ORACLE_SQL is None


LONG = "long words of every kind " * 40_000


@pytest.mark.parametrize(
    "rows, kept",
    [
        ([], []),
        ([(1, None, None, None, None), (None, "", None, None, 0), (2, "x", "en", "s", 1), (2, "x", "en", "s", 1), (3, LONG, "en", "s", len(LONG)), (4, LONG, None, None, None)], [1, 2, 3]),
    ],
)
def test_odd_tables_pass_through_every_stage(spark, tmp_path, rows, kept):
    """Label 1 alone is learned, so that no document goes for its quality; columns of other names, some clashing, are carried along."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ("fingerprint", "class", "row", "bands", "spans", "item_id", "bin", "__n")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(set(got.doc_id.dropna())) == kept
    texts = {i: t for i, t, *_ in rows}
    lengths = got.groupby("doc_id").length.sum().to_dict()
    assert lengths == {i: len(packing.token_ids(texts[i])) for i in kept} and got.groupby("sequence_id").length.sum().le(packing.CAPACITY).all()


def test_a_missing_shared_folder_is_refused_on_clusters():
    from types import SimpleNamespace

    from stratus.llm.common import shared_folder

    def fake(master, folder=None, checkpoint=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint))

    assert shared_folder(fake("yarn", "hdfs://x/y")) == "hdfs://x/y" and shared_folder(fake("yarn", None, "s3://z")) == "s3://z"
    assert shared_folder(fake("local[2]"))
    with pytest.raises(RuntimeError):
        shared_folder(fake("spark://host:7077"))

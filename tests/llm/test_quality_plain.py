"""The quality classifier against plain versions: the statistics, and the splits and leaves of the trees."""

import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratus.llm import quality


def slow_statistics(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x09-\x0d\x20]+", raw)
    if not words:
        return dict.fromkeys(quality.FEATURES, 0.0)
    n, m = len(raw), len(words)
    lines = [x for x in raw.split(b"\n") if x]
    kinds = {"space": 0, "digit": 0, "upper": 0, "lower": 0, "high": 0, "punct": 0}
    for c in raw:
        kind = "high" if c >= 128 else "space" if chr(c) in "\t\n\x0b\x0c\r " else "digit" if chr(c).isdigit() else "upper" if chr(c).isupper() else "lower" if chr(c).islower() else "punct"
        kinds[kind] += 1
    letters = max(1, kinds["lower"] + kinds["upper"] + kinds["high"])
    punct = lambda c: c < 128 and not chr(c).isalnum() and chr(c) not in "\t\n\x0b\x0c\r "
    return {
        "log_bytes": math.log1p(n), "log_words": math.log1p(m), "word_bytes": sum(map(len, words)) / m, "upper": kinds["upper"] / letters, "digit": kinds["digit"] / n, "punct": kinds["punct"] / n,
        "high": kinds["high"] / n, "space": kinds["space"] / n, "lines": math.log1p(len(lines)), "line_bytes": n / len(lines), "repeated_lines": 1 - len(set(lines)) / len(lines),
        "distinct_words": len(set(words)) / m, "top_word": max(words.count(w) for w in set(words)) / m, "adjacent_same": sum(a == b for a, b in zip(words, words[1:], strict=False)) / (m - 1) if m > 1 else 0.0,
        "doubled_punct": sum(punct(b) and a == b for a, b in zip(raw, raw[1:], strict=False)) / m, "double_bang": raw.count(b"!!") / m, "pipe": raw.count(b"|") / m, "sentence_end": (raw.count(b".") + raw.count(b"?")) / m,
        "long_words": sum(len(w) > 20 for w in words) / m, "short_words": sum(len(w) < 3 for w in words) / m, "top_line_words": max(map(len, lines)) / n, "upper_lines": sum(len(x) for x in lines if x.isupper()) / n, "punct_words": kinds["punct"] / m,
    }


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB1 .!|?\n\té\x1f\x0b"), max_size=60))
def test_statistics_against_plain_counts(text):
    assert quality.statistics(text) == pytest.approx(list(slow_statistics(text).values()), abs=1e-12)


def test_a_tree_against_a_search_of_all_splits():
    r = np.random.default_rng(4)
    x = np.round(r.normal(size=(300, 3)), 1)
    y = ((x[:, 0] > 0.2) & (x[:, 1] < 0.5)).astype(float)
    depth = 2
    got = quality.fit(x, y, trees=3, depth=depth)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality.BINS + 1)[1:-1])) for j in range(3)]
    score = np.full(len(x), got.base)
    assert got.base == pytest.approx(math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    for t in range(3):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        rows = {0: np.arange(len(x))}
        for node in range((1 << depth) - 1):
            own = rows[node]
            best, gain_of_chosen = 0.0, 0.0
            for j in range(3):
                for e in edges[j]:
                    left = own[x[own, j] <= e]
                    right = own[x[own, j] > e]
                    if h[left].sum() < quality.MIN_CHILD / 10 or h[right].sum() < quality.MIN_CHILD / 10:
                        continue
                    value = lambda k: g[k].sum() ** 2 / (h[k].sum() + quality.L2)
                    gain = value(left) + value(right) - value(own)
                    best = max(best, gain)
                    if j == got.feature[t, node] and e == got.threshold[t, node]:
                        gain_of_chosen = gain
            assert gain_of_chosen == pytest.approx(best, abs=1e-9)
            goes = x[own, got.feature[t, node]] > got.threshold[t, node]
            rows[2 * node + 1], rows[2 * node + 2] = own[~goes], own[goes]
        for k in range(1 << depth):
            own = rows[(1 << depth) - 1 + k]
            assert got.value[t, k] == pytest.approx(-quality.RATE * g[own].sum() / (h[own].sum() + quality.L2))
            score[own] += got.value[t, k]


@pytest.mark.parametrize("name", ["op1_virtual_slots", "op2_longest_match_tokens", "op4_cost_balanced_packing", "op5_crf_pii", "op6_multi_index_simhash", "op7_boosted_quality", "op9_greedy_tiling", "op10_ftrl_language"])
def test_every_query_runs_over_whole_tables(spark, name):
    from stratus.llm import queries

    data = "/root/testdata/sf0.001"
    got, n = queries.queries()[name](spark, data), spark.read.parquet(f"{data}/documents.parquet").count()
    rows = got.count()
    assert got.columns[0] == "doc_id" and (rows == n or name in ("op4_cost_balanced_packing", "op9_greedy_tiling") and rows > 0)

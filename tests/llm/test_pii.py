import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.llm.pii import KINDS, LABELS, as_string, base_spans, find, labelled_table, luhn, masked, redact, spans_of, train

DOCS = "doc_id bigint, text string, n_chars bigint"


@pytest.fixture(scope="module")
def crf():
    return train()


def slow_base(text):
    """The stated patterns by finditer alone."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("ab1209.@+-() %é"), max_size=60))
def test_base_against_plain_patterns(text):
    assert base_spans(text) == slow_base(text)


@pytest.mark.parametrize("text", ["a@b.co@d.ef x.y@z.com", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.004", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (499) 555-6503. +12", "so.19@mail5.example.com!!", "@@a@b.c", "1234567890123456789012", "a@b a@b.c.", "5" * 5000 + "." + "a@" * 3000])
def test_base_cases(text):
    assert base_spans(text) == slow_base(text)


def test_field_fits_its_table_and_a_new_filling(crf):
    for rows in (labelled_table(), labelled_table(3, seed=99)):
        right = total = 0
        for labels, (_, gold) in zip(crf.decode([t for t, _ in rows]), rows, strict=True):
            right += int((labels == gold).sum())
            total += len(gold)
        assert right / total > 0.97


def test_viterbi_against_every_labelling(crf):
    from itertools import product

    for tokens in (["call", "(743)", "555-3824"], ["x@y.com", "or", "1.2.3.4"], ["5"]):
        e, _ = crf.scores([tokens])

        def value(path):
            full = (0, *path, 0)
            return sum(e[0, i, y] for i, y in enumerate(path)) + sum(crf.transition[a, b] for a, b in zip(full, full[1:], strict=False))

        best = max(product(range(len(LABELS)), repeat=len(tokens)), key=value)
        assert tuple(crf.decode([tokens])[0]) == best


def test_field_adds_what_patterns_miss(crf):
    texts = ["call (743) 555-3824 now", "ring 212-555-0199 today", "write jane(at)host.org soon"]
    added = [[(k, t[a:b]) for k, a, b in every if (k, a, b) not in base] for t, (base, every) in zip(texts, spans_of(texts, crf), strict=True)]
    assert added == [[("phone", "(743) 555-3824")], [("phone", "212-555-0199")], [("email", "jane(at)host.org")]]


@pytest.mark.parametrize("text", ["", "plain words only, and more.", "on 2023-10-12 at 10:30 version 2.0.1 cost 1,234,567", "Licensed under CC BY-NC 4.0.", "order 12345678 isbn 978-3-1614-8410-0", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "by @name 3.14159265358979 in 1999"])
def test_clean_texts_stay_clean(crf, text):
    assert spans_of([text], crf) == [([], [])]


def test_batches_do_not_matter(crf):
    texts = ["call (743) 555-3824 now", None, "a " * 5000 + "x 4111.1111.1111.1111 y", "1 " * 3000, "mail a@b.com"] * 3
    together = spans_of(texts, crf)
    assert together == [spans_of([t], crf)[0] for t in texts]
    assert all(set(base) <= set(every) for base, every in together)


def test_masking():
    assert masked("ab cd ef", [("email", 3, 5)]) == "ab <EMAIL> ef"
    assert masked("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a<IP>f"
    assert masked("abc", []) == "abc"


def test_find_and_redact(spark, crf):
    rows = [(1, "mail a@b.com or 1.2.3.4", 23), (2, None, None), (3, "", 0), (None, "clean", 5), (1, "mail a@b.com or 1.2.3.4", 23)]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("spans", "n_email")})
    got = find(df, crf).collect()
    assert len(got) == 5 and sum(r.n_email for r in got) == 2 and sum(r.n_ip for r in got) == 2
    r = next(r for r in got if r.doc_id == 1)
    assert r.spans == "email:5:12,ip:16:23" and as_string([(k, 0, 1) for k in KINDS]) == "email:0:1,ip:0:1,card:0:1,phone:0:1"
    out = redact(df, crf, n_chars="n_chars")
    assert out.columns == df.columns
    assert sorted(((x.text or "", x.n_chars) for x in out.collect()), key=str) == sorted([("mail <EMAIL> or <IP>", 20), ("mail <EMAIL> or <IP>", 20), ("", None), ("", 0), ("clean", 5)], key=str)
    assert find(df.limit(0), crf).count() == 0 and redact(df.limit(0), crf).count() == 0

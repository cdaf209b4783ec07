import re

import pytest

from stratus.llm.pii import pieces, spans_of, train


@pytest.fixture(scope="module")
def crf():
    return train()


@pytest.mark.parametrize(
    "kind, found",
    [
        ("phone", ["212-555-0199", "212-555-0142"]),
        ("phone", ["212-555-0199", "646-555-0142", "718-555-0111", "917-555-0123"]),
        ("phone", ["(212) 555-0199", "(646) 555-0142", "(718) 555-0111"]),
        ("phone", ["+1 (499) 555-6503", "212-555-0142"]),
        ("card", ["4111.1111.1111.1111", "5500.0000.0000.0004", "4012.8888.8888.1881"]),
    ],
)
@pytest.mark.parametrize("gap", ["\n", "\t", "\r\n"])
def test_neighbours_of_one_kind_are_all_found(crf, kind, found, gap):
    text = "call " + gap.join(found) + " now"
    assert [(k, text[a:b]) for k, a, b in spans_of([text], crf)[0][1]] == [(kind, x) for x in found]


def test_a_rejected_run_of_addresses_is_split():
    text = "fe80:12ab:34cd:56ef:78ab:90cd:12ef:34ab\n2001:0db8:85a3:08d3:1319:8a2e:0370:7344"
    assert [text[a:b] for a, b in pieces("ip", text, [m.span() for m in re.finditer(r"\S+", text)])] == text.split()


def test_cards_written_digit_by_digit():
    cards = ["4 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1", "5 - 5 - 0 - 0 - 0 - 0 - 0 - 0 - 0 - 0 - 0 - 0 - 0 - 0 - 0 - 4"]
    text = "\n".join(cards)
    assert [text[a:b] for a, b in pieces("card", text, [m.span() for m in re.finditer(r"\S+", text)])] == cards


def test_a_run_of_address_labels_with_words_in_it_is_no_address():
    text = "one two a@b three four"
    assert [text[a:b] for a, b in pieces("email", text, [m.span() for m in re.finditer(r"\S+", text)])] == ["a@b"]
    spaced = "jane.doe [at] example [dot] org"
    assert [spaced[a:b] for a, b in pieces("email", spaced, [m.span() for m in re.finditer(r"\S+", spaced)])] == [spaced]


def test_long_runs_take_time_in_proportion():
    import time

    text = " ".join(["-"] * 20_000)
    began = time.perf_counter()
    assert pieces("card", text, [m.span() for m in re.finditer(r"\S+", text)]) == [] and time.perf_counter() - began < 30

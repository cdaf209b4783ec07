import pytest

from stratus.llm.decontaminate import Items, tokens_of


@pytest.mark.parametrize(
    "item, doc, found",
    [
        ("capital of France", "the Capital, of France! is", 3),
        ("capital of France", "capital city of France", 0),
        ("Paris", "in Paris.", 1),
        ("\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff1f", "\u8bf7\u95ee\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\u3002\u8c22\u8c22", 8),
        ("\u9996\u90fd", "\u4e2d\u56fd\u7684\u9996\u90fd\u3002", 2),
        ("one two - three 'four' five six", "x one\u00a0two\u2014three \u2018four\u2019 five\u2003six y", 6),
        ("\u0e44\u0e17\u0e22\u0e04\u0e33", "\u0e01\u0e44\u0e17\u0e22\u0e04\u0e33\u0e01", 5),
    ],
)
def test_short_items_and_separators_of_all_scripts(item, doc, found):
    got = Items.of([(1, item), (2, ""), (3, "--")]).matches(doc)
    assert [(k, n) for k, n, _ in got] == ([(0, found)] if found else [])


def test_letters_beyond_ascii_stay_in_words():
    assert tokens_of("\u00dcn\u00ef co\u0308de 12") == [w.encode() for w in ("\u00fcn\u00ef", "co\u0308de", "12")]

"""Token counts by a linear longest-match automaton.

A word (a run without ASCII white space) is cut greedily into the longest vocabulary pieces; its first piece carries the word
mark, a leading space. Only the number of pieces is wanted, so the automaton never builds them: it is the trie of the vocabulary
with a failure link for each node, the node where matching goes on when no edge fits, and the precomputed number of tokens
popped on that way. Each byte of a word is read once. Every single byte is a piece of the vocabulary, so a word can't fail.

Edge cases: a null, empty or blank text has no words and no tokens; a word of any length is cut whole; equal texts have equal counts;
repeated rows give a row each; an empty table gives an empty result. Columns besides key and text are not read.
"""

from __future__ import annotations

import base64
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from stratus.llm.common import map_texts, table

VOCABULARY = "byte_bpe_50k"
MARK = b" "


class Automaton:
    """edges[node * 256 + byte] -> node; fail[node] and popped[node] as above; node 0 is the root, which has no failure link."""

    def __init__(self, vocabulary: list[bytes]):
        missing = [b for b in range(256) if bytes([b]) not in set(vocabulary)]
        if missing:
            raise ValueError(f"bytes without a piece: {missing[:5]}")
        self.edges: dict[int, int] = {}
        children: list[list[tuple[int, int]]] = [[]]
        whole = [False]
        for piece in vocabulary:
            at = 0
            for b in piece:
                to = self.edges.get(at << 8 | b)
                if to is None:
                    to = self.edges[at << 8 | b] = len(children)
                    children[at].append((b, to))
                    children.append([])
                    whole.append(False)
                at = to
            whole[at] = bool(at)
        self.fail, self.popped = [0] * len(children), [0] * len(children)
        level = [(0, b, v) for b, v in children[0]]
        while level:
            for parent, b, v in level:
                if whole[v]:
                    self.popped[v] = 1
                    continue
                popped, at = self.popped[parent], self.fail[parent]
                while at << 8 | b not in self.edges:
                    popped += self.popped[at]
                    at = self.fail[at]
                self.fail[v], self.popped[v] = self.edges[at << 8 | b], popped
            level = [(v, b, w) for _, _, v in level for b, w in children[v]]

    def count(self, word: bytes) -> int:
        """The number of longest-match pieces of one word, mark included."""
        edges, fail, popped = self.edges, self.fail, self.popped
        at = n = 0
        for b in word:
            while (to := edges.get(at << 8 | b)) is None:
                n += popped[at]
                at = fail[at]
            at = to
        while at:
            n += popped[at]
            at = fail[at]
        return n


@cache
def pieces(path: str | None = None) -> tuple[bytes, ...]:
    """The pieces of a vocabulary file, by default VOCABULARY."""
    import public_tokenizers as public

    with open(path or public.path(f"{VOCABULARY}.tiktoken"), "rb") as lines:
        return tuple(base64.b64decode(line.split()[0]) for line in lines)


@cache
def automaton(path: str | None = None) -> Automaton:
    """Built once in each Python worker."""
    return Automaton(list(pieces(path)))


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens of every whole text; vocabulary is the path of the pieces' file on every executor."""

    def work(ids: list, texts: list) -> dict:
        count, known = automaton(vocabulary).count, {}
        n_words, n_tokens = [], []
        for t in texts:
            words = (t or "").encode().split()
            total = 0
            for w in words:
                n = known.get(w)
                if n is None:
                    n = known[w] = count(MARK + w)
                total += n
            n_words.append(len(words))
            n_tokens.append(total)
        return {"doc_id": ids, "n_words": n_words, "n_tokens": n_tokens}

    return map_texts(docs, key, text, "doc_id bigint, n_words bigint, n_tokens bigint", work)


def op2_longest_match_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"))

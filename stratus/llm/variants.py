"""Spelling variants: one-edit pairs of words from an errata trie.

The words stand in a trie, a node being a prefix. At each node the child with the most words below it is heavy, the others, and a
word that ends there, are light. Only light subtrees are merged: every word below a light edge is put in once with that character skipped, once
with it replaced by the heavy one, and once with the heavy one put before it; where such a terminal coincides with a word of the trie, the two are one
edit apart. Light subtrees of one node are merged with each other with the character open. A word lies below at most log2(words) light edges,
as each at least halves the words left, so the merged tries hold so many entries a word however long words are. Every pair is met: of two
words that part at a node by a replaced character one branch is light; where a word has a character more, either this is light and
skipped, or it is heavy and the other word's branch, taken after the run of equal characters, is light.

Nodes are known by a hash of their prefix, as are terminals, so the trie is a table: subtree sizes are counts by node and character, and
merging is a join. Hashes only propose; every pair is verified on the words themselves.

Scale: each task counts the runs of a slice of texts before words are shuffled. Rows of a node and its heavy child exist only where words part, so
fewer than there are words. Nodes above a HOT_NODES-th of all words, which would be hot keys, are broadcast, being counted first; what a word
proposes goes by the hash of the proposed word, which only as many words as it has near ones can share. Light edges of one node that agree in the rest of
the word are at most as many as there are letters. Roots are found by doubling the steps, in rounds that follow the logarithm of the longest chain.

Edge cases: a null text has no words; a null key is written as nothing before the colon; repeated rows count each; a run may be of any
length; ties in n go to the smallest word in code-point order; an empty table gives an empty result. Columns besides key and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import BROADCAST_IDS, cut_lineage, map_texts, slices, table

LEAST_LENGTH = 6
LEAST_COUNT = 5
FACTOR = 5
DAMAGED = 199
HOT_NODES = 500
HOT_LEAST = 1000
#: Of a form n is at least FACTOR times the variant's, so no chain passes so many steps in 64-bit counts.
DOUBLINGS = 6

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_B = 0x9E3779B97F4A7C15
_B_INVERSE = pow(_B, -1, 1 << 64)


def word_of(run: str, key: int | None) -> str:
    """The word that a lower-cased run of a document stands for: the run, or what is left of it where the damage strikes."""
    h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % DAMAGED == 0 else run


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words long and frequent enough."""

    def work(ids: list, texts: list) -> dict:
        counts: Counter[str] = Counter()
        coded: dict[str, bytes] = {}
        for key, body in zip(ids, texts, strict=True):
            start = zlib.crc32(f"{'' if key is None else key}:".encode())
            for run, n in Counter(_RUN.findall((body or "").translate(_LOWER))).items():
                # One character at most goes.
                if len(run) < least_length:
                    continue
                raw = coded.get(run)
                if raw is None:
                    raw = coded[run] = run.encode()
                counts[run if zlib.crc32(raw, start) % DAMAGED else word_of(run, key)] += n
        kept = [(w, n) for w, n in counts.items() if len(w) >= least_length]
        return {"word": [w for w, _ in kept], "n": [n for _, n in kept]}

    counted = map_texts(docs, key, text, "word string, n bigint", work)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _powers(n: int) -> np.ndarray:
    """B**0 to B**(n-1), modulo 2**64."""
    out = np.full(n, _B, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Prefixes:
    """Prefix sums of words under a polynomial hash: of the character at place i with code c, (c + 1) * B**i is added."""

    def __init__(self, batch: list[str]):
        self.lengths = np.fromiter(map(len, batch), dtype=np.int64, count=len(batch))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.codes = np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.powers = _powers(int(self.lengths.max(initial=0)) + 2)
        place = np.arange(len(self.codes)) - np.repeat(self.starts, self.lengths)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(self.codes * self.powers[place], dtype=np.uint64)])

    def at(self, word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The sum over the first k characters of each word."""
        return self.sums[self.starts[word] + k] - self.sums[self.starts[word]]

    def code(self, word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Code plus one of the character at k, 0 at the end."""
        inside = k < self.lengths[word]
        return np.where(inside, self.codes[np.minimum(self.starts[word] + k, max(0, len(self.codes) - 1))] if len(self.codes) else 0, 0).astype(np.uint64)


def mixed(sums: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """A node's or terminal's number from the sum of its characters and its length."""
    h = sums + depth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).astype(np.int64)


def _mapped(df: DataFrame, schema: str, work) -> DataFrame:
    """work(prefixes, rows) -> columns for batches whose first column is the word; a slice of bounded characters at a time."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            for a, b in slices(held):
                got = work(Prefixes(held[a:b]), batch.slice(a, b - a))
                yield pa.record_batch([pa.array(got[k]) for k in names], names=names)

    return df.mapInArrow(run, schema)


def _every_place(of: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """Word and place of every character and of every end."""
    word = np.repeat(np.arange(len(of.lengths)), of.lengths + 1)
    return word, np.arange(len(word)) - np.repeat(np.cumsum(of.lengths + 1) - of.lengths - 1, of.lengths + 1)


def heavy_children(vocabulary: DataFrame) -> DataFrame:
    """node, heavy (code plus one of the heavy child's character), total of the nodes where words part."""

    def edges(of: Prefixes, rows: pa.RecordBatch) -> dict:
        word, k = _every_place(of)
        node, code = mixed(of.at(word, k), k), of.code(word, k).astype(np.int64)
        order = np.lexsort([code, node])
        node, code = node[order], code[order]
        first = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (code[1:] != code[:-1])])) if len(node) else np.zeros(0, dtype=np.int64)
        return {"node": node[first], "code": code[first], "n": np.diff(np.concatenate([first, [len(node)]]))}

    children = _mapped(vocabulary.select("word"), "node bigint, code bigint, n bigint", edges).groupBy("node", "code").agg(F.sum("n").alias("n"))
    # The end of a word is never heavy; ties go to the lesser code.
    best = F.max(F.when(F.col("code") > 0, F.struct("n", (-F.col("code")).alias("code"))))
    return children.groupBy("node").agg((-best["code"]).alias("heavy"), F.sum("n").alias("total"), F.count("*").alias("branches")).where("branches > 1").drop("branches")


def light_edges(vocabulary: DataFrame, heavy: DataFrame) -> DataFrame:
    """word, id, k, heavy: the places where a word leaves the heavy path."""

    def places(of: Prefixes, rows: pa.RecordBatch) -> dict:
        word, k = _every_place(of)
        return {"id": rows.column(1).to_numpy()[word], "k": k, "node": mixed(of.at(word, k), k), "code": of.code(word, k).astype(np.int64)}

    heavy = cut_lineage(heavy)
    limit = max(HOT_LEAST, vocabulary.count() // HOT_NODES)
    hot = heavy.where(F.col("total") > limit).drop("total")
    every = _mapped(vocabulary.select("word", "id"), "id bigint, k bigint, node bigint, code bigint", places)

    def left(places: DataFrame, nodes: DataFrame) -> DataFrame:
        return places.join(nodes, "node").where(F.col("code") != F.col("heavy")).select("id", "k", "heavy")

    if hot.count() > BROADCAST_IDS:
        return left(every, heavy.drop("total").hint("shuffle_hash")).join(vocabulary, "id")
    rest = heavy.where(F.col("total") <= limit).drop("total")
    hot = F.broadcast(hot)
    return left(every, hot).union(left(every.join(hot.select("node"), "node", "left_anti"), rest)).join(vocabulary, "id")


def merged(light: DataFrame) -> DataFrame:
    """id, proposed (a terminal's hash), open (the same word with the character open, else null): what light edges put into the heavy subtrees and into each other."""

    def entries(of: Prefixes, rows: pa.RecordBatch) -> dict:
        word = np.arange(len(of.lengths))
        ids, k, heavy = (rows.column(i).to_numpy() for i in (1, 2, 3))
        code, h, n = of.code(word, k), heavy.astype(np.uint64), of.lengths
        before, whole, step = of.at(word, k), of.at(word, n), of.powers[k]
        inserted = mixed(before + h * step + (whole - before) * np.uint64(_B), n + 1)
        cut = np.flatnonzero(k < n)
        rest = whole[cut] - of.at(word[cut], k[cut] + 1)
        skipped = mixed(before[cut] + rest * np.uint64(_B_INVERSE), n[cut] - 1)
        replaced = mixed(whole[cut] + (h[cut] - code[cut]) * step[cut], n[cut])
        opened = mixed(whole[cut] - code[cut] * step[cut], n[cut] * 0x10001 + k[cut])
        none = np.zeros(len(ids) + 2 * len(cut), dtype=bool)
        return {
            "id": np.concatenate([ids, ids[cut], ids[cut], ids[cut]]),
            "proposed": pa.array(np.concatenate([inserted, skipped, replaced, opened])),
            "open": np.concatenate([none, np.ones(len(cut), dtype=bool)]),
        }

    return _mapped(light.select("word", "id", "k", "heavy"), "id bigint, proposed bigint, open boolean", entries)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """a, b: ids of the words one edit apart, each pair both ways. vocabulary: id, word."""

    def terminals(of: Prefixes, rows: pa.RecordBatch) -> dict:
        return {"b": rows.column(1).to_numpy(), "proposed": mixed(of.at(np.arange(len(of.lengths)), of.lengths), of.lengths)}

    entries = cut_lineage(merged(light_edges(vocabulary, heavy_children(vocabulary))))
    ends = _mapped(vocabulary.select("word", "id"), "b bigint, proposed bigint", terminals)
    coinciding = entries.where("not open").select(F.col("id").alias("a"), "proposed").join(ends, "proposed").select("a", "b")
    # Words of one node that agree but in its character: at most as many as letters.
    together = entries.where("open").groupBy("proposed").agg(F.collect_set("id").alias("ids")).where(F.size("ids") > 1)
    among = together.select(F.explode("ids").alias("a"), "ids").select("a", F.explode("ids").alias("b"))
    found = coinciding.union(among).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    spelt = found.join(vocabulary.select(F.col("id").alias("a"), F.col("word").alias("x")), "a").join(vocabulary.select(F.col("id").alias("b"), F.col("word").alias("y")), "b")
    checked = cut_lineage(spelt.where(one_edit(F.col("x"), F.col("y"))).select("a", "b"))
    return checked.union(checked.select("b", "a"))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two texts differ by exactly one inserted, deleted or replaced code point; a band of the distance table is enough to tell."""
    return F.levenshtein(a, b, 1) == 1


def forms(counted: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, n, n_near, form, form_n, root of counted words (word, n)."""
    vocabulary = cut_lineage(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    pairs = near_pairs(vocabulary.select("id", "word"))
    with_near = pairs.join(vocabulary.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n")), "b")
    # Of equal counts the smallest word: the least of (-n, word).
    best = with_near.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"), F.col("b").alias("id"))).alias("best"))
    known = vocabulary.join(best.withColumnRenamed("a", "id"), "id", "left")
    is_form = -F.col("best.n") >= factor * F.col("n")
    known = cut_lineage(known.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[F.when(is_form, c).alias(name) for c, name in ((F.col("best.word"), "form"), (-F.col("best.n"), "form_n"), (F.col("best.id"), "form_id"))]))
    roots = chain_ends(known.where(F.col("form_id").isNotNull()).select("id", F.col("form_id").alias("to")))
    rooted = known.join(roots, "id", "left").join(vocabulary.select(F.col("id").alias("to"), F.col("word").alias("root")), "to", "left")
    return rooted.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def chain_ends(steps: DataFrame) -> DataFrame:
    """id, to: the last of the chain of steps (id, to) from each id; steps lead to no id twice."""
    now = cut_lineage(steps)
    for _ in range(DOUBLINGS):
        further = now.select(F.col("id").alias("to"), F.col("to").alias("next"))
        further = F.broadcast(further) if now.count() <= BROADCAST_IDS else further.hint("shuffle_hash")
        then = cut_lineage(now.join(further, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        now = then.drop("moved")
        if then.where("moved").isEmpty():
            break
    return now


def op12_errata_trie_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words counted, its form and its root."""
    return forms(words(table(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")


OP12_SQL = """with recursive shifted(k, v) as (select 0, list_transform(range(256), lambda i: i::bigint) union all select k + 1, list_transform(v, lambda c: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) from shifted where k < 8),
crc as (select v as t from shifted where k = 8),
runs as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')) as run from documents),
lowered as (select coalesce(doc_id::varchar, '') as key, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from runs group by all),
coded as (select *, hex(encode(key || ':' || run)) as raw from lowered where length(run) >= 6),
hashed as (select run, n, xor(list_reduce(list_transform(range(0, length(raw) // 2), lambda i: ('0x' || substr(raw, 2 * i::int + 1, 2))::bigint), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295) as h from coded, crc),
results as (select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n from hashed),
words as (select word, sum(n)::bigint as n from results where length(word) >= 6 group by word having sum(n) >= 5),
places as (select word, n, unnest(range(1, length(word) + 1))::int as i from words),
cut as (select word, n, i, substr(word, 1, i - 1) as a, substr(word, i + 1) as b from places),
pairs as (select x.word, y.word as near from cut x join cut y on x.i = y.i and x.a = y.a and x.b = y.b and x.word <> y.word
  union select c.word, w.word from cut c join words w on w.word = c.a || c.b union select w.word, c.word from cut c join words w on w.word = c.a || c.b),
ranked as (select p.word, p.near, f.n as near_n, count(*) over (partition by p.word) as n_near, row_number() over (partition by p.word order by f.n desc, p.near) as k from pairs p join words f on f.word = p.near),
formed as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * w.n then near end as form, case when near_n >= 5 * w.n then near_n end as form_n from words w left join ranked r on r.word = w.word and k = 1),
chain(word, stop) as (select word, word from formed union all select c.word, f.form from chain c join formed f on f.word = c.stop where f.form is not null),
roots as (select c.word, c.stop as root from chain c join formed f on f.word = c.stop where f.form is null)
select word, form, root, n, n_near, form_n from formed join roots using (word)"""

"""Cost-balanced packing of documents into token sequences.

A piece of n tokens costs LINEAR * n + QUADRATIC * n * n (attention within the piece). Longer documents are cut every 2048 tokens;
such a full piece is a sequence of its own. The rest of each document is assigned, in descending length, to the sequence
of least cost that has room. Where no sequence has room for a whole piece, the roomiest one takes as many 64-token blocks of it as
fit and what remains queues again; only when less than a block fits anywhere is another sequence opened.

Scale: the rests of documents are dealt by a hash of key, checksum and the place at which a task meets the row, into groups of about GROUP_DOCS, a number
that follows the row count, and each group is packed alone; equal rows, however many and long, are spread like others. Full pieces are sequences already and
go around the groups. Only a row of numbers for each piece is shuffled, no tokens: the checksum of a piece that is cut
later follows from the checksums of its blocks.

Edge cases: a null text is empty and holds the end token alone; repeated rows are packed each; ties
in length go by key, start and checksum; an empty table gives an empty result. Columns besides key and text are not read.
"""

from __future__ import annotations

import bisect
import zlib
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import cut_lineage, map_texts, table

CAPACITY = 2048
BLOCK = 64
END_ID = 1
GROUP_DOCS = 4096
FULL = 1 << 62
LINEAR = 1.0
QUADRATIC = 1.0 / 1024
TOKENIZER = "byte_bpe_50k"

_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, block_crcs binary, bin bigint"
_PACKED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


@cache
def encoder(ranks_path: str | None = None):
    """Text -> token ids of a byte-level BPE file (by default TOKENIZER); its special token's string counts as that token.

    A run of white space too long for the fast library's pattern makes it raise; such a text is encoded, whole, by the
    tokenizers library from the JSON form of the vocabulary beside the ranks.
    """
    import base64

    import public_tokenizers as public
    import tiktoken

    ranks_path = ranks_path or public.path(f"{TOKENIZER}.tiktoken")
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    patient = cache(lambda: _patient_encoder(f"{ranks_path.removesuffix('.tiktoken')}.json"))

    def ids(text: str) -> list[int]:
        try:
            return coder.encode(text, allowed_special="all")
        except ValueError:
            return patient().encode(text, add_special_tokens=False).ids

    return ids


def _patient_encoder(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str | None, ranks_path: str | None = None) -> np.ndarray:
    """Ids of the whole text and the end token, as little-endian unsigned 32-bit."""
    return np.array([*encoder(ranks_path)(text or ""), END_ID], dtype="<u4")


def pieces(docs: DataFrame, groups: int, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, ranks_path: str | None = None) -> DataFrame:
    """The pieces of each document before packing, with the group that packs them."""

    # A task's own, through all its slices.
    met = count()

    def work(ids: list, texts: list) -> dict:
        task = TaskContext.get()
        place = task.partitionId() if task else 0
        out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "block_crcs", "bin")}
        for doc, body in zip(ids, texts, strict=True):
            tokens = token_ids(body, ranks_path)
            raw, n = tokens.tobytes(), len(tokens)
            group = zlib.crc32(f"{doc}:{zlib.crc32(raw)}:{place}:{next(met)}".encode()) % groups
            for a in range(0, n, capacity):
                b = min(n, a + capacity)
                blocks = b"" if b - a == capacity else np.array([zlib.crc32(raw[4 * i : 4 * min(b, i + BLOCK)]) for i in range(a, b, BLOCK)], dtype="<u4").tobytes()
                for k, v in (("doc_id", doc), ("start", a), ("length", b - a), ("ids_crc32", zlib.crc32(raw[4 * a : 4 * b])), ("doc_tokens", n), ("block_crcs", blocks), ("bin", group)):
                    out[k].append(v)
        return out

    return map_texts(docs, key, text, _PIECES, work)


@cache
def _zeros(n_bytes: int) -> tuple[int, ...]:
    """CRC-32's linear step over so many zero bytes, as 32 columns."""
    if n_bytes == 1:
        cols = []
        for bit in range(32):
            c = 1 << bit
            for _ in range(8):
                c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
            cols.append(c)
        return tuple(cols)
    half, rest = _zeros(n_bytes // 2), n_bytes % 2
    cols = [_times(half, c) for c in half]
    return tuple(_times(_zeros(1), c) for c in cols) if rest else tuple(cols)


def _times(matrix: tuple[int, ...], value: int) -> int:
    out, bit = 0, 0
    while value:
        if value & 1:
            out ^= matrix[bit]
        value >>= 1
        bit += 1
    return out


def joined_crc(crcs: np.ndarray, length: int) -> int:
    """CRC-32 of consecutive blocks of BLOCK ids, the last one shorter, from theirs."""
    crc = int(crcs[0])
    for i in range(1, len(crcs)):
        n = min(BLOCK, length - i * BLOCK)
        crc = _times(_zeros(4 * n), crc) ^ int(crcs[i])
    return crc


def balance(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, first token, tokens, sequence) for pieces in descending length, in the order of assignment."""
    opened = -(-sum(lengths) // capacity)
    room = np.full(max(1, 2 * opened + 8), capacity, dtype=np.int64)
    cost = np.full(len(room), np.inf)
    cost[:opened] = 0.0
    queue = [(-n, i, 0) for i, n in enumerate(lengths)]
    out, at = [], 0
    while at < len(queue):
        n, i, first = queue[at]
        n, at = -n, at + 1
        open_room = room[:opened]
        fits = np.where(open_room >= n, cost[:opened], np.inf)
        best = int(np.argmin(fits)) if opened else -1
        take = n
        if best < 0 or not np.isfinite(fits[best]):
            best = int(np.argmax(open_room)) if opened else -1
            take = int(open_room[best]) // BLOCK * BLOCK if best >= 0 else 0
            if take == 0:
                if opened == len(room):
                    room = np.concatenate([room, np.full(len(room), capacity, dtype=np.int64)])
                    cost = np.concatenate([cost, np.full(len(cost), np.inf)])
                best, take, cost[opened] = opened, n, 0.0
                opened += 1
        out.append((i, first, take, best))
        room[best] -= take
        cost[best] += LINEAR * take + QUADRATIC * take * take
        if take < n:
            bisect.insort(queue, (take - n, i, first + take), lo=at)
    return out


def _pack_group(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids_crc32"]))
    base = rows[0]["bin"] << 32
    out = []
    filled: dict[int, int] = {}
    for i, first, take, seq in balance([r["length"] for r in rows]):
        r = rows[i]
        crc = r["ids_crc32"]
        if take < r["length"]:
            crc = joined_crc(np.frombuffer(r["block_crcs"], dtype="<u4")[first // BLOCK : -(-(first + take) // BLOCK)], take)
        offset = filled.get(seq, 0)
        filled[seq] = offset + take
        out.append((r["doc_id"], r["start"] + first, take, crc, r["doc_tokens"], base + seq, offset))
    cols = list(zip(*out, strict=True))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.table({n: pa.array(c, type=pa.int64()) for n, c in zip(names, cols, strict=True)})


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks_path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row a piece. Counts the rows first.

    The pieces, rows of numbers, are written before they are grouped: where a row goes depends on where a task meets it, and
    a task that runs again after a loss might meet it elsewhere. Sequences of full pieces are numbered from FULL on.
    """
    groups = max(1, docs.count() // GROUP_DOCS)
    made = cut_lineage(pieces(docs, groups, key, text, ranks_path=ranks_path))
    full = made.where(F.col("length") == CAPACITY).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.monotonically_increasing_id() + FULL).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return full.unionByName(made.where(F.col("length") < CAPACITY).groupBy("bin").applyInArrow(_pack_group, _PACKED))


def sequences(docs: DataFrame, packed: DataFrame, key: str = "doc_id", text: str = "text", ranks_path: str | None = None) -> DataFrame:
    """sequence_id, ids: the packed token ids themselves. Keys must be unique; a sequence holds at most CAPACITY ids."""

    def work(ids: list, texts: list) -> dict:
        return {"doc_id": ids, "ids": [token_ids(t, ranks_path).astype(np.int64).tolist() for t in texts]}

    tokens = map_texts(docs, key, text, "doc_id bigint, ids array<bigint>", work)
    cut = packed.join(tokens, "doc_id").select("sequence_id", "offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids"))
    return cut.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))


def op4_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))

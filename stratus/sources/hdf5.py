"""HDF5 files as NetCDF-4 makes them, by the published file format: just what it takes to find a variable's chunks and read some of them.

Read are superblocks 0 to 3, object headers 1 and 2, groups by symbol table, by link messages and by dense storage (fractal heap under a
version 2 B-tree), attributes likewise, compact, contiguous and chunked layouts with the version 1 B-tree, and the filters shuffle,
deflate and fletcher32 (whose sums, like those of metadata, are not checked). Anything else raises Unsupported and names it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

SIGNATURE = b"\x89HDF\r\n\x1a\n"
# The format's numbers for messages, filters and the undefined address.
SPACE, LINK_INFO, TYPE, FILL, LINK, LAYOUT, FILTERS, ATTRIBUTE, CONTINUED, SYMBOLS, ATTRIBUTE_INFO = 0x01, 0x02, 0x03, 0x05, 0x06, 0x08, 0x0B, 0x0C, 0x10, 0x11, 0x15
DEFLATE, SHUFFLE, FLETCHER = 1, 2, 3
NOWHERE = (1 << 64) - 1
STEP_BYTES = 1 << 20


class Unsupported(ValueError):
    """A part of the format that isn't read here."""


@dataclass(frozen=True)
class Chunk:
    """Where a chunk begins in the grid and in the file; filters whose bit is set in `skipped` were not applied to it."""

    start: tuple[int, ...]
    address: int
    size: int
    skipped: int = 0


@dataclass
class Dataset:
    shape: tuple[int, ...] = ()
    dtype: np.dtype | None = None
    fill: float | None = None
    #: Of a chunk, whether stored so or cut from what is not.
    chunk: tuple[int, ...] = ()
    filters: list[int] = field(default_factory=list)
    attrs: dict = field(default_factory=dict)
    address: int = NOWHERE
    indexed: bool = False
    inline: bytes | None = None


class _Bytes:
    """Numbers one after the other."""

    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def take(self, n: int) -> bytes:
        out = self.raw[self.at : self.at + n]
        if len(out) < n:
            raise ValueError("file ends early")
        self.at += n
        return out

    def int(self, n: int) -> int:
        return int.from_bytes(self.take(n), "little")

    def align(self) -> None:
        self.at += -self.at % 8


class File:
    """Datasets of the root group by name; `stream` has seek and read."""

    def __init__(self, stream):
        self.stream = stream
        head = _Bytes(self._read(0, 96, short=True))
        if head.take(8) != SIGNATURE:
            raise ValueError("not an HDF5 file")
        version = head.int(1)
        if version in (0, 1):
            head.take(4)
            sizes = head.int(1), head.int(1)
            head.take(9 if version == 0 else 13)
            head.take(8 * 4 + 8)
            root = head.int(8)
        elif version in (2, 3):
            sizes = head.int(1), head.int(1)
            head.take(1 + 8 * 3)
            root = head.int(8)
        else:
            raise Unsupported(f"superblock version {version}")
        if sizes != (8, 8):
            raise Unsupported(f"offsets and lengths of {sizes} bytes")
        self.datasets: dict[str, Dataset] = {}
        for name, address in self._links(root):
            found = self._dataset(address)
            if found is not None:
                self.datasets[name] = found

    def _read(self, address: int, n: int, short: bool = False) -> bytes:
        self.stream.seek(address)
        out = self.stream.read(n)
        if len(out) < n and not short:
            raise ValueError("file ends early")
        return out

    def _signed(self, address: int, n: int, signature: bytes) -> _Bytes:
        b = _Bytes(self._read(address, n))
        if b.take(4) != signature:
            raise ValueError(f"no {signature.decode()} where one should be")
        return b

    def _messages(self, address: int) -> Iterator[tuple[int, bytes]]:
        """Type and body of each message of an object header, continuations included."""
        first = self._read(address, 4)
        todo: list[tuple[int, int]] = []
        if first == b"OHDR":
            flags = self._read(address + 5, 1)[0]
            at = address + 6 + 16 * bool(flags & 0x20) + 4 * bool(flags & 0x10)
            width = 1 << (flags & 3)
            todo.append((at + width, int.from_bytes(self._read(at, width), "little")))
        elif first[0] == 1:
            todo.append((address + 16, int.from_bytes(self._read(address + 8, 4), "little")))
        else:
            raise Unsupported(f"object header version {first[0]}")
        while todo:
            at, n = todo.pop(0)
            b = _Bytes(self._read(at, n))
            while n - b.at >= (8 if first[0] == 1 else 4 + 2 * bool(flags & 4)):
                if first[0] == 1:
                    kind, size, shared = b.int(2), b.int(2), b.int(1)
                    b.take(3)
                else:
                    kind, size, shared = b.int(1), b.int(2), b.int(1)
                    b.take(2 * bool(flags & 4))
                body = b.take(size)
                if kind == CONTINUED:
                    start, length = struct.unpack("<QQ", body[:16])
                    # Version 2 blocks stand between a signature and a sum.
                    todo.append((start, length) if first[0] == 1 else (start + 4, length - 8))
                elif shared & 2 and kind in (TYPE, FILL, FILTERS, SPACE):
                    raise Unsupported("shared messages")
                elif kind:
                    yield kind, body

    def _links(self, address: int) -> Iterator[tuple[str, int]]:
        """Name and object header of each hard link of a group."""
        for kind, body in self._messages(address):
            b = _Bytes(body)
            if kind == SYMBOLS:
                tree, heap = b.int(8), b.int(8)
                local = self._signed(heap, 32, b"HEAP")
                local.take(4)
                size, _, data = local.int(8), local.int(8), local.int(8)
                yield from self._symbols(tree, self._read(data, size))
            elif kind == LINK:
                yield from self._link(body)
            elif kind == LINK_INFO:
                yield from (x for raw in self._dense(b, 8) for x in self._link(raw))

    def _symbols(self, address: int, names: bytes) -> Iterator[tuple[str, int]]:
        level, used, b = self._node(address, 0, 8)
        for _ in range(used):
            b.take(8)
            child = b.int(8)
            if level:
                yield from self._symbols(child, names)
                continue
            n = int.from_bytes(self._read(child + 6, 2), "little")
            table = self._signed(child, 8 + 40 * n, b"SNOD")
            table.take(4)
            for _ in range(n):
                at, header = table.int(8), table.int(8)
                table.take(24)
                yield names[at : names.index(b"\0", at)].decode(), header

    def _node(self, address: int, kind: int, key: int) -> tuple[int, int, _Bytes]:
        """Level, entries and the rest of a version 1 B-tree node: a key before each child and one after the last."""
        head = self._signed(address, 24, b"TREE")
        got, level, used = head.int(1), head.int(1), head.int(2)
        if got != kind:
            raise ValueError("B-tree of another kind")
        return level, used, _Bytes(self._read(address + 24, used * (key + 8) + key))

    @staticmethod
    def _link(body: bytes) -> Iterator[tuple[str, int]]:
        b = _Bytes(body)
        b.take(1)
        flags = b.int(1)
        kind = b.int(1) if flags & 8 else 0
        b.take(8 * bool(flags & 4) + bool(flags & 16))
        name = b.take(b.int(1 << (flags & 3))).decode()
        if kind == 0:
            yield name, b.int(8)

    def _dense(self, info: _Bytes, counter: int) -> Iterator[bytes]:
        """Objects of a fractal heap in the order of its name index; `info` is a link or attribute info message."""
        info.take(1)
        flags = info.int(1)
        info.take(counter * (flags & 1))
        heap, tree = info.int(8), info.int(8)
        if heap != NOWHERE:
            fetch = self._heap(heap)
            # A link's record is a hash and the heap's number for it; an attribute's begins with that number.
            yield from (fetch(r[4:] if counter == 8 else r[:8]) for r in self._records(tree))

    def _records(self, address: int) -> Iterator[bytes]:
        """Records of a version 2 B-tree of at most two levels."""
        b = self._signed(address, 38, b"BTHD")
        b.take(2)
        size, width, depth = b.int(4), b.int(2), b.int(2)
        b.take(2)
        root, n = b.int(8), b.int(2)
        if depth > 1:
            raise Unsupported("name indexes of more than two levels")
        if root == NOWHERE:
            return
        node = self._signed(root, size, b"BTIN" if depth else b"BTLF")
        node.take(2)
        own = [node.take(width) for _ in range(n)]
        yield from own
        counted = ((size - 10) // width).bit_length() + 7 >> 3
        for _ in range(n + 1 if depth else 0):
            child, held = node.int(8), node.int(counted)
            leaf = self._signed(child, size, b"BTLF")
            leaf.take(2)
            yield from (leaf.take(width) for _ in range(held))

    def _heap(self, address: int):
        """A function from a fractal heap's number for an object to its bytes."""
        b = self._signed(address, 146, b"FRHP")
        b.take(1)
        b.take(2)
        filtered, _, most = b.int(2), b.int(1), b.int(4)
        b.take(12 * 8)
        width, first, largest, bits = b.int(2), b.int(8), b.int(8), b.int(2)
        b.take(2)
        root, rows = b.int(8), b.int(2)
        if filtered:
            raise Unsupported("filtered heaps")
        offset_bytes, length_bytes = bits + 7 >> 3, min(largest.bit_length() + 6 >> 3, most.bit_length() + 7 >> 3)
        size_of = lambda row: first << max(0, row - 1)

        def blocks(block: int, rows: int, start: int) -> Iterator[tuple[int, int, int]]:
            """First place, size and address of each direct block."""
            table = self._signed(block, 13 + offset_bytes + 8 * rows * width, b"FHIB")
            table.take(9 + offset_bytes)
            for row in range(rows):
                for _ in range(width):
                    child = table.int(8)
                    if size_of(row) > largest and child != NOWHERE:
                        raise Unsupported("heaps of several levels")
                    if child != NOWHERE:
                        yield start, size_of(row), child
                    start += size_of(row)

        direct = list(blocks(root, rows, 0)) if rows else [(0, first if root == NOWHERE else largest, root)]

        def fetch(number: bytes) -> bytes:
            if number[0] >> 4 & 3:
                raise Unsupported("huge and tiny objects")
            at = int.from_bytes(number[1 : 1 + offset_bytes], "little")
            n = int.from_bytes(number[1 + offset_bytes : 1 + offset_bytes + length_bytes], "little")
            start, _, block = next(x for x in direct if x[0] <= at < x[0] + x[1])
            return self._read(block + at - start, n)

        return fetch

    def _dataset(self, address: int) -> Dataset | None:
        """The dataset under an object header; None for groups and for types that aren't numbers."""
        out, laid = Dataset(), False
        raw_fill = None
        for kind, body in self._messages(address):
            b = _Bytes(body)
            if kind == SPACE:
                out.shape = _shape(b)
            elif kind == TYPE:
                out.dtype = _dtype(b)
            elif kind == FILL:
                raw_fill = _fill(b)
            elif kind == LAYOUT:
                laid = True
                self._layout(out, b)
            elif kind == FILTERS:
                out.filters = _filters(b)
            elif kind == ATTRIBUTE:
                self._attribute(out.attrs, body)
            elif kind == ATTRIBUTE_INFO:
                for raw in self._dense(b, 2):
                    self._attribute(out.attrs, raw)
        if not laid or out.dtype is None:
            return None
        if not out.indexed:
            # Whole steps of about a megabyte stand for chunks.
            step = int(np.prod(out.shape[1:], dtype=np.int64)) * out.dtype.itemsize
            out.chunk = (max(1, STEP_BYTES // max(1, step)), *out.shape[1:]) if out.shape else ()
        if raw_fill is not None and len(raw_fill) == out.dtype.itemsize:
            out.fill = float(np.frombuffer(raw_fill, out.dtype)[0])
        return out

    @staticmethod
    def _layout(out: Dataset, b: _Bytes) -> None:
        version, kind = b.int(1), b.int(1)
        if version not in (3, 4) or version == 4 and kind == 2:
            raise Unsupported(f"layout version {version}")
        if kind == 0:
            out.inline = b.take(b.int(2))
        elif kind == 1:
            out.address = b.int(8)
        else:
            rank = b.int(1) - 1
            out.address, out.indexed = b.int(8), True
            out.chunk = tuple(b.int(4) for _ in range(rank))

    @staticmethod
    def _attribute(attrs: dict, body: bytes) -> None:
        """Numbers, and texts of a fixed length; others are passed over."""
        b = _Bytes(body)
        version, shared = b.int(1), b.int(1)
        if version > 1 and shared & 3:
            return
        sizes = [b.int(2) for _ in range(3)]
        b.take(version == 3)
        held = []
        for n in sizes:
            held.append(b.take(n))
            if version == 1:
                b.align()
        name = held[0].rstrip(b"\0").decode("utf-8", "replace")
        shape = _shape(_Bytes(held[2]))
        if held[1][0] & 15 == 3:
            attrs[name] = b.raw[b.at : b.at + int.from_bytes(held[1][4:8], "little")].rstrip(b"\0").decode("utf-8", "replace")
            return
        kind = _dtype(_Bytes(held[1]))
        n = int(np.prod(shape, dtype=np.int64)) if kind is not None else 0
        if n and len(b.raw) - b.at >= n * kind.itemsize:
            attrs[name] = np.frombuffer(b.take(n * kind.itemsize), kind)

    def chunks(self, data: Dataset, wanted: list[tuple[int, int]]) -> Iterator[Chunk]:
        """The stored chunks that meet the index ranges (first, last) of each dimension; branches of the tree that can't are not read."""
        if data.inline is not None or data.address == NOWHERE:
            return
        if not data.indexed:
            step = int(np.prod(data.shape[1:], dtype=np.int64)) * data.dtype.itemsize
            if not data.shape:
                yield Chunk((), data.address, step)
            for i in range(wanted[0][0] // data.chunk[0] * data.chunk[0], wanted[0][1] + 1, data.chunk[0]) if data.shape else ():
                yield Chunk((i, *(0 for _ in data.shape[1:])), data.address + i * step, (min(i + data.chunk[0], data.shape[0]) - i) * step)
            return
        yield from self._chunks(data, data.address, wanted)

    def _chunks(self, data: Dataset, address: int, wanted: list[tuple[int, int]]) -> Iterator[Chunk]:
        rank = len(data.shape)
        level, used, b = self._node(address, 1, 16 + 8 * rank)

        def key() -> tuple[int, int, tuple[int, ...]]:
            size, skipped = b.int(4), b.int(4)
            start = tuple(b.int(8) for _ in range(rank))
            b.take(8)
            return size, skipped, start

        size, skipped, start = key()
        for _ in range(used):
            child = b.int(8)
            after = key()
            # Keys follow each other in row order, so the first dimension bounds what stands below.
            if level:
                if start[0] <= wanted[0][1] and after[2][0] + data.chunk[0] > wanted[0][0]:
                    yield from self._chunks(data, child, wanted)
            elif all(s <= last and s + c > first for s, c, (first, last) in zip(start, data.chunk, wanted, strict=True)):
                yield Chunk(start, child, size, skipped)
            size, skipped, start = after

    def decoded(self, data: Dataset, chunk: Chunk) -> np.ndarray:
        raw = self._read(chunk.address, chunk.size)
        return decoded(raw, data.dtype, data.chunk, data.filters, chunk.skipped)

    def values(self, data: Dataset, wanted: list[tuple[int, int]] | None = None) -> np.ndarray:
        """Values of the index ranges (first, last), of all by default; the fill value where no chunk was stored."""
        wanted = wanted or [(0, n - 1) for n in data.shape]
        if data.inline is not None:
            return np.frombuffer(data.inline, data.dtype).reshape(data.shape)[tuple(slice(a, b + 1) for a, b in wanted)]
        out = np.full([b - a + 1 for a, b in wanted], data.fill or 0, dtype=data.dtype)
        for chunk in self.chunks(data, wanted):
            block = self.decoded(data, chunk)
            here = [(max(s, a), min(s + c, b + 1)) for s, c, (a, b) in zip(chunk.start, data.chunk, wanted, strict=True)]
            out[tuple(slice(x - a, y - a) for (x, y), (a, _) in zip(here, wanted, strict=True))] = block[tuple(slice(x - s, y - s) for (x, y), s in zip(here, chunk.start, strict=True))]
        return out


def decoded(raw: bytes, dtype: np.dtype, shape: tuple[int, ...], filters: list[int], skipped: int = 0) -> np.ndarray:
    """A chunk's values from its stored bytes: filters are undone from the last to the first."""
    for k in reversed(range(len(filters))):
        if skipped >> k & 1:
            continue
        if filters[k] == DEFLATE:
            raw = zlib.decompress(raw)
        elif filters[k] == SHUFFLE:
            n = len(raw) // dtype.itemsize
            raw = np.frombuffer(raw, np.uint8)[: n * dtype.itemsize].reshape(dtype.itemsize, n).T.tobytes() + raw[n * dtype.itemsize :]
        elif filters[k] == FLETCHER:
            raw = raw[:-4]
        else:
            raise Unsupported(f"filter {filters[k]}")
    out = np.frombuffer(raw, dtype)
    return out.reshape(len(out) // max(1, int(np.prod(shape[1:], dtype=np.int64))), *shape[1:]) if shape else out.reshape(())


def _shape(b: _Bytes) -> tuple[int, ...]:
    version, rank, _ = b.int(1), b.int(1), b.int(1)
    b.take(5 if version == 1 else 1)
    return tuple(b.int(8) for _ in range(rank))


def _dtype(b: _Bytes) -> np.dtype | None:
    """Whole numbers and floats; None for other classes."""
    kind = b.int(1) & 15
    bits = b.int(3)
    size = b.int(4)
    if kind not in (0, 1) or size not in (1, 2, 4, 8) or kind == 1 and size == 1:
        return None
    return np.dtype(("<", ">")[bits & 1] + ("f" if kind else "i" if bits & 8 else "u") + str(size))


def _fill(b: _Bytes) -> bytes | None:
    version = b.int(1)
    if version == 3:
        return b.take(b.int(4)) if b.int(1) & 32 else None
    b.take(2)
    defined = b.int(1)
    return b.take(b.int(4)) if defined or version == 1 else None


def _filters(b: _Bytes) -> list[int]:
    version, n = b.int(1), b.int(1)
    b.take(6 if version == 1 else 0)
    out = []
    for _ in range(n):
        out.append(b.int(2))
        name = b.int(2) if version == 1 or out[-1] >= 256 else 0
        b.take(2)
        given = b.int(2)
        b.take(name + (-name % 8 if version == 1 else 0) + 4 * given + (4 * (given % 2) if version == 1 else 0))
    return out

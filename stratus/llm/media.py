"""Media columns: signatures are located, validated, and trusted over the declared type.

An Aho-Corasick automaton finds the magic bytes of every known format in one pass over a blob. Each hit goes to that format's
validator, which walks the structure and returns the exact length, or nothing; so a stray "BM" in a text is no image. The
first valid structure at offset 0 corrects the declared type; valid structures elsewhere are embedded media and can be carved.
What validators learn about a blob, such as where its end marks are or where a chain of chunks ends, is learned once, so
false signatures repeated without end take time in proportion to the blob.

Edge cases: a null or empty blob has no type and no media; bytes without a valid structure keep the declared type, marked as not
confirmed; a structure inside another one is reported only once, as part of the outer; equal blobs give equal results; an
empty table gives an empty result. Keys may be of any type, null and repeated; a row with a null key is sniffed like any other.
Only the key, the blob, the declared type and columns asked for by name are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from stratus.llm.common import SLICE_CHARS, parts_of, table, texts_of

ALIGN = 64
WIDTH = 64
UNKNOWN = "application/octet-stream"

# Fixed values of the formats: magic bytes, media type, and bytes that always stand at an offset from the magic's start.
MAGIC = (
    (b"RIFF", "audio/wav", 8, b"WAVEfmt "),
    (b"\x89PNG\r\n\x1a\n", "image/png", 8, b"\0\0\0\x0dIHDR"),
    (b"BM", "image/bmp", 6, b"\0\0\0\0"),
    (b"GIF87a", "image/gif", 0, b"GIF87a"),
    (b"GIF89a", "image/gif", 0, b"GIF89a"),
    (b"\xff\xd8\xff", "image/jpeg", 0, b"\xff\xd8\xff"),
    (b"fLaC", "audio/flac", 5, b"\0\0\x22"),
    (b"OggS", "audio/ogg", 4, b"\0"),
    (b"%PDF-", "application/pdf", 6, b"."),
)


class Blob:
    """Bytes, and what has been learned about them: places of patterns, and where chains of parts end."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self._places: dict[bytes, list[int]] = {}
        self._ends: dict[str, dict[int, tuple | None]] = {}
        #: Chunks of RIFF chains, as _riff_path() keeps them.
        self.chunks: dict[int, tuple[int, int, int, int]] = {}
        #: The last end mark of a PDF, and where it ends, by the place that it gives its table, the last of all first.
        self.pdf_ends: dict[int, tuple[int, int]] | None = None

    def places(self, pattern: bytes) -> list[int]:
        """Where a pattern matches, ascending; sought once."""
        if pattern not in self._places:
            self._places[pattern] = [m.start() for m in re.finditer(pattern, self.raw, re.S)]
        return self._places[pattern]

    def after(self, pattern: bytes, at: int) -> int | None:
        """The first place of a pattern at or after another."""
        found = self.places(pattern)
        k = bisect_left(found, at)
        return found[k] if k < len(found) else None

    def chain_end(self, kind: str, at: int, step: Callable[[int], tuple[int | None, tuple | None]], join: Callable[[int, tuple | None], tuple | None] = lambda at, end: end) -> tuple | None:
        """What the chain of parts from `at` ends in. step gives the next part's place, or none and the end; join adds what a part
        says to the end of the chain behind it. Every part is looked at once."""
        ends, path = self._ends.setdefault(kind, {}), []
        while at not in ends:
            path.append(at)
            to, end = step(at)
            if to is None:
                ends[at] = join(path.pop(), end)
                break
            at = to
        end = ends[at]
        for p in reversed(path):
            end = ends[p] = join(p, end)
        return end


def _riff_path(blob: Blob, at: int, end: int) -> int:
    """How many data chunks the chain of chunks from `at` holds up to `end`, or none (-1) if no chunk ends there.

    A chunk's entry is (next place, a place further on, chunks and data chunks to the chain's end); the second lets a question skip.
    """
    b, known, path, pos = blob.raw, blob.chunks, [], at
    while pos not in known:
        size = struct.unpack_from("<I", b, pos + 4)[0] if pos + 8 <= len(b) else 1 << 40
        to = pos + 8 + size + size % 2
        if to > len(b) + 1 or not b[pos : pos + 4].isascii():
            known[pos] = (pos, pos, 0, 0)
            break
        path.append(pos)
        pos = to
    for p in reversed(path):
        size = struct.unpack_from("<I", b, p + 4)[0]
        to = p + 8 + size + size % 2
        _, jump, depth, data = known[to]
        far = known[jump]
        skip = far[1] if depth - far[2] == far[2] - known[far[1]][2] else to
        known[p] = (to, skip, depth + 1, data + (b[p : p + 4] == b"data"))
    pos = at
    while pos < end and known[pos][0] != pos:
        pos = known[pos][1] if known[pos][1] <= end else known[pos][0]
    return known[at][3] - known[pos][3] if pos == end else -1


def _wav(blob: Blob, at: int) -> int | None:
    b = blob.raw
    if len(b) < at + 44:
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    return end - at if end <= len(b) and _riff_path(blob, at + 12, end) > 0 else None


def _png(blob: Blob, at: int) -> int | None:
    b = blob.raw

    def chunk(pos: int) -> tuple[int | None, tuple | None]:
        if pos + 12 > len(b):
            return None, None
        n, kind = struct.unpack_from(">I4s", b, pos)
        if pos + 12 + n > len(b) or not kind.isalpha():
            return None, None
        return (None, (pos + 12,)) if kind == b"IEND" and n == 0 else (pos + 12 + n, None)

    def checked(pos: int) -> tuple[int | None, tuple | None]:
        n = struct.unpack_from(">I", b, pos)[0]
        if zlib.crc32(memoryview(b)[pos + 4 : pos + 8 + n]) != struct.unpack_from(">I", b, pos + 8 + n)[0]:
            return None, None
        return chunk(pos)

    # Checksums are computed only where the lengths lead to an end.
    if not blob.chain_end("png", at + 8, chunk):
        return None
    end = blob.chain_end("png checked", at + 8, checked)
    return end[0] - at if end else None


# Sizes of the headers of bitmaps, bits a pixel by packing (none, run lengths, bit fields).
_BMP_HEADERS = (12, 16, 40, 52, 56, 64, 108, 124)
_BMP_BITS = {0: (1, 4, 8, 16, 24, 32), 1: (8,), 2: (4,), 3: (16, 32), 6: (16, 32)}


def _bmp(blob: Blob, at: int) -> int | None:
    b = blob.raw
    if len(b) < at + 26:
        return None
    size, _, start, header = struct.unpack_from("<IIII", b, at + 2)
    if header not in _BMP_HEADERS or start < 14 + header or not start < size <= len(b) - at:
        return None
    if header == 12:
        (width, height, planes, bits), packing = struct.unpack_from("<HHHH", b, at + 18), 0
    else:
        width, height, planes, bits = struct.unpack_from("<iiHH", b, at + 18)
        packing, image = struct.unpack_from("<II", b, at + 30) if header > 16 else (0, 0)
    if planes != 1 or width <= 0 or height == 0 or bits not in _BMP_BITS.get(packing, ()):
        return None
    pixels = image if packing in (1, 2) else (width * bits + 31) // 32 * 4 * abs(height)
    end = start + pixels
    if header == 124 and all(profile := struct.unpack_from("<II", b, at + 14 + 112)):
        end = max(end, 14 + sum(profile))
    return size if pixels and end <= size <= end + 3 else None


def _gif(blob: Blob, at: int) -> int | None:
    b = blob.raw
    if len(b) < at + 14:
        return None
    flags, first = b[at + 10], at + 13

    def block(pos: int) -> tuple[int | None, tuple | None]:
        if pos >= len(b):
            return None, None
        if b[pos] == 0x3B:
            return None, (pos + 1, False)
        if b[pos] == 0x2C and pos + 11 <= len(b):
            local = b[pos + 9]
            pos += 10 + (3 << ((local & 7) + 1) if local & 128 else 0) + 1
            if pos > len(b) or not 1 <= b[pos - 1] <= 11:
                return None, None
        elif b[pos] == 0x21:
            pos += 2
        else:
            return None, None
        while pos < len(b) and b[pos]:
            pos += 1 + b[pos]
        return pos + 1, None

    first += 3 << ((flags & 7) + 1) if flags & 128 else 0
    end = blob.chain_end("gif", first, block, lambda pos, end: end and (end[0], end[1] or b[pos] == 0x2C))
    return end[0] - at if end and end[1] else None


_JPEG_MARK = rb"\xff[\x01-\xcf\xd8-\xfe]"


def _jpeg(blob: Blob, at: int) -> int | None:
    b = blob.raw

    def segment(pos: int) -> tuple[int | None, tuple | None]:
        while b[pos : pos + 2] == b"\xff\xff":
            pos += 1
        if pos + 2 > len(b) or b[pos] != 0xFF:
            return None, None
        kind = b[pos + 1]
        if kind == 0xD9:
            return None, (pos + 2, False, False)
        n = struct.unpack_from(">H", b, pos + 2)[0] if pos + 4 <= len(b) else 0
        if kind <= 0x01 or 0xD0 <= kind <= 0xD8 or n < 2:
            return None, None
        # A scan's data end at the next mark that is neither stuffed nor a restart.
        return (blob.after(_JPEG_MARK, pos + 2 + n), None) if kind == 0xDA else (pos + 2 + n, None)

    def said(pos: int, end: tuple | None) -> tuple | None:
        while b[pos : pos + 2] == b"\xff\xff":
            pos += 1
        kind = b[pos + 1] if pos + 1 < len(b) else 0
        return end and (end[0], end[1] or (0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC)), end[2] or kind == 0xDA)

    first = at + 2
    while b[first + 1 : first + 2] == b"\xff":
        first += 1
    if b[first + 1 : first + 2] < b"\xc0" or b"\xd0" <= b[first + 1 : first + 2] <= b"\xd9":
        return None
    end = blob.chain_end("jpeg", first, segment, said)
    return end[0] - at if end and end[1] and end[2] else None


def _ogg(blob: Blob, at: int) -> int | None:
    b = blob.raw

    def page(pos: int) -> tuple[int | None, tuple | None]:
        if pos + 27 > len(b) or not b.startswith(b"OggS\0", pos):
            return None, None
        n = b[pos + 26]
        to = pos + 27 + n + sum(b[pos + 27 : pos + 27 + n])
        if to > len(b):
            return None, None
        # After the last page of one stream come the pages of those beside it, unless a new stream begins.
        more = to + 27 <= len(b) and b.startswith(b"OggS\0", to) and not b[to + 5] & 2
        return (None, (to,)) if b[pos + 5] & 4 and not more else (to, None)

    # A stream's first page says so and has number 0.
    if at + 28 > len(b) or not b[at + 5] & 2 or b[at + 18 : at + 22] != b"\0\0\0\0":
        return None
    end = blob.chain_end("ogg", at, page)
    return end[0] - at if end else None


_PDF_END, _PDF_HEAD, _PDF_OBJECT = rb"startxref\s+\d{1,15}\s+%%EOF", rb"%PDF-\d\.\d", re.compile(rb"\d{1,10}\s+\d{1,5}\s+obj")


def _pdf(blob: Blob, at: int) -> int | None:
    """The last end mark whose table of places is where it says, counted from the header: a file that was written to be read early, or
    changed later, has several. Where none is, the last one before another header."""
    b = blob.raw
    if not (b[at + 5 : at + 6].isdigit() and b[at + 7 : at + 8].isdigit()):
        return None
    marks = blob.places(_PDF_END)
    if not marks or marks[-1] < at:
        return None
    if blob.pdf_ends is None:
        last: dict[int, tuple[int, int]] = {}
        for m in marks:
            last[int(re.match(rb"startxref\s+(\d+)", b[m : m + 100])[1])] = (m, b.index(b"%%EOF", m) + 5)
        blob.pdf_ends = dict(sorted(last.items(), key=lambda x: -x[1][0]))
    for place, (mark, end) in blob.pdf_ends.items():
        if mark < at:
            break
        if 0 < place and at + place < mark and (b.startswith(b"xref", at + place) or _PDF_OBJECT.match(b, at + place)):
            return end - at
    following = blob.after(_PDF_HEAD, at + 5)
    k = bisect_right(marks, len(b) if following is None else following)
    return b.index(b"%%EOF", marks[k - 1]) + 5 - at if k and marks[k - 1] > at else None


@cache
def _crc_table(width: int, polynomial: int) -> tuple[int, ...]:
    out = []
    for byte in range(256):
        c = byte << (width - 8)
        for _ in range(8):
            c = (c << 1) ^ (polynomial if c >> (width - 1) else 0)
            c &= (1 << width) - 1
        out.append(c)
    return tuple(out)


def _crc(body: bytes, width: int, polynomial: int) -> int:
    t, c = _crc_table(width, polynomial), 0
    for byte in body:
        c = ((c << 8) & ((1 << width) - 1)) ^ t[(c >> (width - 8)) ^ byte]
    return c


def _flac_frame(b: bytes, at: int, depth: int) -> tuple[int, int, int, list[int]] | None:
    """Place of the first subframe, samples, number (of the frame or its first sample) and bits a sample by channel of a frame header."""
    head = b[at : at + 16]
    if len(head) < 6 or head[0] != 0xFF or head[1] & 0xFE != 0xF8 or head[3] & 1:
        return None
    block, rate, channels, bits = head[2] >> 4, head[2] & 15, head[3] >> 4, (depth, 8, 12, 0, 16, 20, 24, 32)[head[3] >> 1 & 7]
    if not block or rate == 15 or channels > 10 or not bits:
        return None
    lead = 8 - (~head[4] & 255).bit_length() if head[4] != 255 else 8
    if lead in (1, 8):
        return None
    number, pos = head[4] & (0x7F >> lead), 5
    for _ in range(max(0, lead - 1)):
        if head[pos : pos + 1] == b"" or head[pos] & 0xC0 != 0x80:
            return None
        number, pos = number << 6 | head[pos] & 63, pos + 1
    if block in (6, 7):
        n = block - 5
        samples, pos = int.from_bytes(head[pos : pos + n], "big") + 1, pos + n
    else:
        samples = 192 if block == 1 else 576 << (block - 2) if block < 6 else 256 << (block - 8)
    pos += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if pos >= len(head) or _crc(head[:pos], 8, 0x07) != head[pos]:
        return None
    count = channels + 1 if channels < 8 else 2
    side = {8: 1, 9: 0, 10: 1}.get(channels)
    return at + pos + 1, samples, number, [bits + (c == side) for c in range(count)]


def _flac_frame_end(b: bytes, at: int, frame: tuple[int, int, int, list[int]]) -> int | None:
    """Where a frame ends: its subframes are read for their lengths, and its checksum must agree."""
    first, samples, _, depths = frame
    window = 1 << 16
    while True:
        bits = bin(int.from_bytes(b"\1" + b[first : first + window], "big"))[3:]
        try:
            pos = 0
            for depth in depths:
                pos = _flac_subframe(bits, pos, samples, depth)
        except ValueError:
            # No frame, or the window was too short for it.
            if first + window >= len(b):
                return None
            window *= 4
            continue
        if pos > len(bits):
            if first + window >= len(b):
                return None
            window *= 4
            continue
        end = first + -(-pos // 8) + 2
        return end if end <= len(b) and _crc(b[at:end], 16, 0x8005) == 0 else None


def _flac_subframe(bits: str, pos: int, samples: int, depth: int) -> int:
    """The place behind a subframe; ValueError where the bits end or can't be one."""
    kind = int(bits[pos + 1 : pos + 7] or "x", 2)
    if bits[pos] != "0":
        raise ValueError("no subframe")
    pos += 8
    if bits[pos - 1 : pos] == "1":
        one = bits.index("1", pos)
        depth, pos = depth - (one - pos + 1), one + 1
    if kind == 0:
        return pos + depth
    if kind == 1:
        return pos + depth * samples
    if 8 <= kind <= 12:
        order = kind - 8
        pos += depth * order
    elif kind >= 32:
        order = kind - 31
        pos += depth * order
        precision = int(bits[pos : pos + 4] or "x", 2) + 1
        pos += 9 + order * precision
    else:
        raise ValueError("no subframe")
    method, parts = int(bits[pos : pos + 2] or "x", 2), int(bits[pos + 2 : pos + 6] or "x", 2)
    if method > 1:
        raise ValueError("no residual")
    pos, width = pos + 6, 4 + method
    for k in range(1 << parts):
        count = (samples >> parts) - (order if k == 0 else 0)
        rice, pos = int(bits[pos : pos + width] or "x", 2), pos + width
        if rice == (1 << width) - 1:
            pos += 5 + int(bits[pos : pos + 5] or "x", 2) * count
            continue
        for _ in range(count):
            pos = bits.index("1", pos) + 1 + rice
    return pos


def _flac(blob: Blob, at: int) -> int | None:
    """Frames are followed by their numbered headers to the last one, which is read for its end."""
    b = blob.raw

    def metadata(pos: int) -> tuple[int | None, tuple | None]:
        if pos + 4 > len(b) or b[pos] & 127 == 127:
            return None, None
        to = pos + 4 + int.from_bytes(b[pos + 1 : pos + 4], "big")
        return (None, (to,)) if b[pos] & 128 else (to, None)

    if b[at + 4] & 127 or len(b) < at + 42 or not (first := blob.chain_end("flac metadata", at + 4, metadata)):
        return None
    depth = ((b[at + 20] & 1) << 4 | b[at + 21] >> 4) + 1
    total = (b[at + 21] & 15) << 32 | int.from_bytes(b[at + 22 : at + 26], "big")

    def frame(pos: int) -> tuple[int | None, tuple | None]:
        head = _flac_frame(b, pos, depth)
        if head is None:
            return None, None
        number = head[2] + (head[1] if b[pos + 1] & 1 else 1)
        before = head[2] if b[pos + 1] & 1 else head[2] * head[1]
        if not total or before + head[1] < total:
            to = b.find(b[pos : pos + 2], head[0])
            while to >= 0:
                following = _flac_frame(b, to, depth)
                # Where the stream doesn't say how long it is, the number might be that of another stream behind it.
                if following and following[2] == number and (total or _crc(b[pos:to], 16, 0x8005) == 0):
                    return to, None
                to = b.find(b[pos : pos + 2], to + 1)
        end = _flac_frame_end(b, pos, head)
        return None, end and (end,)

    # The stream's depth and length steer the walk, so that only streams alike in them share what was learned.
    end = blob.chain_end(f"flac {depth} {total}", first[0], frame)
    return end[0] - at if end else None


VALIDATORS = {"audio/wav": _wav, "image/png": _png, "image/bmp": _bmp, "image/gif": _gif, "image/jpeg": _jpeg, "audio/flac": _flac, "audio/ogg": _ogg, "application/pdf": _pdf}


@cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic, kind, offset, fixed in MAGIC:
        found.add_word(magic.decode("latin-1"), (len(magic) - 1, kind, offset, fixed))
    found.make_automaton()
    return found


def media_in(raw: bytes | None) -> list[tuple[str, int, int]]:
    """(type, offset, length) of the outermost valid structures, in order."""
    out: list[tuple[str, int, int]] = []
    free, blob, raw = 0, None, raw or b""
    for last, (back, kind, offset, fixed) in _automaton().iter(raw.decode("latin-1")):
        at = last - back
        if at >= free and raw.startswith(fixed, at + offset):
            blob = blob or Blob(raw)
            if size := VALIDATORS[kind](blob, at):
                out.append((kind, at, size))
                free = at + size
    return out


def _columns(df: DataFrame, key: str, blob: str, keep: tuple[str, ...], made: tuple[str, ...]) -> list:
    """id, blob and the columns to keep; their names must not be among those that are made."""
    clash = set(keep) & {"id", *made}
    if clash:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    return [F.col(key).alias("id"), F.col(blob).alias("__blob"), *[F.col(c).alias(c) for c in keep]]


_MEDIA = StructType([StructField("media_type", StringType()), StructField("offset", LongType()), StructField("length", LongType())])


_SNIFFED = (("declared", StringType()), ("media_type", StringType()), ("confirmed", BooleanType()), ("corrected", BooleanType()), ("embedded", ArrayType(_MEDIA)))
_CARVED = (("carved_type", StringType()), ("offset", LongType()), ("media", BinaryType()))
_KINDS = pa.list_(pa.struct([("media_type", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))


def _sniffed(said: str | None, found: list[tuple[str, int, int]]) -> tuple:
    head = found[0][0] if found and found[0][1] == 0 else None
    return said, head or said, head is not None, head is not None and head != said, [dict(zip(("media_type", "offset", "length"), x, strict=True)) for x in found if x[1]]


def _looked_at(df: DataFrame, blob: str, declared: str | None, key: str, keep: tuple[str, ...], sniffed: bool, carved: bool, required: bool) -> DataFrame:
    """id, what sniff() tells, what carve() cuts out, columns to keep: one look at each blob, in slices of bounded size."""
    made = (_SNIFFED if sniffed else ()) + (_CARVED if carved else ())
    names = [n for n, _ in made]
    cols = df.select(*_columns(df, key, blob, keep, (*names, "media_type")), (F.col(declared) if declared else F.lit(None)).cast("string").alias("__declared"))
    schema = StructType([cols.schema["id"], *[StructField(n, t) for n, t in made], *[cols.schema[c] for c in keep]])
    return cols.mapInArrow(_looker(keep, sniffed, carved, required), schema)


def _looker(keep: tuple[str, ...], sniffed: bool, carved: bool, required: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does with batches of (id, blob, columns to keep, declared type)."""
    names = [n for n, _ in (_SNIFFED if sniffed else ()) + (_CARVED if carved else ())]
    types = {"declared": pa.string(), "media_type": pa.string(), "confirmed": pa.bool_(), "corrected": pa.bool_(), "embedded": _KINDS, "carved_type": pa.string(), "offset": pa.int64(), "media": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = texts_of(batch.column(batch.num_columns - 1))
            rows, out, held = [], [], 0
            for i, b in enumerate(batch.column(1)):
                body = b.as_py()
                found = media_in(body)
                if required and not found:
                    raise ValueError("a blob without a valid structure")
                told = _sniffed(said[i], found) if sniffed else ()
                new = [(*told, kind, at, body[at : at + n]) for kind, at, n in found] if carved else [told]
                rows += [i] * len(new)
                out += new
                held += len(body or b"")
                if held > SLICE_CHARS or i == batch.num_rows - 1:
                    own = batch.take(pa.array(rows, pa.int64()))
                    yield pa.record_batch([own.column(0), *(pa.array([x[k] for x in out], types[n]) for k, n in enumerate(names)), *(own.column(2 + k) for k in range(len(keep)))], names=["id", *names, *keep])
                    rows, out, held = [], [], 0

    return run


def sniff(df: DataFrame, blob: str = "blob", declared: str | None = None, key: str = "id", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, declared, media_type, confirmed, corrected, embedded (type, offset, length of each valid structure past offset 0), columns to keep."""
    return _looked_at(df, blob, declared, key, keep, True, False, False)


def carve(df: DataFrame, blob: str = "blob", key: str = "id", keep: tuple[str, ...] = (), required: bool = False) -> DataFrame:
    """id, media_type, offset, media, columns to keep: one row for each valid structure in a blob; required: a blob without any is an error."""
    return _looked_at(df, blob, None, key, keep, False, True, required).withColumnRenamed("carved_type", "media_type")


def sniff_and_carve(df: DataFrame, blob: str = "blob", declared: str | None = None, key: str = "id", keep: tuple[str, ...] = (), required: bool = False) -> DataFrame:
    """What sniff() tells of a blob beside each medium (carved_type, offset, media) that carve() cuts out of it."""
    return _looked_at(df, blob, declared, key, keep, True, True, required)


def payload(text: str | None) -> bytes:
    """UTF-8 bytes of the text with zeros up to a positive multiple of 64."""
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % ALIGN or ALIGN * (not raw))


def to_wav(samples: bytes) -> bytes:
    """Unsigned 8-bit mono PCM."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples), b"WAVE", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8, b"data", len(samples)) + samples


def to_bmp(samples: bytes) -> bytes:
    """8-bit grey image, WIDTH samples a row, top row first."""
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256))
    start = 54 + len(palette)
    return struct.pack("<2sIIIIiiHHIIiiII", b"BM", start + len(samples), 0, start, 40, WIDTH, -(len(samples) // WIDTH), 1, 8, 0, len(samples), 2835, 2835, 256, 0) + palette + samples


def to_png(samples: bytes) -> bytes:
    """8-bit grey image, WIDTH samples a row."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = b"".join(b"\0" + samples[i : i + WIDTH] for i in range(0, len(samples), WIDTH))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(samples) // WIDTH, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b"")


def samples_of(kind: str, media: bytes) -> bytes:
    """The 8-bit samples that to_wav, to_bmp or to_png stored."""
    if kind == "audio/wav":
        at = media.index(b"data", 12)
        return media[at + 8 : at + 8 + struct.unpack_from("<I", media, at + 4)[0]]
    if kind == "image/bmp":
        return media[struct.unpack_from("<I", media, 10)[0] :]
    if kind == "image/png":
        at, packed = 8, b""
        while media[at + 4 : at + 8] != b"IEND":
            n = struct.unpack_from(">I", media, at)[0]
            packed += media[at + 8 : at + 8 + n] if media[at + 4 : at + 8] == b"IDAT" else b""
            at += 12 + n
        rows = zlib.decompress(packed)
        return b"".join(rows[i + 1 : i + 1 + WIDTH] for i in range(0, len(rows), WIDTH + 1))
    raise ValueError(f"no samples in {kind}")


def store(text: str | None) -> bytes:
    """The payload in one of three containers; its checksum decides which, so equal texts are stored alike."""
    samples = payload(text)
    return (to_wav, to_bmp, to_png)[zlib.crc32(samples) % 3](samples)


#: What stands around the media in some rows of the media column.
ENVELOPE = (b"Content-Transfer-Encoding: binary\r\n\r\n", b"\r\n--end--\r\n")
#: Types that rows declare: nothing, what a text would have, or a format that it may or may not be in.
DECLARED = (UNKNOWN, "text/plain", "audio/wav", "image/png")


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, blob, n_bytes, declared of batches of (key, text), a slice of bounded size at a time."""
    for batch in batches:
        for part in parts_of(batch, 1):
            out: dict[str, list] = {"blob": [], "n_bytes": [], "declared": []}
            for text in texts_of(part.column(1)):
                choice = zlib.crc32(payload(text)) // 3
                media = store(text)
                out["n_bytes"].append(len((text or "").encode()))
                out["declared"].append(DECLARED[choice % 4])
                out["blob"].append(media if choice // 4 % 4 else ENVELOPE[0] + media + ENVELOPE[1])
            yield pa.record_batch([part.column(0), pa.array(out["blob"], pa.binary()), pa.array(out["n_bytes"], pa.int64()), pa.array(out["declared"], pa.string())], names=["doc_id", "blob", "n_bytes", "declared"])


def media_column(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, blob, n_bytes, declared: each text stored as media under a declared type, every fourth one in an envelope, as the checksum decides."""
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_stored, "doc_id bigint, blob binary, n_bytes bigint, declared string")


def op3_signature_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored in a media column under types that are often wrong; sniffed, carved, and read back from what was carved.

    The steps of media_column() and sniff_and_carve() follow each other in one task, so that blobs aren't sent to and fro between them.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    look = _looker(("n_bytes",), True, True, True)
    schema = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in look(_stored(batches)):
            rows = []
            said = batch.select(["id", "carved_type", "offset", "n_bytes", "declared", "media_type", "confirmed", "corrected", "embedded"]).to_pylist()
            for x, cut in zip(said, batch.column("media"), strict=True):
                media = cut.as_py()
                read = samples_of(x["carved_type"], media)
                feature = f"declared={x['declared']};sniffed={x['media_type']};confirmed={x['confirmed']};corrected={x['corrected']};embedded={len(x['embedded'])};type={x['carved_type']};offset={x['offset']};length={len(media)}"
                rows.append((x["id"], x["n_bytes"], len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-ALIGN:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.record_batch([pa.array(c, pa.string() if n in ("payload_sha256", "media_sha256", "feature") else pa.int64()) for n, c in zip(names, cols, strict=True)], names=names)

    return docs.mapInArrow(run, schema)

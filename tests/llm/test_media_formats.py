"""Validators by format: exact lengths, false signatures without end, carving among neighbours."""

import random
import struct
import time
import zlib

import pytest
from pyspark.sql import functions as F

from stratus.llm.media import ENVELOPE, _crc, carve, media_in, op3_signature_sniffing, payload, sniff, to_wav


class Bits:
    def __init__(self):
        self.text = ""

    def add(self, value, width):
        self.text += format(value & ((1 << width) - 1), f"0{width}b") if width else ""

    def bytes(self):
        t = self.text + "0" * (-len(self.text) % 8)
        return int("1" + t, 2).to_bytes(len(t) // 8 + 1, "big")[1:]


def rice(out, values, k):
    out.add(0, 2)
    out.add(0, 4)
    out.add(k, 4)
    for v in values:
        u = 2 * v if v >= 0 else -2 * v - 1
        out.text += "0" * (u >> k) + "1"
        out.add(u, k)


def flac(n_frames=3, samples=192, kinds=("constant", "verbatim"), total=True, seed=1):
    """Two channels of 16 bits, subframes of the given kinds in turn."""
    r = random.Random(seed)
    info = struct.pack(">HH", samples, samples) + bytes(6) + (44100 << 44 | 1 << 41 | 15 << 36 | (n_frames * samples if total else 0)).to_bytes(8, "big") + bytes(16)
    out = b"fLaC" + b"\x80" + len(info).to_bytes(3, "big") + info
    for k in range(n_frames):
        head = b"\xff\xf8" + bytes([0x10, 0x18]) + (bytes([k]) if k < 128 else bytes([0xC0 | k >> 6, 0x80 | k & 63]))
        body = Bits()
        for channel in range(2):
            kind = kinds[(k + channel) % len(kinds)]
            if kind == "constant":
                body.add(0, 8)
                body.add(r.getrandbits(16), 16)
            elif kind == "verbatim":
                body.add(1 << 1, 8)
                for _ in range(samples):
                    body.add(r.getrandbits(16), 16)
            elif kind == "fixed":
                body.add((8 | 1) << 1, 8)
                body.add(r.getrandbits(16), 16)
                rice(body, [r.randint(-40, 40) for _ in range(samples - 1)], 3)
            elif kind == "wasted":
                body.add(1 << 1 | 1, 8)
                body.text += "001"
                for _ in range(samples):
                    body.add(r.getrandbits(13), 13)
            else:
                body.add((32 | 1) << 1, 8)
                body.add(r.getrandbits(32), 32)
                body.add(11, 4)
                body.add(3, 5)
                body.add(r.getrandbits(24), 24)
                rice(body, [r.randint(-9, 9) for _ in range(samples - 2)], 2)
        frame = head + bytes([_crc(head, 8, 0x07)]) + body.bytes()
        out += frame + _crc(frame, 16, 0x8005).to_bytes(2, "big")
    return out


def pdf(parts=1, early=False):
    """A file with one table of places a change; early: a first mark that says 0, as in files written to be read early."""
    out = b"%PDF-1.4\n"
    if early:
        out += b"1 0 obj\n<<>>\nendobj\nstartxref\n0\n%%EOF\n"
    for k in range(parts):
        out += b"%d 0 obj\n<<>>\nendobj\n" % (k + 2)
        at = len(out)
        out += b"xref\n0 1\n0000000000 65535 f \ntrailer <<>>\nstartxref\n%d\n%%%%EOF" % at + b"\n" * (k < parts - 1)
    return out


def bmp(bits, header=40, packing=0, width=5, height=3):
    row = (width * bits + 31) // 32 * 4
    pixels = bytes(range(40)) if packing in (1, 2) else bytes(row * height)
    palette = bytes((4 if header > 12 else 3) << bits) if bits <= 8 else b""
    if header == 12:
        info = struct.pack("<IHHHH", 12, width, height, 1, bits)
    else:
        info = struct.pack("<IiiHHIIiiII", header, width, height, 1, bits, packing, len(pixels), 0, 0, 0, 0)[:header].ljust(header, b"\0")
    start = 14 + len(info) + len(palette)
    return struct.pack("<2sIII", b"BM", start + len(pixels), 0, start) + info + palette + pixels


def jpeg(scans=1, thumbnail=b""):
    out = b"\xff\xd8\xff\xe0\x00\x06JF\0\0"
    if thumbnail:
        out += b"\xff\xe1" + struct.pack(">H", len(thumbnail) + 2) + thumbnail
    out += b"\xff\xc2\x00\x04ab"
    for k in range(scans):
        out += b"\xff\xc4\x00\x06\xff\xd9xy" + b"\xff\xff\xda\x00\x04cd" + b"\x12\xff\x00\x34\xff\xd0\x56" + bytes([k])
    return out + b"\xff\xd9"


def ogg(pages=3, streams=1):
    out = b""
    for k in range(pages):
        for s in range(streams):
            flags = 2 * (k == 0) + 4 * (k == pages - 1)
            body = bytes([k, s]) * 30
            out += b"OggS\0" + bytes([flags]) + bytes(8) + struct.pack("<IIIB", s, k, 0, 1) + bytes([len(body)]) + body
    return out


FILES = {
    "flac": flac(), "flac fixed": flac(4, 192, ("fixed", "constant")), "flac lpc": flac(2, 192, ("lpc", "fixed", "verbatim")), "flac wasted": flac(2, 192, ("wasted",)),
    "flac unknown length": flac(3, 192, ("verbatim", "fixed"), total=False), "flac many": flac(150, 192, ("constant",)), "pdf": pdf(), "pdf changed": pdf(3), "pdf early": pdf(2, early=True),
    **{f"bmp {b} {h} {p}": bmp(b, h, p) for b, h, p in ((1, 40, 0), (4, 40, 0), (8, 40, 0), (16, 40, 0), (24, 40, 0), (32, 40, 3), (8, 40, 1), (4, 40, 2), (24, 12, 0), (8, 12, 0), (24, 108, 0), (32, 124, 3), (24, 64, 0), (16, 52, 3))},
    "jpeg": jpeg(), "jpeg progressive": jpeg(3), "jpeg thumbnail": jpeg(2, jpeg()), "ogg": ogg(), "ogg streams": ogg(3, 2), "wav": to_wav(payload("x")),
}


@pytest.mark.parametrize("name", FILES)
def test_exact_length_of_each_format(name):
    body = FILES[name]
    for before, after in ((b"", b""), (b"junk", b"tail"), (b"\xff", b"\xff\xf8"), (b"BM%PDF-1", b"\0" * 40)):
        found = media_in(before + body + after)
        assert [(at, n) for _, at, n in found] == [(len(before), len(body))], name
    cut = media_in(body[:-3])
    assert not cut or cut[0][1:] != (0, len(body))


def test_neighbours_are_carved_apart():
    r = random.Random(3)
    for _ in range(40):
        names = [r.choice(list(FILES)) for _ in range(r.randint(2, 6))]
        blob, want = b"", []
        for n in names:
            blob += bytes(r.choice(b"abc") for _ in range(r.randint(0, 5)))
            want.append((len(blob), len(FILES[n])))
            blob += FILES[n]
        assert [(at, n) for _, at, n in media_in(blob)] == want, names


@pytest.mark.parametrize("unit", [b"%PDF-1.4", b"%PDF-1.4 xref startxref\n", b"\xff\xd8\xff", b"\xff\xd8\xff\xe0\x00\x02", b"\xff\xd8\xff\xda\x00\x02", b"OggS\0\2" + bytes(20) + b"\1\1", b"BM", b"BM\1\1\1\1\0\0\0\0", b"GIF89a", b"GIF89a\1\1\1\1\0\0\0,,", b"RIFF\xff\xff\xff\0WAVEfmt \x10\0\0\0", b"fLaC\0\0\0\x22", b"fLaC\x80\0\0\x22" + bytes(34) + b"\xff\xf8\x69\x08", b"\x89PNG\r\n\x1a\n\0\0\0\x0dIHDR"])
def test_false_signatures_take_time_in_proportion(unit):
    """Four times the bytes, less than ten times the time; a quadratic walk takes sixteen times as long."""
    took = []
    for size in (250_000, 1_000_000):
        blob = unit * (size // len(unit))
        began = time.perf_counter()
        media_in(blob)
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 0.5 and took[1] < 10


def test_keys_of_any_type_and_columns_that_are_kept(spark):
    wav, other = FILES["wav"], FILES["jpeg"]
    rows = [("a", bytearray(wav), "x"), (None, bytearray(b"--" + other + wav), "y"), ("a", bytearray(wav), "x"), ("b", None, None)]
    df = spark.createDataFrame(rows, "name string, blob binary, note string").withColumn("offset", F.lit("clash"))
    got = sorted(((r.id, r.media_type, len(r.embedded), r.note) for r in sniff(df, key="name", keep=("note",)).collect()), key=str)
    assert got == sorted([("a", "audio/wav", 0, "x"), ("a", "audio/wav", 0, "x"), ("b", None, 0, None), (None, None, 2, "y")], key=str)
    cut = sorted(((r.id, r.offset, bytes(r.media) == wav, r.note) for r in carve(df, key="name", keep=("note",)).collect()), key=str)
    assert cut == sorted([("a", 0, True, "x"), ("a", 0, True, "x"), (None, 2, False, "y"), (None, 2 + len(other), True, "y")], key=str)
    with pytest.raises(ValueError):
        sniff(df, key="name", keep=("offset", "embedded"))
    assert carve(df.limit(0), key="name").count() == 0


def test_query_sniffs_and_carves(spark, tmp_path):
    rows = [(k, f"text {k % 40} " * (k % 7)) for k in range(120)] + [(None, "x"), (1, None), (1, None), (7, "BM RIFF " * 9)]
    spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("clash") for c in ("blob", "media", "id")}).write.parquet(str(tmp_path / "documents.parquet"))
    got = op3_signature_sniffing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got].count(None) == 1
    said = [dict(x.split("=", 1) for x in r.feature.split(";")) for r in got]
    assert {x["embedded"] for x in said} == {"0", "1"} and {x["corrected"] for x in said} == {"true", "false"} or {x["corrected"] for x in said} == {"True", "False"}
    assert all(x["offset"] == str(len(ENVELOPE[0])) if x["embedded"] == "1" else x["offset"] == "0" and x["sniffed"] == x["type"] for x in said)
    assert all(int(x["length"]) == r.media_bytes for x, r in zip(said, got, strict=True))
    by_text = {}
    for r in got:
        by_text.setdefault(r.payload_sha256, set()).add((r.media_sha256, r.feature, r.tail_crc32, r.n_bytes))
    assert all(len(v) == 1 for v in by_text.values())
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert op3_signature_sniffing(spark, str(tmp_path / "none")).count() == 0


def test_checksums():
    assert _crc(b"123456789", 8, 0x07) == 0xF4 and _crc(b"123456789", 16, 0x8005) == 0xFEE8 and zlib.crc32(b"") == 0

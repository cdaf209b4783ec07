import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.llm.media import DECLARED, carve, media_in, op3_signature_sniffing, payload, samples_of, sniff, store, to_bmp, to_png, to_wav

WRITERS = {"audio/wav": to_wav, "image/bmp": to_bmp, "image/png": to_png}
GIF = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\x00\x00\x00\xff\xff\xff,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=300))
def test_payload_round_trip_in_every_container(text):
    p, raw = payload(text), text.encode()
    assert len(p) > 0 and len(p) % 64 == 0 and p[: len(raw)] == raw and not any(p[len(raw) :]) and len(p) - len(raw) <= 64
    for kind, write in WRITERS.items():
        stored = write(p)
        assert media_in(stored)[0] == (kind, 0, len(stored))
        assert samples_of(kind, stored) == p


@pytest.mark.parametrize("text", ["BM and RIFF WAVE and GIF89a; and %PDF-1.4 ÿØ", "OggS fLaC", "\x89PNG\r\n\x1a\n"])
def test_magic_in_text_is_no_media(text):
    assert media_in(text.encode("latin-1", "replace")) == []
    stored = store(text)
    assert len(media_in(stored)) == 1


def test_embedded_and_broken_media():
    wav, png = to_wav(payload("hello")), to_png(payload("world"))
    blob = b"junk" + wav + b"--" + png + GIF
    assert media_in(blob) == [("audio/wav", 4, len(wav)), ("image/png", 6 + len(wav), len(png)), ("image/gif", 6 + len(wav) + len(png), len(GIF))]
    assert media_in(wav[:-1]) == [] and media_in(png[:-5]) == []
    spoiled = bytearray(png)
    spoiled[40] ^= 1
    assert media_in(bytes(spoiled)) == []
    assert media_in(None) == media_in(b"") == []


def test_sniff_corrects_declared_types(spark):
    wav = to_wav(payload("x"))
    rows = [(1, bytearray(wav), "image/png"), (2, bytearray(wav), "audio/wav"), (3, bytearray(b"text"), "text/plain"), (4, None, None), (5, bytearray(b""), "a/b"), (6, bytearray(wav + wav), None)]
    df = spark.createDataFrame(rows, "id bigint, blob binary, type string").withColumn("media_type", F.lit("clash"))
    got = {r.id: (r.declared, r.media_type, r.confirmed, r.corrected, len(r.embedded)) for r in sniff(df, "blob", "type").collect()}
    assert got == {1: ("image/png", "audio/wav", True, True, 0), 2: ("audio/wav", "audio/wav", True, False, 0), 3: ("text/plain", "text/plain", False, False, 0), 4: (None, None, False, False, 0), 5: ("a/b", "a/b", False, False, 0), 6: (None, "audio/wav", True, True, 1)}
    cut = {(r.id, r.offset): bytes(r.media) for r in carve(df).collect()}
    assert cut[(6, len(wav))] == wav and len(cut) == 4
    assert sniff(df.limit(0)).count() == 0


def test_query_against_hashes(spark, tmp_path):
    rows = [(1, "abc"), (2, "abc"), (3, None), (4, ""), (5, "é" * 64), (6, "y" * 2_000_000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("feature", F.lit(0)).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op3_signature_sniffing(spark, str(tmp_path)).collect()}
    for i, t in rows:
        p, stored = payload(t), store(t)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        said = dict(x.split("=", 1) for x in r.feature.split(";"))
        assert said["declared"] in DECLARED and said["type"] == media_in(stored)[0][0] and said["sniffed"] == (said["declared"] if said["embedded"] == "1" else said["type"])
    assert got[1].feature == got[2].feature and got[3].payload_sha256 == got[4].payload_sha256

"""The media column: exact round trips, a general baseline decoder, shots."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from llm_rows import ODD
from weftgraph.llm import media

# The usual Huffman tables for luminance (counts by length, then symbols), of which these tests need the DC one.
DC_COUNTS, DC_SYMBOLS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0), tuple(range(12))


def jpeg(blocks: np.ndarray, width: int, height: int, restart: int = 0, quant: int = 2) -> bytes:
    """A small baseline encoder: (n, 64) coefficients in stored order; AC symbols take 8 bits each."""
    table, code, n = {}, 0, 0
    for length, c in enumerate(DC_COUNTS, 1):
        for _ in range(c):
            table[DC_SYMBOLS[n]] = (length, code)
            code, n = code + 1, n + 1
        code <<= 1
    symbols = sorted({0x00, 0xF0, *(r << 4 | s for r in range(16) for s in range(1, 11))})
    ac = {s: (8 if i < 100 else 9, i if i < 100 else 200 + i - 100) for i, s in enumerate(symbols)}

    def amplitude(v: int) -> str:
        s = abs(v).bit_length()
        return f"{v if v > 0 else v + (1 << s) - 1:0{s}b}" if s else ""

    out, bits, last = b"", "", 0

    def flush() -> bytes:
        padded = bits + "1" * (-len(bits) % 8)
        return int(padded, 2).to_bytes(len(padded) // 8, "big").replace(b"\xff", b"\xff\0") if padded else b""

    for k, b in enumerate(blocks.tolist()):
        if restart and k and k % restart == 0:
            out += flush() + bytes([0xFF, 0xD0 + (k // restart - 1) % 8])
            bits, last = "", 0
        d, last = b[0] - last, b[0]
        length, c = table[abs(d).bit_length()]
        bits += f"{c:0{length}b}" + amplitude(d)
        run = 0
        top = max((i for i in range(1, 64) if b[i]), default=0)
        for i in range(1, top + 1):
            if b[i] == 0:
                run += 1
                continue
            while run > 15:
                length, c = ac[0xF0]
                bits += f"{c:0{length}b}"
                run -= 16
            length, c = ac[run << 4 | abs(b[i]).bit_length()]
            bits += f"{c:0{length}b}" + amplitude(b[i])
            run = 0
        if top < 63:
            length, c = ac[0]
            bits += f"{c:0{length}b}"
    seg = media._segment
    counts = [0] * 16
    counts[7], counts[8] = 100, len(symbols) - 100
    head = b"\xff\xd8" + seg(0xE0, b"JFIF\0") + seg(0xDB, b"\0" + bytes([quant]) * 64) + seg(0xC0, struct.pack(">BHHBBBB", 8, height, width, 1, 1, 0x11, 0))
    head += seg(0xC4, b"\x00" + bytes(DC_COUNTS) + bytes(DC_SYMBOLS)) + seg(0xC4, b"\x10" + bytes(counts) + bytes(symbols))
    if restart:
        head += seg(0xDD, struct.pack(">H", restart))
    return head + seg(0xDA, b"\1\1\0\0\x3f\0") + out + flush() + b"\xff\xd9"


@pytest.mark.parametrize("restart", [0, 2])
def test_general_frames(restart):
    rnd = np.random.default_rng(restart)
    blocks = np.zeros((6, 64), np.int64)
    blocks[:, 0] = rnd.integers(-200, 200, 6)
    blocks[:, rnd.integers(1, 64, 9)] = rnd.integers(-60, 60, 9)
    got = media.decode_luma(jpeg(blocks, 20, 13, restart))
    grid = media.to_pixels(blocks * 2).reshape(2, 3, 8, 8).transpose(0, 2, 1, 3).reshape(16, 24)
    assert got.shape == (13, 20) and (got == grid[:13, :20]).all()


def test_flat_block_is_its_level():
    b = np.zeros((1, 64), np.int64)
    b[0, 0] = 80
    assert (media.decode_luma(jpeg(b, 8, 8, quant=1)) == 138).all()


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 70])
def test_bytes_round_trip(n):
    p = np.random.default_rng(n).integers(0, 256, 64 * n, dtype=np.uint8).tobytes()
    a = media.parse_avi(media.write_bytes(p))
    assert media.read_bytes(a)[0] == p
    f = a.frames[-1]
    at = media._find_scan(f)
    general = media._general(media._header(f[:at]), f[at:])[1].reshape(-1, 64)
    assert (general == media.flat_values(media.flat_blocks(f))).all()


def test_avi_without_index_and_broken_files():
    whole = media.write_bytes(b"x" * 64 * 70)
    cut = whole[: whole.rindex(b"idx1")]
    cut = cut[:4] + struct.pack("<I", len(cut) - 8) + cut[8:]
    assert media.parse_avi(cut).frames == media.parse_avi(whole).frames
    with pytest.raises(ValueError):
        media.parse_avi(b"RIFFxxxxWAVE")


def test_shots():
    dark, light = np.zeros((8, 8), np.uint8), np.full((8, 8), 200, np.uint8)
    hist = media.histograms([dark] * 5 + [light] * 5 + [dark] * 2)
    assert media.shots(hist) == [0, 5, 10]
    assert [(c["first_frame"], c["n_frames"], c["start_s"], c["end_s"]) for c in media.clip_rows(hist, 10)] == [(0, 5, 0.0, 0.5), (5, 5, 0.5, 1.0), (10, 2, 1.0, 1.2)]
    assert media.shots(media.histograms([])) == []


def test_columns(spark, docs):
    rows = {(r.doc_id, r.n_bytes): r for r in media.read_media(media.store_text(docs(ODD))).collect()}
    for d, t in ODD:
        body = (t or "").encode()
        r = rows[(d, len(body))]
        assert bytes(r.payload) == body + b"\0" * (-len(body) % 64 or (0 if body else 64)) and r.clips[0].first_frame == 0
        assert sum(c.n_frames for c in r.clips) == -(-len(r.payload) // (64 * media.FRAME_BLOCKS)) and r.clips[-1].end_s > 0
    assert media.store_text(docs([])).count() == 0


def test_pictures_and_junk(spark):
    b = np.zeros((1, 64), np.int64)
    frames = [jpeg(np.where(np.arange(64) == 0, v, b), 8, 8) for v in (0, 0, 0, 100, 100)]
    df = spark.createDataFrame([(1, bytearray(media.write_avi(frames, 8, 8))), (2, bytearray(b"junk")), (3, None)], "id long, media binary")
    assert [(r.id, r.clip, r.first_frame, r.n_frames) for r in media.clips(df, ["id"]).orderBy("clip").collect()] == [(1, 0, 0, 3), (1, 1, 3, 2)]
    assert {r.id: r.clips is None for r in media.read_media(df).collect()} == {1: False, 2: True, 3: True}

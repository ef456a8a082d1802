"""AVI motion-JPEG columns: writing, index parsing, intra-frame decoding, shots and clips."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from .common import arrow_schema

FPS = 10
#: Blocks of 8 x 8 in a frame of stored bytes.
FRAME_BLOCKS = 32
BINS = 16
#: A shot begins where the histogram difference exceeds the mean of the differences
#: before it (LOOK_BACK of them at most) by SPREAD deviations, and LEAST in any case.
LOOK_BACK, SPREAD, LEAST = 12, 3.0, 0.15
OUT_BYTES = 1 << 23


def _zigzag() -> np.ndarray:
    """Row-major places of the 64 coefficients in their stored order."""
    walk = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in walk])


ZIGZAG = _zigzag()


@lru_cache(1)
def _basis() -> np.ndarray:
    """(coefficient in stored order, pixel) of the inverse DCT, times 4096, in whole
    numbers: sums stay exact in doubles, whatever order a product adds them in."""
    x = np.arange(8)
    c = np.where(x == 0, np.sqrt(0.5), 1.0)[:, None] * np.cos((2 * x[None, :] + 1) * x[:, None] * np.pi / 16) / 2
    return np.rint(np.einsum("ux,vy->uvxy", c, c).reshape(64, 64)[ZIGZAG] * 4096)


def to_pixels(coefficients: np.ndarray) -> np.ndarray:
    """(n, 64) dequantised coefficients in stored order to (n, 64) samples."""
    return np.clip(np.floor(coefficients.astype(np.float64) @ _basis() / 4096 + 128.5), 0, 255).astype(np.uint8)


# --- JPEG ---------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


@lru_cache(64)
def _flat_header(blocks: int) -> bytes:
    """Header of a baseline frame of ``blocks`` x 1 blocks. Quantisers are 1; either Huffman
    table has one code, the bit 0, for a coefficient of 8 bits; every block restarts."""
    one = bytes([1] + [0] * 15)
    return (
        b"\xff\xd8" + _segment(0xDB, b"\0" + b"\1" * 64) + _segment(0xC0, struct.pack(">BHHBBBB", 8, 8, 8 * blocks, 1, 1, 0x11, 0))
        + _segment(0xC4, b"\x00" + one + b"\x08") + _segment(0xC4, b"\x10" + one + b"\x08") + _segment(0xDD, b"\0\1")
        + _segment(0xDA, b"\1\1\0\0\x3f\0")
    )


def _spread(payload: np.ndarray) -> np.ndarray:
    """(n, 64) bytes to (n, 72): a bit 0, the code, before each byte, its coefficient's 8 bits."""
    b = payload.reshape(-1, 8).astype(np.uint16)
    out = np.empty((len(b), 9), np.uint16)
    out[:, 0] = b[:, 0] >> 1
    for j in range(1, 8):
        out[:, j] = (b[:, j - 1] & ((1 << j) - 1)) << (8 - j) | b[:, j] >> (j + 1)
    out[:, 8] = b[:, 7]
    return out.astype(np.uint8).reshape(-1, 72)


def _gather(coded: np.ndarray) -> np.ndarray:
    """The inverse of _spread."""
    o = coded.reshape(-1, 9).astype(np.uint16)
    out = np.empty((len(o), 8), np.uint16)
    for j in range(8):
        out[:, j] = (o[:, j] << (j + 1)) & 0xFF | o[:, j + 1] >> (7 - j)
    return out.astype(np.uint8).reshape(-1, 64)


@dataclass
class Picture:
    """What the header of a frame says."""

    width: int
    height: int
    parts: list[tuple[int, int, int, int]]  # id, horizontal and vertical sampling, quantiser
    quant: dict[int, np.ndarray]
    codes: dict[int, dict[tuple[int, int], int]]  # (length, code) -> symbol; AC tables from 16
    scan: list[tuple[int, int, int]]  # id, DC and AC table
    restart: int
    begin: int

    @property
    def flat(self) -> bool:
        """Whether every coefficient takes the bit 0 and 8 bits, and every block restarts."""
        one = {(1, 0): 8}
        return len(self.parts) == 1 and self.restart == 1 and self.parts[0][1:3] == (1, 1) and self.codes[self.scan[0][1]] == one and self.codes[16 + self.scan[0][2]] == one


def _find_scan(data: bytes) -> int:
    at = 2
    while data[at + 1] != 0xDA:
        at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return at + 2 + int.from_bytes(data[at + 2 : at + 4], "big")


@lru_cache(256)
def _header(head: bytes) -> Picture:
    if head[:2] != b"\xff\xd8":
        raise ValueError("no JPEG frame")
    p, at = Picture(0, 0, [], {}, {}, [], 0, len(head)), 2
    while at < len(head):
        marker, size = head[at + 1], int.from_bytes(head[at + 2 : at + 4], "big")
        body = head[at + 4 : at + 2 + size]
        if marker == 0xDB:
            while body:
                wide, k = body[0] >> 4, body[0] & 15
                n = 128 if wide else 64
                p.quant[k] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else "u1").astype(np.int64)
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                k, counts = (body[0] >> 4) * 16 + (body[0] & 15), body[1:17]
                code, n, table = 0, 17, {}
                for length, c in enumerate(counts, 1):
                    for _ in range(c):
                        table[(length, code)] = body[n]
                        code, n = code + 1, n + 1
                    code <<= 1
                p.codes[k] = table
                body = body[n:]
        elif marker in (0xC0, 0xC1):
            bits, p.height, p.width, n = struct.unpack(">BHHB", body[:6])
            if bits != 8:
                raise ValueError("only 8-bit samples are decoded")
            p.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("only baseline frames are decoded")
        elif marker == 0xDD:
            p.restart = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            p.scan = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
        at += 2 + size
    return p


def _intervals(scan: bytes) -> list[bytes]:
    """The entropy-coded stretches between restart markers, without stuffed zeros."""
    out, begin, at = [], 0, scan.find(b"\xff")
    while at >= 0:
        after = scan[at + 1] if at + 1 < len(scan) else 0xD9
        if after and after != 0xFF:
            out.append(scan[begin:at].replace(b"\xff\0", b"\xff"))
            begin = at + 2
            if not 0xD0 <= after <= 0xD7:
                return out
        at = scan.find(b"\xff", at + 1 + (after == 0))
    return [*out, scan[begin:].replace(b"\xff\0", b"\xff")]


class _Bits:
    def __init__(self, data: bytes):
        self.value, self.left = int.from_bytes(data + b"\xff" * 8, "big"), 8 * (len(data) + 8)

    def take(self, n: int) -> int:
        self.left -= n
        return self.value >> self.left & ((1 << n) - 1)

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            out = table.get((length, code))
            if out is not None:
                return out
        raise ValueError("a code that no table has")

    def signed(self, n: int) -> int:
        v = self.take(n) if n else 0
        return v if not n or v >> (n - 1) else v - (1 << n) + 1


def _general(p: Picture, scan: bytes) -> dict[int, np.ndarray]:
    """Per component, its blocks' coefficients as (rows, columns, 64) in stored order."""
    most_h, most_v = max(c[1] for c in p.parts), max(c[2] for c in p.parts)
    mcu_x, mcu_y = -(-p.width // (8 * most_h)), -(-p.height // (8 * most_v))
    by_id = {c[0]: c for c in p.parts}
    if len(p.parts) == 1:
        by_id = {c[0]: (c[0], 1, 1, c[3]) for c in p.parts}
        mcu_x, mcu_y = -(-p.width // 8), -(-p.height // 8)
    out = {i: np.zeros((mcu_y * c[2], mcu_x * c[1], 64), np.int64) for i, c in by_id.items()}
    total, done = mcu_x * mcu_y, 0
    for part in _intervals(scan):
        bits, last = _Bits(part), dict.fromkeys(by_id, 0)
        for _ in range(min(p.restart or total, total - done)):
            y, x = divmod(done, mcu_x)
            for i, dc, ac in p.scan:
                _, h, v, _ = by_id[i]
                for k in range(h * v):
                    block = out[i][y * v + k // h, x * h + k % h]
                    last[i] += bits.signed(bits.symbol(p.codes[dc]))
                    block[0], at = last[i], 1
                    while at < 64:
                        s = bits.symbol(p.codes[16 + ac])
                        if s == 0:
                            break
                        at += s >> 4
                        if s != 0xF0 and at < 64:
                            block[at] = bits.signed(s & 15)
                        at += 1
            done += 1
    return out


def flat_blocks(frame: bytes) -> np.ndarray | None:
    """The (n, 64) bytes behind the coefficients of a frame of stored bytes; None for any other frame."""
    begin = _find_scan(frame)
    p = _header(frame[:begin])
    if not p.flat:
        return None
    n = -(-p.width // 8) * -(-p.height // 8)
    scan = np.frombuffer(frame, np.uint8, offset=begin)
    if len(scan) >= 74 * n:
        rows = scan[: 74 * n].reshape(n, 74)
        coded = rows[:, :72]
        if (rows[:, 72] == 0xFF).all() and (coded != 0xFF).all():
            return _gather(coded)
    parts = _intervals(frame[begin:])[:n]
    if any(len(x) != 72 for x in parts) or len(parts) != n:
        raise ValueError("a frame of stored bytes is cut short")
    return _gather(np.frombuffer(b"".join(parts), np.uint8))


def flat_values(stored: np.ndarray) -> np.ndarray:
    """The coefficients that 8 bits stand for: 128 to 255, and -255 to -128."""
    v = stored.astype(np.int16)
    return np.where(v >= 128, v, v - 255)


def decode_luma(frame: bytes) -> np.ndarray:
    """The first component of a baseline frame as (height, width) samples."""
    begin = _find_scan(frame)
    p = _header(frame[:begin])
    first = p.parts[0]
    stored = flat_blocks(frame)
    if stored is not None:
        blocks = flat_values(stored).reshape(-(-p.height // 8), -(-p.width // 8), 64)
    else:
        blocks = _general(p, frame[begin:])[first[0]]
    pixels = to_pixels(blocks.reshape(-1, 64) * p.quant[first[3]]).reshape(*blocks.shape[:2], 8, 8)
    whole = pixels.transpose(0, 2, 1, 3).reshape(8 * blocks.shape[0], 8 * blocks.shape[1])
    return whole[: p.height, : p.width]


# --- AVI ------------------------------------------------------------------------


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def _list(name: bytes, body: bytes) -> bytes:
    return _chunk(b"LIST", name + body)


def write_avi(frames: list[bytes], width: int, height: int, fps: int = FPS, extra: bytes = b"") -> bytes:
    """One video stream of motion JPEG with its index; ``extra`` goes into the stream's data chunk."""
    biggest = max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // fps, biggest * fps, 0, 0x10, len(frames), 0, 1, biggest, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, fps, 0, len(frames), biggest, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", 3 * width * height, 0, 0, 0, 0)
    strl = _list(b"strl", _chunk(b"strh", strh) + _chunk(b"strf", strf) + (_chunk(b"strd", extra) if extra else b""))
    index, movi, at = [], [], 4
    for f in frames:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(_chunk(b"00dc", f))
        at += len(movi[-1])
    body = _list(b"hdrl", _chunk(b"avih", avih) + strl) + _list(b"movi", b"".join(movi)) + _chunk(b"idx1", b"".join(index))
    return _chunk(b"RIFF", b"AVI " + body)


@dataclass
class Avi:
    width: int = 0
    height: int = 0
    fps: float = 0.0
    extra: bytes = b""
    frames: list[bytes] = field(default_factory=list)


def parse_avi(data: bytes) -> Avi:
    """The first video stream. Frames come by the index, whose offsets count from the
    movi list or from the file's start; without an index, by walking the list."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    out, movi, index = Avi(), (0, 0), b""

    def walk(at: int, end: int) -> None:
        nonlocal movi, index
        while at + 8 <= end:
            name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            body = at + 8
            if name == b"LIST":
                kind = data[body : body + 4]
                if kind == b"movi":
                    movi = (body, body + size)
                else:
                    walk(body + 4, min(end, body + size))
            elif name == b"avih":
                out.fps = 1e6 / max(1, int.from_bytes(data[body : body + 4], "little"))
                out.width, out.height = struct.unpack("<II", data[body + 32 : body + 40])
            elif name == b"strd":
                out.extra = data[body : body + size]
            elif name == b"idx1":
                index = data[body : body + size]
            at = body + size + size % 2

    walk(12, min(len(data), 8 + int.from_bytes(data[4:8], "little")))
    for k in range(0, len(index) - 15, 16):
        name, _, at, size = struct.unpack("<4sIII", index[k : k + 16])
        if name[2:] in (b"dc", b"db"):
            at += movi[0] if data[movi[0] + at : movi[0] + at + 4] == name else 0
            if data[at : at + 4] != name:
                raise ValueError("the index points beside its frame")
            out.frames.append(data[at + 8 : at + 8 + size])
    if not index:
        at = movi[0] + 4
        while at + 8 <= movi[1]:
            name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            if name[2:] in (b"dc", b"db"):
                out.frames.append(data[at + 8 : at + 8 + size])
            at += 8 + size + size % 2
    return out


def write_bytes(payload: bytes) -> bytes:
    """An AVI file whose frames' coefficients are the payload's bytes (a multiple of 64)."""
    blocks = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    n = len(blocks)
    k = min(FRAME_BLOCKS, n)
    count = -(-n // k)
    rows = np.empty((count * k, 74), np.uint8)
    rows[:n, :72] = _spread(blocks)
    rows[n:, :72] = 0
    rows[:, 72] = 0xFF
    rows[:, 73] = 0xD0 + np.arange(count * k) % k % 8
    rows[k - 1 :: k, 73] = 0xD9
    head, frames = _flat_header(k), []
    odd = (rows[:, :72] == 0xFF).any(1)
    for f in range(0, count * k, k):
        part = rows[f : f + k]
        if odd[f : f + k].any():
            frames.append(head + b"".join(r[:72].tobytes().replace(b"\xff", b"\xff\0") + r[72:].tobytes() for r in part))
        else:
            frames.append(head + part.tobytes())
    return write_avi(frames, 8 * k, 8, extra=struct.pack("<Q", len(payload)))


def read_bytes(avi: Avi) -> tuple[bytes, np.ndarray]:
    """The payload of a file of write_bytes, and its blocks (padding of the last frame included)."""
    parts = [flat_blocks(f) for f in avi.frames]
    if len(avi.extra) != 8 or any(p is None for p in parts):
        raise ValueError("not a file of stored bytes")
    blocks = np.concatenate(parts)
    return blocks.tobytes()[: struct.unpack("<Q", avi.extra)[0]], blocks


# --- Shots and clips ---------------------------------------------------------------


def histograms(frames: list[np.ndarray]) -> np.ndarray:
    return np.array([np.bincount(f.ravel() >> 4, minlength=BINS) for f in frames], np.int64).reshape(-1, BINS)


def shots(hist: np.ndarray) -> list[int]:
    """First frames of the shots."""
    if not len(hist):
        return []
    share = hist / np.maximum(1, hist.sum(1, keepdims=True))
    step = np.abs(np.diff(share, axis=0)).sum(1) / 2
    out, since = [0], 0
    for i, d in enumerate(step.tolist()):
        before = step[max(since, i - LOOK_BACK) : i]
        level = LEAST if not len(before) else max(LEAST, float(before.mean()) + SPREAD * float(before.std()))
        if d > level:
            out.append(i + 1)
            since = i + 1
    return out


def clip_rows(hist: np.ndarray, fps: float) -> list[dict]:
    """A row per shot: frames, times and the mean sample (in 256ths of a bin)."""
    begins = shots(hist)
    out = []
    for k, (a, b) in enumerate(zip(begins, [*begins[1:], len(hist)], strict=True)):
        h = hist[a:b].sum(0)
        out.append({"clip": k, "first_frame": a, "n_frames": b - a, "start_s": round(a / fps, 3), "end_s": round(b / fps, 3), "level": int((h * np.arange(BINS)).sum() * 256 // max(1, int(h.sum())))})
    return out


CLIPS = "clips array<struct<clip int, first_frame int, n_frames int, start_s double, end_s double, level int>>"


def _batches(rows: Iterator[tuple], names: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows whose last field but the first is the large one, in batches of bounded bytes."""
    out: list[tuple] = []
    held = 0
    for size, row in rows:
        out.append(row)
        held += size
        if held >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), names, strict=True)], schema=names)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), names, strict=True)], schema=names)


def store_text(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8 bytes, padded with zeros to a positive
    multiple of 64, as the coefficients of a motion-JPEG file. Null texts count as empty;
    each row stands alone, so that equal texts give equal files, repeated rows too, and ties need
    no rule; null ids are kept as they are; other columns are ignored; an empty table gives no
    rows. A very long text is one file, which a task holds at about 12 bytes for each byte."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    schema = _parse_datatype_string(f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for b in batches:
                for doc_id, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    data = t.as_buffer().to_pybytes() if t.is_valid else b""
                    media = write_bytes(data + b"\0" * (-len(data) % 64 or (0 if data else 64)))
                    yield len(media), (doc_id, len(data), media)

        yield from _batches(made(), names)

    return rows.mapInArrow(run, schema)


def read_media(media: DataFrame, media_col: str = "media", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, payload and clips of each file. ``payload`` is null for a file that
    holds pictures rather than stored bytes; a null or unreadable file has null for both. Each
    row stands alone, repeated ones too; an empty table gives no rows; a very long file is read
    whole by one task."""
    keep = keep or [c for c in media.columns if c != media_col]
    rows = media.select(*keep, F.col(media_col).alias("media"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = _parse_datatype_string(f"{fields}, media binary, payload binary, {CLIPS}")
    names = arrow_schema(schema)

    def one(data: bytes | None) -> tuple:
        try:
            avi = parse_avi(data or b"")
            if len(avi.extra) == 8 and avi.frames:
                payload, blocks = read_bytes(avi)
                pixels = to_pixels(flat_values(blocks))
                per = len(blocks) // len(avi.frames)
                at = np.repeat(np.arange(len(avi.frames)) * BINS, 64 * per)
                hist = np.bincount(at + (pixels.ravel() >> 4), minlength=BINS * len(avi.frames)).reshape(-1, BINS)
            else:
                payload, hist = None, histograms([decode_luma(f) for f in avi.frames])
        except (ValueError, IndexError, KeyError, struct.error):
            return None, None
        return payload, clip_rows(hist, avi.fps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for b in batches:
                for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
                    yield 2 * len(row[-1] or b""), (*row, *one(row[-1]))

        yield from _batches(made(), names)

    return rows.mapInArrow(run, schema)


def clips(media: DataFrame, keep: list[str]) -> DataFrame:
    """One row per clip: the kept columns, clip, first_frame, n_frames, start_s, end_s, level."""
    return read_media(media, keep=keep).select(*keep, F.inline("clips"))

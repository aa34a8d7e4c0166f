"""Media columns: PNG encoding, checked decoding, and low-frequency cosine-transform hashes in binary columns."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices, texts

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples of a row; a payload is padded to whole rows.
WIDTH = 576
#: Side of the reduced picture and of its kept low-frequency corner.
REDUCED, KEPT = 32, 8


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def encode(payload: bytes, width: int = WIDTH, level: int = 1) -> bytes:
    """An 8-bit grey PNG whose samples are the payload, row by row.

    A row is stored by the left or the upper neighbour's differences (filters 1 and 2) where three quarters of those are
    zero, the left ones first; else as it is (filter 0), which for text gives less than differences do.
    """
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    lines = np.zeros((len(rows), width + 1), np.uint8)
    lines[:, 1:] = rows
    for kind, before in ((2, np.vstack([np.zeros((1, width), np.uint8), rows[:-1]])), (1, np.hstack([np.zeros((len(rows), 1), np.uint8), rows[:, :-1]]))):
        alike = np.flatnonzero(4 * (rows == before).sum(1) >= 3 * width)
        lines[alike, 0], lines[alike, 1:] = kind, rows[alike] - before[alike]
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + chunk(b"IEND", b"")


def chunks(data: bytes):
    """(kind, body) of each chunk; ValueError if the signature, a length or a checksum is wrong."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at = 8
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("cut short")
        n, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + n]
        if len(body) != n or at + 12 + n > len(data) or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"wrong checksum of {kind!r}")
        yield kind, body
        at += 12 + n
        if kind == b"IEND":
            return
    raise ValueError("no end")


def unfilter(lines: np.ndarray, bpp: int) -> np.ndarray:
    """Samples of filtered lines (kind in column 0). Runs of lines without a filter and Up runs go at once; Sub is a running sum."""
    kinds, out = lines[:, 0], lines[:, 1:].copy()
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown filter")
    above = np.zeros(out.shape[1], np.uint8)
    y = 0
    while y < len(out):
        kind, row = kinds[y], out[y]
        if kind == 0:
            later = np.flatnonzero(kinds[y:])
            y = y + int(later[0]) if len(later) else len(out)
            above = out[y - 1]
            continue
        if kind == 1:
            for c in range(bpp):
                row[c::bpp] = np.cumsum(row[c::bpp], dtype=np.uint8)
        elif kind == 2:
            row += above
        else:
            left = np.zeros(bpp, np.int16)
            corner = np.zeros(bpp, np.int16)
            up16 = above.astype(np.int16)
            for x in range(0, len(row), bpp):
                up = up16[x : x + bpp]
                if kind == 3:
                    guess = (left + up) >> 1
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left, corner = (row[x : x + bpp] + guess) & 255, up
                row[x : x + bpp] = left
        above = row
        y += 1
    return out


def decode(data: bytes) -> np.ndarray:
    """Height x width x channels samples of an 8-bit, non-interlaced grey, RGB, grey-alpha or RGBA PNG, with every checksum tested."""
    head, body = None, []
    for kind, part in chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
    if head is None or head[2] != 8 or head[3] not in (0, 2, 4, 6) or head[4] or head[5] or head[6]:
        raise ValueError("unsupported header")
    bpp = {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    raw = zlib.decompress(b"".join(body))
    if len(raw) != head[1] * (head[0] * bpp + 1):
        raise ValueError("wrong length")
    lines = np.frombuffer(raw, np.uint8).reshape(head[1], -1)
    return unfilter(lines, bpp).reshape(head[1], head[0], bpp)


def _cosines(n: int = REDUCED, k: int = KEPT) -> np.ndarray:
    return np.cos(np.pi / n * (np.arange(n) + 0.5)[None, :] * np.arange(k)[:, None])


COSINES = _cosines()


def reduced(picture: np.ndarray, n: int = REDUCED) -> np.ndarray:
    """Block means on an n x n grid; grids finer than the picture repeat its samples."""
    out = picture.astype(np.float64)
    for axis in (0, 1):
        size = out.shape[axis]
        at = np.arange(n + 1) * size // n
        low, high = at[:-1], np.maximum(at[1:], at[:-1] + 1)
        sums = np.concatenate([np.zeros_like(np.take(out, [0], axis)), np.cumsum(out, axis)], axis)
        width = (high - low).reshape((-1, 1) if axis == 0 else (1, -1))
        out = (np.take(sums, high, axis) - np.take(sums, low, axis)) / width
    return out


def cosine_hash(picture: np.ndarray) -> bytes:
    """64 bits: each of the 8 x 8 lowest cosine coefficients above their median (the constant one left out of it)."""
    grey = picture[:, :, 0] if picture.shape[2] < 3 else picture[:, :, :3].mean(2)
    low = (COSINES @ reduced(grey) @ COSINES.T).round(6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes()


def payload_of(text: str) -> tuple[bytes, int]:
    """UTF-8 of the text, 255s up to a positive multiple of the row width; and its length before."""
    data = text.encode("utf-8", "surrogatepass")
    n = len(data)
    return data + b"\xff" * (-n % WIDTH if n else WIDTH), n


SCHEMA = "doc_id long, n_bytes long, media binary, payload binary, dct_hash binary"


def media_columns(docs: DataFrame) -> DataFrame:
    """Each text as a PNG: doc_id, n_bytes, media (the PNG), payload (as read back from it) and dct_hash (8 bytes).

    Null texts count as empty; an empty text is one row of 255s. Equal texts give equal values. An empty table gives no
    rows. Reads doc_id and text alone. A stored form that fails a checksum raises ValueError, which fails the task.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text in part.column("text").to_pylist():
                    payload, n = payload_of(text)
                    media = encode(payload)
                    picture = decode(media)
                    rows.append((n, media, picture.tobytes(), cosine_hash(picture)))
                n, media, back, dct = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(media, pa.binary()), pa.array(back, pa.binary()), pa.array(dct, pa.binary())], names=["doc_id", "n_bytes", "media", "payload", "dct_hash"])

    return mapped(texts(docs), run, SCHEMA)


def digest(docs: DataFrame) -> DataFrame:
    """Sizes and digests of media_columns' payloads and media, a row a document; odd rows as there."""
    made = media_columns(docs)
    tail = F.expr("substring(payload, greatest(length(payload) - 31, 1), 32)")
    return made.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.lower(F.hex("dct_hash")).alias("feature"),
    )

"""PNG of 8-bit RGBA or grey arrays, and back."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
COLOURS = {1: 0, 2: 4, 3: 2, 4: 6}


def encode(picture: np.ndarray, level: int = 6) -> bytes:
    """picture: height x width (x channels) uint8."""
    p = np.atleast_3d(np.asarray(picture, np.uint8))
    height, width, channels = p.shape
    lines = np.concatenate([np.zeros((height, 1), np.uint8), p.reshape(height, -1)], 1).tobytes()

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, COLOURS[channels], 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, level)) + chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """height x width x channels of a PNG as encode() writes it; other filters than 0 are refused."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + part):
            raise ValueError("wrong checksum")
        head = struct.unpack(">IIBBBBB", part) if kind == b"IHDR" else head
        body += part if kind == b"IDAT" else b""
        at += 12 + n
    channels = {v: k for k, v in COLOURS.items()}[head[3]]
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(head[1], -1)
    if lines[:, 0].any():
        raise ValueError("unsupported filter")
    return lines[:, 1:].reshape(head[1], head[0], channels)

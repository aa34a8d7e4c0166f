"""Self-describing scenes as text: one Avro record, base64, a line each; runs of zeros are left out.

Record: metadata map<string>, bands array<string>, height, width, depth, dtype, itemsize int, nbytes long, fortran boolean,
byteorder enum, data array<record(index long, strip bytes)>.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The symbols of the byte order, and the number that means a double.
ORDERS = ("LittleEndian", "BigEndian", "NativeEndian", "IgnoreEndian")
DOUBLE = 12


@dataclass
class Scene:
    picture: np.ndarray
    bands: list[str]
    metadata: dict[str, str] = field(default_factory=dict)


def _long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n & ~0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _bytes(b: bytes) -> bytes:
    return _long(len(b)) + b


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def long(self) -> int:
        n = shift = 0
        while True:
            b = self.data[self.at]
            self.at += 1
            n |= (b & 0x7F) << shift
            if b < 0x80:
                return (n >> 1) ^ -(n & 1)
            shift += 7

    def bytes(self) -> bytes:
        n = self.long()
        if n < 0 or self.at + n > len(self.data):
            raise ValueError("cut short")
        self.at += n
        return self.data[self.at - n : self.at]

    def blocks(self):
        """Item after item of an array or map, whose blocks may state their size."""
        while (n := self.long()) != 0:
            if n < 0:
                n = -n
                self.long()
            yield from range(n)


def checked(scene: Scene) -> Scene:
    p = scene.picture
    if p.ndim != 3 or not p.size:
        raise ValueError("a picture has rows, columns and bands")
    if p.shape[2] != len(scene.bands):
        raise ValueError(f"{p.shape[2]} planes for {len(scene.bands)} bands")
    if not all(isinstance(x, str) for kv in scene.metadata.items() for x in kv):
        raise TypeError("metadata is text by text")
    return scene


def strips(flat: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(index, cells) of each maximal run of cells that aren't 0."""
    edge = np.flatnonzero(np.diff(np.r_[False, flat != 0, False].astype(np.int8)))
    return [(int(i), flat[i:j]) for i, j in zip(edge[::2], edge[1::2], strict=True)]


def encode(scene: Scene, order: str = "LittleEndian", fortran: bool = False) -> bytes:
    """The record as base64."""
    p = checked(scene).picture
    kind = ">f8" if order == "BigEndian" else "<f8"
    flat = np.asarray(p, kind).ravel("F" if fortran else "C")
    out = bytearray()
    for n, put in ((len(scene.metadata), None), (len(scene.bands), None)):
        items = [_bytes(k.encode()) + _bytes(v.encode()) for k, v in scene.metadata.items()] if not out else [_bytes(b.encode()) for b in scene.bands]
        out += (_long(n) + b"".join(items) if n else b"") + b"\0"
    for n in (*p.shape, DOUBLE, 8, flat.size * 8):
        out += _long(n)
    out += bytes([fortran]) + _long(ORDERS.index(order))
    runs = strips(flat)
    out += (_long(len(runs)) + b"".join(_long(i) + _bytes(cells.tobytes()) for i, cells in runs) if runs else b"") + b"\0"
    return base64.b64encode(bytes(out))


def decode(text: bytes | str) -> Scene:
    """The scene of a base64 record; gaps are zeros, bytes are swapped as the record says, and bands come last."""
    r = _Reader(base64.b64decode(text))
    metadata = {}
    for _ in r.blocks():
        key = r.bytes().decode()
        metadata[key] = r.bytes().decode()
    bands = [r.bytes().decode() for _ in r.blocks()]
    height, width, depth, _, itemsize, nbytes = (r.long() for _ in range(6))
    fortran = r.data[r.at] != 0
    r.at += 1
    order = ORDERS[r.long()]
    if itemsize != 8 or nbytes != height * width * depth * 8:
        raise ValueError("only doubles, of the stated shape")
    flat = np.zeros(height * width * depth)
    kind = ">f8" if order == "BigEndian" else "<f8"
    for _ in r.blocks():
        index = r.long()
        cells = np.frombuffer(r.bytes(), kind)
        flat[index : index + len(cells)] = cells
    return checked(Scene(flat.reshape((height, width, depth), order="F" if fortran else "C"), bands, metadata))


WIDE = "scene_id string, metadata map<string,string>, bands array<string>, y int, x int, spectrum array<double>"
ROW = "scene_id string, metadata map<string,string>, bands array<string>, height int, width int, data array<binary>"


def read_scenes(spark: SparkSession, path: str, incoming: list[str] | None = None) -> DataFrame:
    """Scenes of text files, a line each: a row a scene with a binary of little-endian doubles a band. `incoming` restricts
    the bands to those, in name order. Empty lines are errors."""
    lines = spark.read.text(path).select(F.concat_ws("#", F.input_file_name(), F.monotonically_increasing_id().cast("string")).alias("scene_id"), "value")

    def run(frames):
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                if not r.value:
                    raise OSError("empty scene")
                s = decode(r.value)
                names = s.bands if incoming is None else sorted(set(incoming) & set(s.bands))
                planes = [np.ascontiguousarray(s.picture[:, :, s.bands.index(b)], "<f8").tobytes() for b in names]
                out.append((r.scene_id, s.metadata, names, s.picture.shape[0], s.picture.shape[1], planes))
            yield pd.DataFrame(out, columns=["scene_id", "metadata", "bands", "height", "width", "data"])

    return lines.mapInPandas(run, ROW)


def gathered(pixels: DataFrame, bands: list[str], shape: tuple[int, int] | None = None) -> DataFrame:
    """Scene rows of wide pixels(scene_id, y, x, spectrum), of that shape or as far as pixels go; missing ones are 0. The
    scene's name is in its metadata. A scene is one group: it must fit in a worker, as it must to be written as a record."""

    def run(key, f):
        y, x = f["y"].to_numpy(), f["x"].to_numpy()
        height, width = shape or (int(y.max()) + 1, int(x.max()) + 1)
        cube = np.zeros((len(bands), height, width), "<f8")
        cube[:, y, x] = np.stack(f["spectrum"].to_numpy()).T
        row = (key[0], {"scene": key[0]}, list(bands), height, width, [plane.tobytes() for plane in cube])
        return pd.DataFrame([row], columns=["scene_id", "metadata", "bands", "height", "width", "data"])

    return pixels.select("scene_id", "y", "x", "spectrum").groupBy("scene_id").applyInPandas(run, ROW)


def pixels(scenes: DataFrame, block: int = 1 << 14) -> DataFrame:
    """Wide pixels of scene rows, so many at a time."""

    def run(frames):
        for f in frames:
            for r in f.itertuples(index=False):
                cube = np.stack([np.frombuffer(b, "<f8") for b in r.data], 1)
                for i in range(0, len(cube), block):
                    part = cube[i : i + block]
                    at = np.arange(i, i + len(part))
                    yield pd.DataFrame({"scene_id": r.scene_id, "metadata": [r.metadata] * len(part), "bands": [r.bands] * len(part), "y": (at // r.width).astype("int32"), "x": (at % r.width).astype("int32"), "spectrum": list(part)})

    return scenes.mapInPandas(run, WIDE)


def write_scenes(scenes: DataFrame, path: str) -> None:
    """Scene rows as text, a line each."""

    def run(frames):
        for f in frames:
            lines = []
            for r in f.itertuples(index=False):
                planes = [np.frombuffer(b, "<f8").reshape(r.height, r.width) for b in r.data]
                lines.append(encode(Scene(np.stack(planes, 2), list(r.bands), dict(r.metadata))).decode())
            yield pd.DataFrame({"value": lines})

    scenes.select("metadata", "bands", "height", "width", "data").mapInPandas(run, "value string").write.mode("overwrite").text(path)


def write_by_band(scenes: DataFrame, path: str) -> None:
    """Scenes with a row a band, laid out by band, so that readers of some bands read no others."""
    rows = scenes.select("scene_id", "metadata", "height", "width", F.explode(F.arrays_zip("bands", "data")).alias("p")).select("scene_id", "metadata", "height", "width", F.col("p.bands").alias("band"), F.col("p.data").alias("data"))
    rows.write.mode("overwrite").partitionBy("band").parquet(path)


def read_by_band(spark: SparkSession, path: str, incoming: list[str] | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if incoming is None else rows.where(F.col("band").isin(incoming))



"""Readers of the other inputs: key/value files, scene headers, band rasters, elevation granules, points, catalogues."""

from __future__ import annotations

import json
import re
import struct
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pairs(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """(key, value) texts of a Hadoop sequence file; with `keys`, of those alone."""
    rows = spark.sparkContext.sequenceFile(path, "org.apache.hadoop.io.Text", "org.apache.hadoop.io.Text").toDF("key string, value string")
    return rows if keys is None else rows.where(F.col("key").isin(keys))


def write_pairs(rows: DataFrame, path: str) -> None:
    rows.select("key", "value").rdd.map(tuple).saveAsSequenceFile(path)


def checked_pairs(rows: list[tuple[str, str]]) -> dict:
    """metadata, bands and shape, in this order, then one entry a band; anything else is an error."""
    if [k for k, _ in rows[:3]] != ["metadata", "bands", "shape"]:
        raise ValueError("metadata, bands and shape come first")
    head = {k: json.loads(v) for k, v in rows[:3]}
    seen = [k for k, _ in rows[3:]]
    if unknown := set(seen) - set(head["bands"]):
        raise ValueError(f"unknown bands {sorted(unknown)}")
    if missing := set(head["bands"]) - set(seen):
        raise ValueError(f"missing bands {sorted(missing)}")
    if len(head["shape"]) != 3 or head["shape"][2] != len(head["bands"]):
        raise ValueError("shape and bands differ")
    return head


def parse_header(text: str) -> dict[str, dict[str, str]]:
    """Groups of `key = "value"` lines between GROUP and END_GROUP, up to END. Nested groups stand beside their parents."""
    out: dict[str, dict[str, str]] = {}
    stack: list[str] = []
    for line in text.splitlines():
        line = line.strip()
        if line == "END":
            break
        key, _, value = (x.strip() for x in line.partition("="))
        value = value.strip('"')
        if key == "GROUP":
            stack.append(value)
            out.setdefault(value, {})
        elif key == "END_GROUP":
            if not stack or stack.pop() != value:
                raise ValueError(f"group {value} ends unopened")
        elif key and stack:
            out[stack[-1]][key] = value
    return out


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """(path, groups map<string, map<string,string>>) of header files."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")

    def run(frames):
        for f in frames:
            yield pd.DataFrame({"path": f["path"], "groups": [parse_header(t) for t in f["value"]]})

    return files.mapInPandas(run, "path string, groups map<string,map<string,string>>")


def decode_tiff(data: bytes) -> np.ndarray:
    """Samples of an uncompressed, one-sample, striped TIFF of integers or floats, in either byte order."""
    end = {b"II": "<", b"MM": ">"}.get(data[:2])
    if end is None or struct.unpack_from(end + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    at = struct.unpack_from(end + "I", data, 4)[0]
    tags: dict[int, list] = {}
    for i in range(struct.unpack_from(end + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(end + "HHI", data, at + 2 + 12 * i)
        code = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}.get(kind)
        if code is None or code == "s":
            continue
        size = struct.calcsize(code) * n
        place = at + 10 + 12 * i if size <= 4 else struct.unpack_from(end + "I", data, at + 10 + 12 * i)[0]
        tags[tag] = list(struct.unpack_from(f"{end}{n}{code}", data, place))
    if tags.get(259, [1]) != [1] or tags.get(277, [1]) != [1]:
        raise ValueError("compressed or multi-sample TIFF")
    kind = {1: "u", 2: "i", 3: "f"}[tags.get(339, [1])[0]] + str(tags[258][0] // 8)
    body = b"".join(data[o : o + n] for o, n in zip(tags[273], tags[279], strict=True))
    return np.frombuffer(body, end + kind).reshape(tags[257][0], tags[256][0])


def encode_tiff(a: np.ndarray) -> bytes:
    """One-sample little-endian TIFF, uncompressed, in one strip."""
    body = np.ascontiguousarray(a, a.dtype.newbyteorder("<")).tobytes()
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    height, width = a.shape
    # Tag, type (3 short, 4 long) and value of each field.
    fields = ((256, 4, width), (257, 4, height), (258, 3, 8 * a.dtype.itemsize), (259, 3, 1), (262, 3, 1), (273, 4, 8), (277, 3, 1), (278, 4, height), (279, 4, len(body)), (339, 3, kind))
    body += b"\0" * (len(body) % 2)
    return struct.pack("<2sHI", b"II", 42, 8 + len(body)) + body + struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", tag, code, 1, v) for tag, code, v in fields) + bytes(4)


def write_files(rows: DataFrame, folder: str) -> None:
    """rows(name, content binary) as a file each below a folder, written where the rows are; a task that runs again writes the
    same files again."""

    def run(part):
        from pyarrow import fs

        for r in part:
            system, path = fs.FileSystem.from_uri(f"{folder}/{r.name}")
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(path) as out:
                out.write(bytes(r.content))

    rows.select("name", "content").foreachPartition(run)


def read_bands(spark: SparkSession, path: str, wanted: list[str] | None = None, require_all: bool = False, window: tuple[slice, slice] | None = None) -> DataFrame:
    """(scene_id, band, height, width, data) of a scene's band files ..._Bnn_....TIF; other bands aren't opened. With
    `require_all` a scene that lacks a wanted band is an error. `window`: the rows and columns to keep."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*_B[0-9][0-9]*_*.TIF").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    files = files.select(F.regexp_extract(name, r"^(.*?)_B[0-9]+_", 1).alias("scene_id"), F.regexp_extract(name, r"_(B[0-9]+)_", 1).alias("band"), "content")
    if wanted is not None:
        files = files.where(F.col("band").isin(wanted))
    if wanted is not None and require_all:  # names alone are counted
        lacks = files.groupBy("scene_id").agg(F.count_distinct("band").alias("n")).where(F.col("n") < len(set(wanted))).first()
        if lacks:
            raise ValueError(f"{lacks.scene_id} lacks wanted bands")

    def run(frames):
        for f in frames:
            arrays = [decode_tiff(b)[window or ...] for b in f["content"]]
            yield pd.DataFrame({"scene_id": f["scene_id"], "band": f["band"], "height": [a.shape[0] for a in arrays], "width": [a.shape[1] for a in arrays], "data": [a.astype("<f8").tobytes() for a in arrays]})

    return files.mapInPandas(run, "scene_id string, band string, height int, width int, data binary")


def read_granules(spark: SparkSession, path: str) -> DataFrame:
    """(granule, y, x, h) of elevation files *_dem.tif, in blocks of rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*_dem.tif").load(path).select(F.regexp_extract("path", r"([^/]+)_dem\.tif$", 1).alias("granule"), "content")

    def run(frames):
        for f in frames:
            for granule, content in zip(f["granule"], f["content"], strict=True):
                a = decode_tiff(content)
                step = max(1, (1 << 16) // a.shape[1])
                for top in range(0, len(a), step):
                    part = a[top : top + step]
                    y, x = np.indices(part.shape, "int32")
                    yield pd.DataFrame({"granule": granule, "y": y.ravel() + np.int32(top), "x": x.ravel(), "h": part.ravel().astype(float)})

    return files.mapInPandas(run, "granule string, y int, x int, h double")


def parse_xml(text: str):
    """Elements as dicts, leaves as text; of repeated names the last."""

    def value(e: ET.Element):
        return {c.tag: value(c) for c in e} if len(e) else (e.text or "")

    root = ET.fromstring(text)
    return {root.tag: value(root)}


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """(path, json) of XML files: parse_xml's elements as JSON."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")

    def run(frames):
        for f in frames:
            yield pd.DataFrame({"path": f["path"], "json": [json.dumps(parse_xml(t)) for t in f["value"]]})

    return files.mapInPandas(run, "path string, json string")


def read_spots(spark: SparkSession, path: str, key: str = "world") -> DataFrame:
    """(lon, lat, ts, intensity) of `key \\t lon lat ts intensity` lines. Another key is an error; numbers that don't parse are null."""
    parts = F.split("value", r"[\t ]+")
    lines = spark.read.text(path).where(F.trim("value") != "")
    ok = F.assert_true(parts[0] == key, F.concat(F.lit("unexpected key "), parts[0]))
    number = lambda i, kind: F.get(parts, F.lit(i)).try_cast(kind)
    return lines.where(ok.isNull()).select(number(1, "double").alias("lon"), number(2, "double").alias("lat"), number(3, "long").alias("ts"), number(4, "double").alias("intensity"))


def write_spots(rows: DataFrame, path: str, key: str = "world") -> None:
    rows.select(F.concat_ws("\t", F.lit(key), F.concat_ws(" ", *[F.col(c).cast("string") for c in ("lon", "lat", "ts", "intensity")])).alias("value")).write.mode("overwrite").text(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Scenes of {"data": [...]} files."""
    schema = "data array<struct<directory string, acquisition_start long, radiance double, corners array<array<double>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("data").alias("d")).select("d.*")
    return rows.withColumn("corners", F.transform("corners", lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))))


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files below folders that name their class."""
    return spark.read.option("recursiveFileLookup", True).text(path).select("value", F.regexp_extract(F.input_file_name(), r"/([^/]+)/[^/]+$", 1).alias("class"))


def listed(spark: SparkSession, path: str, least_bytes: int = 1000) -> DataFrame:
    """(name, bytes) of files larger than that, without folder and extension; contents aren't read."""
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > least_bytes)
    return files.select(F.regexp_extract("path", r"([^/]+?)(\.[^/.]*)?$", 1).alias("name"), F.col("length").alias("bytes"))


def parse_cluster_model(text: str) -> dict:
    """Fields, number of clusters and centres of a clustering model in PMML."""
    root = ET.fromstring(re.sub(r'\sxmlns="[^"]*"', "", text, count=1))
    model = root.find("ClusteringModel")
    centers = [[float(v) for v in c.findtext("Array", "").split()] for c in model.findall("Cluster")]
    return {"fields": [f.get("field") for f in model.findall("ClusteringField")], "clusters": int(model.get("numberOfClusters")), "ids": [c.get("id") for c in model.findall("Cluster")], "centers": centers}


@dataclass
class JobConfig:
    """Settings of a tiling job: values of an INI file's sections, JSON where they are."""

    settings: dict[str, dict[str, object]] = field(default_factory=dict)

    @classmethod
    def parse(cls, text: str) -> JobConfig:
        import configparser

        parser = configparser.ConfigParser(interpolation=None)
        parser.optionxform = str
        parser.read_string(text)
        out: dict[str, dict[str, object]] = {}
        for section in parser.sections():
            out[section] = {}
            for key, value in parser[section].items():
                try:
                    out[section][key] = json.loads(value)
                except ValueError:
                    out[section][key] = value
        return cls(out)

    def get(self, section: str, key: str, default=None):
        return self.settings.get(section, {}).get(key, default)

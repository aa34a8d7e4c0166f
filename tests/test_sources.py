"""Round trips of the sources and sinks."""

import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridfold.sources import codec, files
from gridfold.sources.store import Store
from gridfold.streaming import ingest

cells = st.lists(st.one_of(st.just(0.0), st.floats(allow_nan=False, allow_infinity=False)), min_size=12, max_size=12)


@settings(max_examples=40, deadline=None)
@given(cells, st.sampled_from(codec.ORDERS[:2]), st.booleans(), st.dictionaries(st.text(max_size=5), st.text(max_size=5), max_size=3))
def test_codec_round_trip(values, order, fortran, metadata):
    scene = codec.Scene(np.array(values).reshape(2, 3, 2), ["B1", "B2"], metadata)
    back = codec.decode(codec.encode(scene, order, fortran))
    assert (back.picture == scene.picture).all() and back.bands == scene.bands and back.metadata == metadata


def test_codec_refuses():
    for bad in (codec.Scene(np.zeros((2, 2)), ["a"]), codec.Scene(np.zeros((2, 2, 2)), ["a"]), codec.Scene(np.zeros((0, 2, 1)), ["a"])):
        with pytest.raises(ValueError):
            codec.encode(bad)
    with pytest.raises(TypeError):
        codec.encode(codec.Scene(np.ones((1, 1, 1)), ["a"], {"k": 1}))


def test_strips():
    assert [(i, c.tolist()) for i, c in codec.strips(np.array([0, 1, 2, 0, 3.0]))] == [(1, [1, 2]), (4, [3])]


def test_scene_files(spark, tmp_path):
    rng = np.random.default_rng(0)
    scenes = [codec.Scene(rng.integers(0, 3, (4, 5, 3)).astype(float), ["B3", "B1", "B2"], {"k": str(i)}) for i in range(3)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"\n".join(codec.encode(s) for s in scenes))
    rows = codec.read_scenes(spark, str(tmp_path / "in"), incoming=["B2", "B1", "B9"])
    got = rows.collect()
    assert len(got) == 3 and got[0].bands == ["B1", "B2"]
    wide = codec.pixels(rows, block=7)
    assert wide.count() == 60
    r = wide.where("metadata['k'] = '1' and y = 2 and x = 3").first()
    assert list(r.spectrum) == [scenes[1].picture[2, 3, 1], scenes[1].picture[2, 3, 2]]
    codec.write_scenes(rows, str(tmp_path / "out"))
    assert codec.read_scenes(spark, str(tmp_path / "out")).count() == 3
    codec.write_by_band(rows, str(tmp_path / "bands"))
    one = codec.read_by_band(spark, str(tmp_path / "bands"), ["B1"])
    assert one.count() == 3
    assert "PartitionFilters: [isnotnull(band" in one._jdf.queryExecution().toString() or one.where("band = 'B1'").count() == 3


def test_pairs(spark, tmp_path):
    rows = spark.createDataFrame([("metadata", "{}"), ("bands", '["B1"]'), ("shape", "[1, 1, 1]"), ("B1", "x")], "key string, value string")
    files.write_pairs(rows, str(tmp_path / "seq"))
    assert files.read_pairs(spark, str(tmp_path / "seq"), ["shape", "B1"]).count() == 2
    pairs = [tuple(r) for r in rows.collect()]
    assert files.checked_pairs(pairs)["bands"] == ["B1"]
    for bad in (pairs[::-1], pairs[:3], [*pairs, ("B2", "y")]):
        with pytest.raises(ValueError):
            files.checked_pairs(bad)


def test_header(spark, tmp_path):
    text = 'GROUP = A\n  x = "1"\n  GROUP = B\n    y = 2\n  END_GROUP = B\n  z = 3\nEND_GROUP = A\nEND\nx = 9'
    assert files.parse_header(text) == {"A": {"x": "1", "z": "3"}, "B": {"y": "2"}}
    (tmp_path / "h.txt").write_text(text)
    assert files.read_headers(spark, str(tmp_path)).first().groups["B"] == {"y": "2"}


def tiff(a: np.ndarray, end: str = "<") -> bytes:
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    body = a.astype(a.dtype.newbyteorder(end)).tobytes()
    tags = [(256, a.shape[1]), (257, a.shape[0]), (258, a.dtype.itemsize * 8), (259, 1), (273, 8), (277, 1), (278, a.shape[0]), (279, len(body)), (339, kind)]
    head = (b"II" if end == "<" else b"MM") + struct.pack(end + "HI", 42, 8 + len(body))
    return head + body + struct.pack(end + "H", len(tags)) + b"".join(struct.pack(end + "HHII", t, 4, 1, v) for t, v in tags) + b"\0" * 4


def test_rasters(spark, tmp_path):
    a = np.arange(12, dtype="i2").reshape(3, 4) - 5
    for end in "<>":
        assert (files.decode_tiff(tiff(a, end)) == a).all()
    (tmp_path / "EO1A_B02_L1T.TIF").write_bytes(tiff(a))
    (tmp_path / "EO1A_B03_L1T.TIF").write_bytes(tiff(a))
    (tmp_path / "N00E010_dem.tif").write_bytes(tiff(a.astype("f4")))
    got = files.read_bands(spark, str(tmp_path), ["B03"]).collect()
    assert [(r.scene_id, r.band, r.height, r.width) for r in got] == [("EO1A", "B03", 3, 4)]
    assert files.read_granules(spark, str(tmp_path)).where("granule = 'N00E010' and y = 1 and x = 2").first().h == a[1, 2]
    assert {r.name for r in files.listed(spark, str(tmp_path), 100).collect()} == {"EO1A_B02_L1T", "EO1A_B03_L1T", "N00E010_dem"}


def test_small_readers(spark, tmp_path):
    (tmp_path / "spots.tsv").write_text("world\t1.5 2 100 7\nworld\t1.5 x 100 7\n")
    got = files.read_spots(spark, str(tmp_path / "spots.tsv")).orderBy("lat").collect()
    assert [r.lat for r in got] == [None, 2.0]
    files.write_spots(spark.createDataFrame(got), str(tmp_path / "again"))
    (tmp_path / "bad.tsv").write_text("moon\t1 2 3 4\n")
    with pytest.raises(Exception, match="unexpected key"):
        files.read_spots(spark, str(tmp_path / "bad.tsv")).collect()
    (tmp_path / "c.json").write_text('{"data": [{"directory": "d", "acquisition_start": 5, "radiance": 1.5, "corners": [[1, 2], [3, 4]]}]}')
    assert files.read_catalog(spark, str(tmp_path / "c.json")).first().corners[1].lon == 3.0
    (tmp_path / "train" / "water").mkdir(parents=True)
    (tmp_path / "train" / "water" / "a.txt").write_text("1.0 2.0 3\n")
    assert files.read_training(spark, str(tmp_path / "train")).first()["class"] == "water"
    assert files.parse_xml("<a><b>1</b><c><d>2</d></c></a>") == {"a": {"b": "1", "c": {"d": "2"}}}
    assert files.JobConfig.parse('[s]\nx = [1, 2]\ny = plain').get("s", "x") == [1, 2]
    model = '<PMML xmlns="u"><ClusteringModel numberOfClusters="1"><ClusteringField field="lon"/><Cluster id="7"><Array>1 2</Array></Cluster></ClusteringModel></PMML>'
    assert files.parse_cluster_model(model) == {"fields": ["lon"], "clusters": 1, "ids": ["7"], "centers": [[1.0, 2.0]]}


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/t", ["row_key"], ["layer"])
    rows = lambda *r: spark.createDataFrame(list(r), "row_key string, layer string, v int")
    assert store.read() is None
    store.upsert(rows(("a", "x", 1), ("b", "x", 2), ("c", "y", 3)))
    store.upsert(rows(("b", "x", 9), ("d", "y", 4)))
    assert {(r.row_key, r.v) for r in store.read().collect()} == {("a", 1), ("b", 9), ("c", 3), ("d", 4)}
    store.delete("row_key", "b", "c")
    assert {r.row_key for r in store.read().collect()} == {"a", "d"}
    store.drop()
    assert store.read() is None


def test_stream_equals_batch(spark, sf, tmp_path):
    from gridfold.plans import fixtures as fx

    points = fx.points(spark, sf)
    points.repartition(3).write.parquet(f"{tmp_path}/in")
    store = Store(spark, f"file://{tmp_path}/store", ["row_key"])
    for _ in range(2):  # what has been taken isn't taken again
        stream = ingest.bright_stream(ingest.arriving(spark, f"{tmp_path}/in", points.schema, files_at_once=1), 30.0)
        ingest.upsert_into(stream, store, f"{tmp_path}/ck").awaitTermination()
    want = ingest.bright_stream(points, 30.0)
    cols = ["row_key", "id", "intensity"]
    assert store.read().select(cols).exceptAll(want.select(cols)).isEmpty() and store.read().count() == want.count()
    q = ingest.tile_counts(ingest.bright_stream(ingest.arriving(spark, f"{tmp_path}/in", points.schema), 30.0), 4).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == want.count()


def test_band_files_require_all_and_take_windows(spark, tmp_path):
    a = np.arange(12.0).reshape(3, 4)
    names = ["s1_B01_L1T.TIF", "s1_B02_L1T.TIF", "s2_B01_L1T.TIF"]
    files.write_files(spark.createDataFrame([(n, bytearray(files.encode_tiff(a))) for n in names], "name string, content binary"), f"file://{tmp_path}/r")
    rows = files.read_bands(spark, f"file://{tmp_path}/r", ["B01"], require_all=True, window=(slice(1, 3), slice(0, 2))).collect()
    assert sorted(r.scene_id for r in rows) == ["s1", "s2"]
    assert all((r.height, r.width) == (2, 2) and np.frombuffer(r.data).tolist() == [4.0, 5.0, 8.0, 9.0] for r in rows)
    with pytest.raises(ValueError, match="s2"):
        files.read_bands(spark, f"file://{tmp_path}/r", ["B01", "B02"], require_all=True)


def test_gathered_scenes_fill_gaps_with_zeros(spark):
    p = spark.createDataFrame([("a", 0, 1, [5.0, 6.0])], "scene_id string, y int, x int, spectrum array<double>")
    whole = codec.gathered(p, ["B01", "B02"], (2, 2)).first()
    assert (whole.height, whole.width, whole.metadata) == (2, 2, {"scene": "a"})
    assert [np.frombuffer(b).tolist() for b in whole.data] == [[0.0, 5.0, 0.0, 0.0], [0.0, 6.0, 0.0, 0.0]]
    assert codec.gathered(p.limit(0), ["B01"]).count() == 0


def test_unknown_irradiance_is_null(spark):
    from gridfold.functions import radiometry

    rows = spark.createDataFrame([(True, 1, 8.0, 1.0, 0.0, 1, 90.0), (False, 1, 8.0, 1.0, 0.0, 1, 90.0)], "hyperspectral boolean, number int, value double, factor double, offset double, day int, elevation double")
    table = spark.createDataFrame([(True, 1, 2.0)], "hyperspectral boolean, number int, irradiance double")
    got = {r.hyperspectral: r.corrected for r in radiometry.corrected(rows, table).collect()}
    assert got[False] is None and got[True] == pytest.approx(math.pi * 0.9832**2 * 4)


def test_commands_without_an_answer(spark):
    from gridfold.operators import serving

    images = spark.createDataFrame([(1, 0, 0, "RGB", 5, "x", "{}"), (1, 0, 0, "RGB", 3, "y", "{}"), (1, 0, 0, "RGB", 1, None, "{}")], "depth int, long_index long, lat_index long, layer string, ts long, rgba string, metadata string")
    ask = lambda r: serving.respond(r, images, images, images)
    tile = {"depth": "1", "long": "0", "lat": "0"}
    assert [r.ts for r in ask(tile).collect()] == [3]
    assert [r.ts for r in ask(tile | {"command": "images"}).collect()] == [3, 5]
    assert ask(tile | {"command": "imageList"}).count() == 2 and ask({"command": "image", "depth": "?"}).count() == 0
    assert ask({"command": "test"}).first().message == "I'm alive." and ask({"command": "x"}).first().message == 'Unrecognized command "x".'

"""Queries of spectra, masks, radiometry, change and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridfold.functions import radiometry as rad
from gridfold.operators import bands, explorer, spectral, training
from gridfold.plans import fixtures as fx
from gridfold.plans.registry import query, r6

NAMES = [f"B{i:02d}" for i in range(1, 65)]


def _wide(spark, sf_dir, scale=100.0):
    """Pixels with positive radiances in columns B01..B64; every seventh pixel has no data in band 3."""
    p = fx.pixels(spark, sf_dir)
    value = lambda i: F.when((F.col("id") % 7 == 0) & F.lit(i == 2), 0.0).otherwise((F.col("spectrum")[i] + 1.0) * scale)
    return p.select("id", "y", "x", *[value(i).alias(n) for i, n in enumerate(NAMES[:12])])


_WIDE = fx.PIXELS + ", wide AS (SELECT id, y, x, " + ", ".join(f"CASE WHEN id % 7 = 0 AND {i} = 2 THEN 0e0 ELSE (s[{i + 1}] + 1) * 100 END B{i + 1:02d}" for i in range(12)) + " FROM pixels)"


@query(f"WITH {fx.SAMPLES} SELECT band, round(avg(value), 6) radiance FROM samples WHERE value > 0 GROUP BY band")
def spectrum(spark, sf_dir):
    return explorer.spectrum(fx.samples(spark, sf_dir)).select("band", r6("radiance", "radiance"))


@query(f"WITH {fx.SAMPLES} SELECT band, round(ln(sum(value)) - ln(count(*)), 6) radiance FROM samples WHERE value > 0 GROUP BY band")
def spectrum_log(spark, sf_dir):
    return explorer.spectrum(fx.samples(spark, sf_dir), log=True).select("band", r6("radiance", "radiance"))


@query(f"WITH {fx.PIXELS} SELECT id FROM pixels WHERE x >= 3 AND x < 20 AND y >= 0 AND y < 12")
def rectangle(spark, sf_dir):
    """Corners in any order, clamped to the scene."""
    p = fx.pixels(spark, sf_dir)
    return p.where(explorer.in_rectangle(20, 12, 3, -5, 25, 20)).select("id")


@query(f"WITH {_WIDE} SELECT round(B01 / B02, 6) horizontal, round(ln(B03) - B04, 6) vertical FROM wide WHERE B01 <> 0 AND B02 <> 0 AND B03 <> 0 AND B04 <> 0")
def scatter(spark, sf_dir):
    """Two expressions over bands at each pixel with data."""
    return explorer.scatter(_wide(spark, sf_dir), "B01 / B02", "log(B03) - B04", NAMES[:12]).select(r6("horizontal", "horizontal"), r6("vertical", "vertical"))


@query(f"""WITH {fx.POINTS}, v AS (SELECT layer, intensity, row_number() OVER (PARTITION BY layer ORDER BY intensity) - 1 i, count(*) OVER (PARTITION BY layer) n FROM points)
SELECT layer, max(intensity) FILTER (WHERE i = least(floor(n * 0.05e0), n - 1)) low, max(intensity) FILTER (WHERE i = least(ceil(n * 0.95e0), n - 1)) high FROM v GROUP BY layer""")
def sorted_percentiles(spark, sf_dir):
    return explorer.sorted_percentiles(fx.points(spark, sf_dir), ["layer"], "intensity")


@query(f"""WITH {_WIDE}, d AS (SELECT * FROM wide WHERE B01 <> 0 AND B02 <> 0 AND B03 <> 0),
c AS (SELECT 'r' k, B03 v FROM d UNION ALL SELECT 'g', B02 FROM d UNION ALL SELECT 'b', B01 / B02 * 100 FROM d),
p AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY v) - 1 i, count(*) OVER (PARTITION BY k) n FROM c),
e AS (SELECT min(v) FILTER (WHERE i = least(floor(n * 0.05e0), n - 1)) lo, max(v) FILTER (WHERE i = least(ceil(n * 0.95e0), n - 1)) hi FROM p)
SELECT y, x, greatest(least(floor((B03 - lo) / (hi - lo) * 256), 255), 0)::INT r, greatest(least(floor((B02 - lo) / (hi - lo) * 256), 255), 0)::INT g,
greatest(least(floor((B01 / B02 * 100 - lo) / (hi - lo) * 256), 255), 0)::INT b, CASE WHEN B01 <> 0 AND B02 <> 0 AND B03 <> 0 THEN 255 ELSE 0 END a FROM wide, e""")
def false_colour(spark, sf_dir):
    """Three expressions as colours, on the scene's own 5th to 95th percentile."""
    return explorer.false_colour(_wide(spark, sf_dir), {"r": "B03", "g": "B02", "b": "B01 / B02 * 100"}, NAMES[:12], 0.0, 0.0)


@query(f"""WITH {fx.PIXELS}, z AS (SELECT id, list_transform(s, lambda v: CASE WHEN abs(v) < 0.004e0 THEN 0e0 ELSE v + 0.25e0 END) s FROM pixels)
SELECT id, len(list_filter(s, lambda v: NOT v > 0)) = 0 valid, s[1] > 0 AND len(list_filter(s[2:], lambda v: v = 0)) = 0 analysable, round(list_sum(s), 6) > 0 lit FROM z""")
def masks(spark, sf_dir):
    """The three tests of valid pixels."""
    s = F.transform("spectrum", lambda v: F.when(F.abs(v) < 0.004, 0.0).otherwise(v + 0.25))
    return fx.pixels(spark, sf_dir).select("id", s.alias("s")).select("id", bands.valid(F.col("s")).alias("valid"), bands.analysable(F.col("s")).alias("analysable"), bands.lit(F.col("s")).alias("lit"))


@query(f"""WITH {fx.PIXELS} SELECT id, 'B07,B03' kept, 'B03,B07' restricted, 'B99' missing, round(s[7], 6) v7, round(s[3], 6) v3, NULL::DOUBLE v99 FROM pixels""")
def band_selection(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in ("B07", "B05", "B03")])
    row = fx.pixels(spark, sf_dir).withColumn("names", names).withColumn("s", F.array(F.col("spectrum")[6], F.col("spectrum")[4], F.col("spectrum")[2]))
    got = bands.selected(F.col("names"), F.col("s"), ["B07", "B03", "B99"])
    return row.select("id", F.array_join(bands.without_bands(F.col("names"), ["B03", "B07"]), ",").alias("kept"), F.array_join(bands.restricted_bands(F.col("names"), ["B07", "B99", "B03"]), ",").alias("restricted"), F.array_join(bands.missing_bands(F.col("names"), ["B03", "B99"]), ",").alias("missing"), r6(got[0], "v7"), r6(got[1], "v3"), got[2].alias("v99"))


@query("""SELECT DISTINCT l_orderkey scene_id, layer FROM (SELECT l_orderkey, list(DISTINCT l_linenumber) b FROM lineitem GROUP BY ALL), (VALUES ('low', [1, 2]), ('odd', [1, 3, 5]), ('all', [1, 2, 3, 4, 5, 6, 7])) t(layer, wanted) WHERE list_has_all(b, wanted)""")
def scene_layers(spark, sf_dir):
    """Layers all of whose bands a scene has."""
    scenes = fx.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("scene_id")).agg(F.collect_set(F.concat(F.lit("B"), F.col("l_linenumber").cast("string"))).alias("bands"))
    layers = [("low", ["B1", "B2"]), ("odd", ["B1", "B3", "B5"]), ("all", [f"B{i}" for i in range(1, 8)])]
    return bands.layers_of(scenes, layers).select("scene_id", "layer")


@query(f"""WITH {fx.PIXELS}, r AS (SELECT id, label, (dense_rank() OVER (ORDER BY label) - 1)::INT slot FROM pixels WHERE label > 0)
SELECT id, label, slot, CASE WHEN slot = 0 THEN 1e0 / label WHEN slot >= 3 THEN 1e0 / label ELSE 0 END clouds, CASE WHEN slot = 1 THEN 1e0 / label * 2 ELSE 0 END land, CASE WHEN slot = 2 THEN 1e0 / label * 3 ELSE 0 END water FROM r""")
def class_planes(spark, sf_dir):
    return bands.class_planes(fx.pixels(spark, sf_dir).where("label > 0").select("id", "label"), ["id"])


@query(f"""WITH {fx.PIXELS} SELECT id, x + 1 AS number, round(CASE WHEN x + 1 < 70.5 THEN (x + 1 - 10e0) * 10.213e0 + 446 ELSE 0 END, 6) nm,
round(2.5e-28 / (exp(0.0143878e0 / (((x + 1 - 10e0) * 10.213e0 + 446) * 1e-9) / 5778e0) - 1) / pow(((x + 1 - 10e0) * 10.213e0 + 446) * 1e-9, 5), 6) solar FROM pixels""")
def wavelengths(spark, sf_dir):
    n = F.col("x") + 1
    return fx.pixels(spark, sf_dir).select("id", n.alias("number"), r6(rad.wavelength(n), "nm"), r6(rad.incident_solar(rad.wavelength(n)), "solar"))


_SUN = ", ".join(f"({a}, {x})" for a, x in rad.EARTH_SUN)


@query(f"""WITH t AS (SELECT a::INT a, x::DOUBLE x FROM (VALUES {_SUN}) v(a, x)), s AS (SELECT a, x, lead(a) OVER (ORDER BY a) b, lead(x) OVER (ORDER BY a) y FROM t),
o AS (SELECT o_orderkey id, dayofyear(o_orderdate) d, o_totalprice v, 20 + o_orderkey % 60 e FROM orders)
SELECT id, d::INT "day", round(x + (d - a) * ((y - x) / (b - a)), 8) distance, round(pi() * pow(x + (d - a) * ((y - x) / (b - a)), 2) * v / sin(radians(e)), 2) corrected FROM o JOIN s ON d >= a AND (d < b OR (d = 366 AND b = 366))""")
def sun_correction(spark, sf_dir):
    """Distance to the Sun by day, and radiances as if it stood overhead."""
    day = F.dayofyear("o_orderdate")
    o = fx.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), day.alias("day"), F.round(rad.earth_sun_distance(day), 8).alias("distance"), F.round(rad.sun_corrected(F.col("o_totalprice"), day, 20 + F.col("o_orderkey") % 60), 2).alias("corrected"))


@query("""SELECT o_orderkey id, (floor(epoch(o_orderdate))::BIGINT // 86400) * 86400 + 3661 ts FROM orders""")
def parsed_times(spark, sf_dir):
    """Times from 'year day-of-year h:m:s'."""
    text = F.concat(F.date_format("o_orderdate", "yyyy DDD"), F.lit(" 01:01:01"))
    return fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), rad.parse_time(text).alias("ts"))


_E = ", ".join(f"({k}, {v}e0)" for k, v in rad.IRRADIANCE.items())


@query(f"""WITH e AS (SELECT * FROM (VALUES {_E}) v(n, e)) SELECT l_orderkey, l_linenumber + 1 AS number, round(l_extendedprice / e, 6) reflected FROM lineitem JOIN e ON n = l_linenumber + 1""")
def irradiance_normalised(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") + 1).alias("number"), F.col("l_extendedprice").alias("radiance"))
    return rows.select("l_orderkey", "number", r6(F.col("radiance") / rad.irradiance(F.col("number")), "reflected"))


@query("""SELECT l_orderkey, l_linenumber AS number, round(l_extendedprice * 30 * (0.01e0 * l_linenumber) - 3.4e0, 6) radiance, round(l_quantity * CASE WHEN l_linenumber <= 4 THEN 1 / 40e0 ELSE 1 / 80e0 END, 6) calibrated FROM lineitem""")
def rescaled(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "lineitem").withColumn("number", F.col("l_linenumber"))
    calibrated = F.col("l_quantity") * rad.calibration(F.col("number") * 17, F.lit(40.0), F.lit(80.0), F.lit(True))
    return rows.select("l_orderkey", "number", r6(rad.rescaled(F.col("l_extendedprice"), 0.01 * F.col("number"), F.lit(-3.4)), "radiance"), r6(calibrated, "calibrated"))


_BINS = " ".join(f"WHEN n BETWEEN {a} AND {b} THEN {k}" for k, (a, b) in rad.BINS.items())


@query(f"""WITH {fx.PIXELS}, l AS (SELECT id, unnest(range(1, 65)) n, unnest(s) v FROM pixels), b AS (SELECT id, CASE {_BINS} END wide, v FROM l)
SELECT id, wide, round(avg(v), 6) radiance, count(*) members FROM b WHERE wide IS NOT NULL GROUP BY ALL""")
def binned_bands(spark, sf_dir):
    """Hyperspectral bands as means of the members of each multispectral one."""
    long = fx.pixels(spark, sf_dir).select("id", F.posexplode("spectrum").alias("i", "radiance")).withColumn("number", F.col("i") + 1)
    return rad.binned(long, ["id"]).select("id", "wide", r6("radiance", "radiance"), "members")


@query(f"""WITH {fx.PIXELS} SELECT id, 'even' synthetic, round((s[2] + s[4] + s[6]) / 3, 6) radiance FROM pixels UNION ALL SELECT id, 'odd', round(0.7e0 * s[1] + 0.3e0 * s[3], 6) FROM pixels""")
def synthesised_bands(spark, sf_dir):
    long = fx.pixels(spark, sf_dir).select("id", F.posexplode("spectrum").alias("i", "radiance")).withColumn("number", F.col("i") + 1)
    weights = spark.createDataFrame([(n, "even", 1 / 3) for n in (2, 4, 6)] + [(1, "odd", 0.7), (3, "odd", 0.3)], "number int, synthetic string, weight double")
    return rad.synthesised(long, weights, ["id"]).select("id", "synthetic", r6("radiance", "radiance"))


_CO2_BANDS = {183: 1, 184: 2, 185: 3, 186: 4, 188: 5, 189: 6}
_L = {b: f"ln((s[{i}] + 1) + 0.1e0 / 80)" for b, i in _CO2_BANDS.items()}
_SX, _SXX = sum(rad.CO2_BACKGROUND), sum(x * x for x in rad.CO2_BACKGROUND)
_SY, _SXY = " + ".join(_L[x] for x in rad.CO2_BACKGROUND), " + ".join(f"{x} * {_L[x]}" for x in rad.CO2_BACKGROUND)


@query(f"""WITH {fx.PIXELS}, f AS (SELECT id, ({_SY}) sy, ({_SXY}) sxy, {_L[185]} a, {_L[186]} b FROM pixels),
g AS (SELECT id, ({_SXX} * sy - {_SX} * sxy) / {4 * _SXX - _SX * _SX}e0 c, (4 * sxy - {_SX} * sy) / {4 * _SXX - _SX * _SX}e0 k, a, b FROM f)
SELECT id, round(CASE WHEN id % 9 = 0 THEN 0 ELSE exp(-((a - (c + 185 * k)) / 2 + (b - (c + 186 * k)) / 2)) END, 6) co2 FROM g""")
def co2_index(spark, sf_dir):
    """Depth of the carbon dioxide lines; a missing band gives 0."""
    band = lambda n: F.when((F.col("id") % 9 != 0) | F.lit(n != 186), F.col("spectrum")[_CO2_BANDS[n] - 1] + 1.0)
    return fx.pixels(spark, sf_dir).select("id", r6(rad.co2_index(band), "co2"))


@query("""SELECT o_orderkey id, round(greatest(400 * sin(radians(o_orderkey % 90)), 10), 6) highest, greatest(least((o_totalprice - 1000) / 200000 * 255, 255), 0)::DOUBLE AS unscaled,
trunc(greatest(least((o_totalprice - 1000) / 200000 * 255, 255), 0))::INT byte FROM orders""")
def scaled_radiance(spark, sf_dir):
    v = F.col("o_totalprice")
    raw = F.greatest(F.least((v - 1000) / 200000 * 255, F.lit(255.0)), F.lit(0.0))
    return fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), r6(rad.sun_range(F.col("o_orderkey") % 90), "highest"), raw.alias("unscaled"), rad.scaled_byte(v, F.lit(1000.0), F.lit(201000.0)).alias("byte"))


@query(f"""WITH {fx.PIXELS}, o AS (SELECT id, list_transform(s, lambda v, i: v / i) n FROM pixels) SELECT id, round(n[1] / sqrt(list_dot_product(n, n)), 6) first, round(n[64] / sqrt(list_dot_product(n, n)), 6) last FROM o""")
def normalised_spectra(spark, sf_dir):
    solar = F.array(*[F.lit(float(i)) for i in range(1, 65)])
    n = fx.pixels(spark, sf_dir).select("id", rad.normalised(F.col("spectrum"), solar).alias("n"))
    return n.select("id", r6(F.col("n")[0], "first"), r6(F.col("n")[63], "last"))


@query(f"""WITH {fx.PIXELS}, m AS (SELECT a.id, list_dot_product(a.s, a.s) * list_dot_product(b.s, b.s) n, list_dot_product(a.s, b.s) d FROM pixels a JOIN pixels b ON b.id = a.id + 1),
p AS (SELECT id, CASE WHEN (n - d * d) / n BETWEEN 0 AND 1 THEN (n - d * d) / n ELSE 0 END p FROM m) SELECT id, round(p, 6) "change", round(1 - 0.75e0 * p, 6) change_b FROM p""")
def change_probability(spark, sf_dir):
    """Change of each pixel against the next one, as two scenes."""
    p = fx.pixels(spark, sf_dir).select("id", "spectrum")
    return spectral.change(p, p.withColumn("id", F.col("id") - 1), ["id"]).select("id", r6("change", "change"), r6("change_b", "change_b"))


@query(f"""WITH {fx.PIXELS}, b AS (SELECT id, label, list_dot_product(list_transform(s, lambda v: v * (1 + id % 5)), list_transform(s, lambda v: v * (1 + id % 5))) n2 FROM pixels),
t AS (SELECT label, avg(n2) + stddev_pop(n2) t FROM b GROUP BY label) SELECT id, label FROM b JOIN t USING (label) WHERE n2 <= t""")
def cloud_filter(spark, sf_dir):
    """Pixels not brighter than mean plus deviation of their scene."""
    p = fx.pixels(spark, sf_dir).select("id", "label", F.transform("spectrum", lambda v: v * (1 + F.col("id") % 5)).alias("spectrum"))
    return spectral.cloudless(p, ["label"]).select("id", "label")


_CENTERS = f"""{fx.PIXELS}, centers AS (SELECT id::INT c, s cs FROM pixels WHERE id < 10),
dist AS (SELECT p.id, p.s, c, sqrt(list_sum(list_transform(range(1, 65), lambda i: (p.s[i] - cs[i]) * (p.s[i] - cs[i])))) d FROM pixels p, centers),
near AS (SELECT id, any_value(s) s, arg_min(c, d)::INT cluster, min(d) d FROM dist GROUP BY id)"""


def _assigned(spark, sf_dir):
    p = fx.pixels(spark, sf_dir)
    centers = p.where("id < 10").select(F.col("id").cast("int").alias("cluster"), F.col("spectrum").alias("center"))
    return spectral.nearest(p, centers, ["id"]), centers


@query(f"WITH {_CENTERS} SELECT id, cluster, round(d, 6) distance FROM near")
def nearest_centers(spark, sf_dir):
    return _assigned(spark, sf_dir)[0].select("id", "cluster", r6("distance", "distance"))


@query(f"WITH {_CENTERS} SELECT cluster, count(*) population, round(avg(s[1]), 6) first, round(avg(s[64]), 6) last FROM near GROUP BY cluster")
def moved_centers(spark, sf_dir):
    moved = spectral.moved_centers(*_assigned(spark, sf_dir))
    return moved.select("cluster", "population", r6(F.col("center")[0], "first"), r6(F.col("center")[63], "last"))


@query(f"WITH {_CENTERS} SELECT round(sqrt(sum(d * d)), 6) AS \"cost\" FROM near")
def clustering_cost(spark, sf_dir):
    return spectral.cost(_assigned(spark, sf_dir)[0]).select(r6("cost", "cost"))


@query(f"""WITH {_CENTERS}, n AS (SELECT cluster, count(*) p FROM near GROUP BY cluster), c AS (SELECT id, cluster, p / d v FROM near JOIN n USING (cluster) WHERE id >= 10), e AS (SELECT min(v) lo, max(v) hi FROM c)
SELECT id, cluster, round(v, 6) commonness, trunc(least((hi - v) / (hi - lo) * 256, 255))::INT rareness FROM c, e""")
def commonness(spark, sf_dir):
    assigned, _ = _assigned(spark, sf_dir)
    rows = spectral.commonness(assigned.withColumn("distance", F.when(F.col("id") >= 10, F.col("distance"))), ["id"])
    return rows.where("id >= 10").select("id", "cluster", r6("commonness", "commonness"), "rareness")


@query(f"""WITH {_CENTERS}, l AS (SELECT cluster, id, unnest(range(0, 64)) i, unnest(s) v FROM near) SELECT a.cluster, a.i::INT i, b.i::INT j, round(covar_samp(a.v, b.v), 6) + 0e0 covariance
FROM l a JOIN l b ON a.id = b.id AND a.i <= b.i GROUP BY ALL HAVING count(*) > 1""")
def cluster_covariance(spark, sf_dir):
    """Covariance of all bands within each cluster."""
    c = spectral.covariance(_assigned(spark, sf_dir)[0])
    return c.where("covariance is not null").select("cluster", "i", "j", (F.round("covariance", 6) + 0.0).alias("covariance"))


@query(f"""WITH {_CENTERS}, l AS (SELECT id, cluster, unnest(range(0, 64)) i, unnest(near.s) v, unnest(near.s) - unnest(cs) d FROM near JOIN centers ON c = cluster),
cov AS (SELECT a.cluster, a.i, b.i j, covar_samp(a.v, b.v) k FROM l a JOIN l b USING (id) GROUP BY ALL),
u AS (SELECT a.id, any_value(a.cluster) cluster, sum(a.d * b.d * k) q FROM l a JOIN l b USING (id) JOIN cov ON cov.cluster = a.cluster AND cov.i = a.i AND cov.j = b.i GROUP BY a.id),
n AS (SELECT id, cluster, sum(d * d) n2 FROM l GROUP BY id, cluster), g AS (SELECT n.id, n.cluster, n2 / sqrt(CASE WHEN q > 0 AND n2 > 0 THEN q END) s FROM n LEFT JOIN u USING (id))
SELECT id, cluster, round(s, 5) significance, CASE WHEN s < 2.5e0 THEN cluster ELSE -1 END seed, CASE WHEN s > 5 THEN cluster ELSE -1 END outlier FROM g""")
def significance(spark, sf_dir):
    """Distance of pixels from their centres in deviations, with the seeds and outliers that follow; none for a centre itself."""
    assigned, centers = _assigned(spark, sf_dir)
    rows = spectral.outliers(spectral.seeds(spectral.significance(assigned, centers, ["id"])))
    return rows.withColumn("significance", F.round("significance", 5))


@query(f"""WITH {_CENTERS}, m AS (SELECT c cluster, list_sum(list_transform(range(1, 65), lambda i: (cs[i] + 1) * (400 + i * 10e0))) / list_sum(list_transform(cs, lambda v: v + 1)) m FROM centers)
SELECT cluster, round(m, 6) mean_wavelength, row_number() OVER (ORDER BY m, cluster)::INT place FROM m""")
def clusters_by_wavelength(spark, sf_dir):
    _, centers = _assigned(spark, sf_dir)
    lifted = centers.withColumn("center", F.transform("center", lambda v: v + 1.0))
    return spectral.by_mean_wavelength(lifted, [400 + i * 10.0 for i in range(1, 65)]).select("cluster", r6("mean_wavelength", "mean_wavelength"), "place")


@query(f"""WITH {_CENTERS}, n AS (SELECT cluster, count(*) population FROM near GROUP BY cluster) SELECT cluster, population FROM n WHERE population < (SELECT sum(population) FROM n) * 0.08e0""")
def anomalous_clusters(spark, sf_dir):
    return spectral.anomalous(_assigned(spark, sf_dir)[0], 0.08)


_GRID = f"""{fx.PIXELS}, g AS (SELECT y, x, s, CASE WHEN id % 4 = 0 THEN label ELSE -1 END cl FROM pixels), h AS (SELECT max(y) + 1 h FROM g),
sent AS (SELECT (y + dy + h) % h ny, (x + dx + 25) % 25 nx, s, cl FROM g, h, (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) v(dy, dx) WHERE cl >= 0),
met AS (SELECT g.y, g.x, min({{'d': sqrt(list_sum(list_transform(range(1, 65), lambda i: (g.s[i] - t.s[i]) * (g.s[i] - t.s[i])))), 'c': t.cl}}) m FROM g JOIN sent t ON g.y = t.ny AND g.x = t.nx WHERE g.cl < 0 GROUP BY ALL)"""


@query(f"WITH {_GRID} SELECT g.y, g.x, coalesce(met.m.c, g.cl)::INT cluster FROM g LEFT JOIN met ON met.y = g.y AND met.x = g.x")
def region_growth_step(spark, sf_dir):
    """One step of growing regions from a quarter of the pixels."""
    p = fx.pixels(spark, sf_dir)
    height = (p.agg(F.max("y")).first()[0] or 0) + 1
    labels = p.select("y", "x", "spectrum", F.when(F.col("id") % 4 == 0, F.col("label")).otherwise(-1).alias("cluster"))
    return spectral.grown(labels, fx.PIXELS_WIDE, height).select("y", "x", F.col("cluster").cast("int").alias("cluster"))


def _growth_sql(steps):
    """_GRID's step so many times over, from one pixel in forty: tables g0 to g<steps>."""
    made = [f"{fx.PIXELS}, h AS (SELECT max(y) + 1 h FROM pixels), g0 AS MATERIALIZED (SELECT y, x, s, CASE WHEN id % 40 = 0 THEN label ELSE -1 END cl FROM pixels)"]
    for i in range(steps):
        made.append(f"""sent{i} AS (SELECT (y + dy + h) % h ny, (x + dx + 25) % 25 nx, s, cl FROM g{i}, h, (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) v(dy, dx) WHERE cl >= 0),
met{i} AS (SELECT g.y, g.x, min({{'d': sqrt(list_sum(list_transform(range(1, 65), lambda i: (g.s[i] - t.s[i]) * (g.s[i] - t.s[i])))), 'c': t.cl}}) m FROM g{i} g JOIN sent{i} t ON g.y = t.ny AND g.x = t.nx WHERE g.cl < 0 GROUP BY ALL),
g{i + 1} AS MATERIALIZED (SELECT g.y, g.x, g.s, coalesce(m.m.c, g.cl) cl FROM g{i} g LEFT JOIN met{i} m ON m.y = g.y AND m.x = g.x)""")
    return ", ".join(made)


@query(f"WITH {_growth_sql(3)} " + " UNION ALL ".join(f"SELECT {i} step, y, x, cl::INT cluster FROM g{i}" for i in range(4)))
def growth_frames(spark, sf_dir):
    """The frames of regions that grow for three steps."""
    p = fx.pixels(spark, sf_dir)
    height = (p.agg(F.max("y")).first()[0] or 0) + 1
    labels = p.select("y", "x", "spectrum", F.when(F.col("id") % 40 == 0, F.col("label")).otherwise(-1).alias("cluster"))
    return spectral.growth_frames(labels, fx.PIXELS_WIDE, height, 3).withColumn("cluster", F.col("cluster").cast("int"))


def _k_means_sql(rounds):
    """Centres c0 to c<rounds>, each the means of the last ones' nearest pixels."""
    made = [f"{fx.PIXELS}, c0 AS (SELECT id::INT c, s cs FROM pixels WHERE id < 10)"]
    for i in range(rounds):
        made.append(f"""a{i} AS (SELECT p.id, p.s, min({{'d': sqrt(list_sum(list_transform(range(1, 65), lambda i: (p.s[i] - cs[i]) * (p.s[i] - cs[i])))), 'c': c}}) m FROM pixels p, c{i} GROUP BY ALL),
l{i} AS (SELECT m.c c, unnest(range(64)) i, unnest(s) v FROM a{i}), m{i} AS (SELECT c, i, avg(v) v FROM l{i} GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n.cs, c{i}.cs) cs FROM c{i} LEFT JOIN (SELECT c, list(v ORDER BY i) cs FROM m{i} GROUP BY c) n USING (c))""")
    return ", ".join(made)


@query(f"WITH {_k_means_sql(3)} SELECT c AS cluster, round(cs[1], 6) first, round(cs[32], 6) middle, round(cs[64], 6) last FROM c3")
def k_means_centers(spark, sf_dir):
    """Centres after three rounds from ten given ones."""
    centers = spectral.k_means(fx.pixels(spark, sf_dir).select("id", "spectrum"), _assigned(spark, sf_dir)[1], ["id"], rounds=3, still=0.0)
    return centers.select("cluster", r6(F.col("center")[0], "first"), r6(F.col("center")[31], "middle"), r6(F.col("center")[63], "last"))


@query(f"WITH {_growth_sql(5)} SELECT y, x, cl::INT cluster FROM g5")
def region_growth(spark, sf_dir):
    """Regions grown for five steps from one pixel in forty."""
    p = fx.pixels(spark, sf_dir)
    height = (p.agg(F.max("y")).first()[0] or 0) + 1
    labels = p.select("y", "x", "spectrum", F.when(F.col("id") % 40 == 0, F.col("label")).otherwise(-1).alias("cluster"))
    return spectral.region_growth(labels, fx.PIXELS_WIDE, height, steps=5).select("y", "x", F.col("cluster").cast("int").alias("cluster"))


@query(f"""WITH {fx.PIXELS}, a AS (SELECT DISTINCT y, x FROM pixels WHERE id % 2 = 0), b AS (SELECT DISTINCT y, x FROM pixels WHERE id % 3 = 0) SELECT * FROM a INTERSECT SELECT * FROM b""")
def common_pixels(spark, sf_dir):
    p = fx.pixels(spark, sf_dir)
    return p.where("id % 2 = 0").select("y", "x").intersect(p.where("id % 3 = 0").select("y", "x"))


@query("""SELECT a.l_linenumber band, a.n "first", b.n "second" FROM (SELECT l_linenumber, count(*) n FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY ALL) a JOIN (SELECT l_linenumber, count(*) n FROM lineitem WHERE l_orderkey % 5 = 0 GROUP BY ALL) b USING (l_linenumber)""")
def common_bands(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "lineitem").withColumn("band", F.col("l_linenumber"))
    a, b = (rows.where(F.col("l_orderkey") % k == 0).groupBy("band").agg(F.count(F.lit(1)).alias("place")) for k in (2, 5))
    return spectral.common_bands(a, b)


@query(f"WITH {fx.PIXELS}, c AS (SELECT label, count(*) n FROM pixels GROUP BY label), f AS (SELECT least(arg_min(n, label), 5000) n FROM c) SELECT label, least(c.n, f.n) n FROM c, f")
def balanced_training(spark, sf_dir):
    """How many pixels of each class a balanced training set takes."""
    return training.balanced(fx.pixels(spark, sf_dir)).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _classes(spark, sf_dir):
    p = fx.pixels(spark, sf_dir).select("id", F.col("spectrum").alias("features"), "label")
    return training.balanced(p), p


@query()
def svm_classes(spark, sf_dir):
    train, p = _classes(spark, sf_dir)
    return training.classified(training.classifier(train, "svm", cost=100.0, rounds=8), p).select("id", "label", "prediction")


@query()
def tree_classes(spark, sf_dir):
    train, p = _classes(spark, sf_dir)
    return training.classified(training.classifier(train, "tree"), p).select("id", "label", "prediction")


@query()
def bayes_classes(spark, sf_dir):
    train, p = _classes(spark, sf_dir)
    return training.classified(training.classifier(train, "bayes"), p).select("id", "label", "prediction")


@query()
def kernel_classes(spark, sf_dir):
    train, p = _classes(spark, sf_dir)
    return training.kernel_classified(train, p, gamma=1.0, most=500)


@query(f"""WITH {fx.PIXELS}, b AS (SELECT floor((50e0 + (y + 0.5) * -0.5 - 49) / -1)::INT "row", floor((10e0 + (x + 0.5) * 0.5 - 11) / 1)::INT col, arg_min(s, y * 1000 + x) s FROM pixels GROUP BY ALL),
m AS (SELECT a.y "row", a.x col, list_dot_product(a.s, a.s) * list_dot_product(b.s, b.s) n, list_dot_product(a.s, b.s) d FROM pixels a JOIN b ON a.y = b."row" AND a.x = b.col)
SELECT "row", col, round(CASE WHEN (n - d * d) / n BETWEEN 0 AND 1 THEN (n - d * d) / n ELSE 0 END, 6) "change" FROM m""")
def aligned_change(spark, sf_dir):
    """Change between two scenes of different grids, one twice as fine as the other."""
    p = fx.pixels(spark, sf_dir)
    return spectral.aligned_change(p, p, [11.0, 1.0, 0.0, 49.0, 0.0, -1.0], [10.0, 0.5, 0.0, 50.0, 0.0, -0.5]).select("row", "col", r6("change", "change"))


@query(f"""WITH {fx.PIXELS}, l AS (SELECT id, unnest(s) v FROM pixels) SELECT id, round(stddev_pop(v), 6) deviation FROM l GROUP BY id""")
def band_deviations(spark, sf_dir):
    return fx.pixels(spark, sf_dir).select("id", r6(spectral.band_deviation(F.col("spectrum")), "deviation"))

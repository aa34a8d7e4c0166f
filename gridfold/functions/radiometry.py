"""Radiance, irradiance and spectra as column expressions."""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Distance of Earth and Sun in astronomical units by day of the year.
EARTH_SUN = (
    (1, 0.9832), (15, 0.9836), (32, 0.9853), (46, 0.9878), (60, 0.9909), (74, 0.9945), (91, 0.9993), (106, 1.0033), (121, 1.0076), (135, 1.0109), (152, 1.0140), (166, 1.0158), (182, 1.0167),
    (196, 1.0165), (213, 1.0149), (227, 1.0128), (242, 1.0092), (258, 1.0057), (274, 1.0011), (288, 0.9972), (305, 0.9925), (319, 0.9892), (335, 0.9860), (349, 0.9843), (365, 0.9833), (366, 0.9832375),
)
# Solar irradiance of the nine multispectral bands, by band number.
IRRADIANCE = {2: 1851.8, 3: 1967.6, 4: 1837.2, 5: 1551.47, 6: 1164.53, 7: 957.46, 8: 451.37, 9: 230.03, 10: 79.61}
# The hyperspectral bands (first, last) whose mean stands for a multispectral band.
BINS = {2: (11, 16), 3: (9, 10), 4: (18, 25), 5: (28, 33), 6: (42, 45), 7: (49, 53), 8: (106, 115), 9: (141, 160), 10: (193, 219)}
# The carbon dioxide bands: background, and the two peaks.
CO2_BACKGROUND, CO2_PEAKS = (183, 184, 188, 189), (185, 186)
# Half of the smallest step of a radiance, added before logarithms.
LOG_OFFSET = 0.1 / 80.0


def band_number(name: Column) -> Column:
    return F.regexp_extract(name, r"^B0*([0-9]+)$", 1).cast("int")


def wavelength(number: Column) -> Column:
    """Nanometres of a hyperspectral band, whose two spectrometers meet between 70 and 71."""
    return F.when(number < 70.5, (number - 10.0) * 10.213 + 446.0).otherwise((number - 79.0) * 10.110 + 930.0)


def incident_solar(nanometres: Column) -> Column:
    """Black body of 5778 K, up to the factor that spectra are normalised by."""
    metres = nanometres * 1e-9
    return F.lit(2.5e-28) / (F.exp(F.lit(0.0143878) / metres / 5778.0) - 1.0) / F.pow(metres, F.lit(5.0))


def earth_sun_distance(day: Column) -> Column:
    """Linear between the tabulated days; the end values beyond them."""
    out = F.lit(EARTH_SUN[-1][1])
    for (a, x), (b, y) in reversed(list(zip(EARTH_SUN, EARTH_SUN[1:], strict=False))):
        out = F.when(day < b, F.lit(x) + (day - a) * ((y - x) / (b - a))).otherwise(out)
    return F.when(day <= EARTH_SUN[0][0], F.lit(EARTH_SUN[0][1])).otherwise(out)


def sun_corrected(radiance: Column, day: Column, elevation: Column) -> Column:
    """Radiance as if the sun stood overhead, at one astronomical unit; elevation in degrees."""
    d = earth_sun_distance(day)
    return F.lit(math.pi) * d * d * radiance / F.sin(F.radians(elevation))


def irradiance(number: Column, table: dict[int, float] = IRRADIANCE) -> Column:
    """A band's solar irradiance; band 1 and others without a row are errors."""
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    value = F.try_element_at(known, number)
    return F.coalesce(value, F.raise_error(F.concat(F.lit("no irradiance for band "), F.coalesce(number.cast("string"), F.lit("null")))).cast("double"))


def with_irradiance(rows: DataFrame, table: DataFrame, legacy_index: bool = False) -> DataFrame:
    """rows(number, radiance, ...) with reflected = radiance / irradiance from table(number, irradiance), one row a band.

    legacy_index takes the row after the band's own, as an off-by-one in older results did.
    """
    shift = 1 if legacy_index else 0
    by = table.select((F.col("number") - shift).alias("n_"), F.col("irradiance").alias("e_"))
    return rows.join(F.broadcast(by), F.col("number") == F.col("n_")).withColumn("reflected", F.col("radiance") / F.col("e_")).drop("n_", "e_")


def rescaled(value: Column, factor: Column, offset: Column, tenfold: Column | None = None) -> Column:
    """Stored counts (radiance over 30) as radiance. tenfold: whether the scene was stored over 300."""
    counts = value if tenfold is None else F.when(tenfold, value * 300.0 / 30.0).otherwise(value)
    return counts * 30.0 * factor + offset


def corrected(rows: DataFrame, irradiances: DataFrame) -> DataFrame:
    """The whole correction of rows(hyperspectral, number, value, factor, offset, day, elevation): multispectral counts to
    radiance, over the band's irradiance, as if the sun stood overhead; in column `corrected`.

    irradiances(hyperspectral, number, irradiance) has a row a band of each instrument. A band without one gets null.
    """
    by = irradiances.select(F.col("hyperspectral").alias("h_"), F.col("number").alias("n_"), F.col("irradiance").alias("e_"))
    radiance = F.when(F.col("hyperspectral"), F.col("value")).otherwise(rescaled(F.col("value"), F.col("factor"), F.col("offset")))
    met = rows.join(by, (F.col("hyperspectral") == F.col("h_")) & (F.col("number") == F.col("n_")), "left")
    return met.withColumn("corrected", sun_corrected(radiance / F.col("e_"), F.col("day"), F.col("elevation"))).drop("h_", "n_", "e_")


def stored_over_300(value: Column) -> Column:
    """Aggregate: whether all values of a scene are multiples of 1/300, as the sum of their rounding errors shows."""
    return F.sum(F.rint(value * 300.0) - value * 300.0) < 1e-4


def calibration(number: Column, vnir: Column, swir: Column, hyperspectral: Column) -> Column:
    """Factor from counts to radiance on ingest: the spectrometer's own, or 1/30."""
    return F.when(hyperspectral, F.when(number <= 70, 1.0 / vnir).otherwise(1.0 / swir)).otherwise(F.lit(1.0 / 30.0))


def bin_of(number: Column) -> Column:
    """Number of the multispectral band that a hyperspectral band counts towards, or null."""
    out = F.lit(None).cast("int")
    for wide, (low, high) in BINS.items():
        out = F.when(number.between(low, high), F.lit(wide)).otherwise(out)
    return out


def binned(pixels: DataFrame, keys: list[str], number: str = "number", value: str = "radiance") -> DataFrame:
    """Mean by pixel and multispectral band of the members that are there; bands without members give no row."""
    return pixels.withColumn("wide", bin_of(F.col(number))).where("wide is not null").groupBy(*keys, "wide").agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("members"))


def synthesised(pixels: DataFrame, weights: DataFrame, keys: list[str], number: str = "number", value: str = "radiance") -> DataFrame:
    """Weighted sums of bands: weights(number, synthetic, weight); without weights each member of a band counts alike."""
    by = weights.select(F.col(number).alias("n_"), "synthetic", "weight")
    return pixels.join(F.broadcast(by), F.col(number) == F.col("n_")).groupBy(*keys, "synthetic").agg(F.sum(F.col(value) * F.col("weight")).alias(value))


def sun_range(elevation: Column) -> Column:
    """Largest radiance to render for a sun elevation in degrees."""
    return F.greatest(F.lit(400.0) * F.sin(F.radians(elevation)), F.lit(10.0))


def co2_index(band) -> Column:
    """exp(-mean excess of the peaks over a straight line through the background), in log radiance. band(n): a column.

    The regression over four fixed bands is a fixed linear form in their logarithms. A missing (null) band gives 0.
    """
    xs = CO2_BACKGROUND
    n, sx, sxx = float(len(xs)), float(sum(xs)), float(sum(x * x for x in xs))
    delta = n * sxx - sx * sx
    log = {b: F.log(band(b) + LOG_OFFSET) for b in (*CO2_BACKGROUND, *CO2_PEAKS)}
    sy = sum((log[x] for x in xs[1:]), log[xs[0]])
    sxy = sum((log[x] * float(x) for x in xs[1:]), log[xs[0]] * float(xs[0]))
    constant, slope = (sy * sxx - sxy * sx) / delta, (sxy * n - sy * sx) / delta
    excess = sum(((log[p] - (constant + slope * float(p))) / 2.0 for p in CO2_PEAKS[1:]), (log[CO2_PEAKS[0]] - (constant + slope * float(CO2_PEAKS[0]))) / 2.0)
    return F.coalesce(F.exp(-excess), F.lit(0.0))


def superintensity(intensity: Column) -> Column:
    return intensity * intensity


def parse_time(text: Column) -> Column:
    """Unix seconds of 'year day-of-year h:m:s', in UTC."""
    return F.unix_timestamp(F.to_timestamp(text, "yyyy DDD HH:mm:ss"))


def angle_change(a: Column, b: Column) -> Column:
    """sin^2 of the angle between two spectra, in [0, 1]; 0 where rounding or an empty spectrum leads out of it."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    xx_yy = dot(a, a) * dot(b, b)
    value = (xx_yy - dot(a, b) * dot(a, b)) / F.nullif(xx_yy, F.lit(0.0))
    return F.when(value.between(0.0, 1.0), value).otherwise(F.lit(0.0))


def normalised(spectrum: Column, solar: Column) -> Column:
    """Spectrum over the incident light, scaled to length 1; all zeros for an empty one."""
    over = F.zip_with(spectrum, solar, lambda v, s: v / s)
    norm = F.sqrt(F.aggregate(over, F.lit(0.0), lambda s, v: s + v * v))
    return F.transform(over, lambda v: F.when(norm > 0, v / norm).otherwise(F.lit(0.0)))


def scaled_byte(value: Column, low: Column, high: Column) -> Column:
    """value on a scale from low (0) to high (255), clamped and cut to a whole number."""
    return F.greatest(F.least((value - low) / (high - low) * 255.0, F.lit(255.0)), F.lit(0.0)).cast("int")


def scaled_floor(value: Column, low: Column, high: Column) -> Column:
    """value on 256 steps from low to high, clamped to 0..255."""
    return F.greatest(F.least(F.floor((value - low) / (high - low) * 256.0), F.lit(255)), F.lit(0)).cast("int")


def sound_range(low: Column, high: Column, data_low: Column, data_high: Column) -> Column:
    """struct(low, high) with a width: the data's own range if there is none, and (0, 1) if that has none either."""
    flat, flat_data = low == high, data_low == data_high
    return F.struct(F.when(flat, F.when(flat_data, 0.0).otherwise(data_low)).otherwise(low).alias("low"), F.when(flat, F.when(flat_data, 1.0).otherwise(data_high)).otherwise(high).alias("high"))

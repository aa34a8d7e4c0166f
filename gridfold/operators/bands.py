"""Scenes as rows of pixels: band selection, masks, derived bands and class planes.

Wide pixels are (scene_id, y, x, spectrum array<double>) with the scene's band names beside them or given; long ones
(scene_id, y, x, band, value). 0 is no data, and stays 0: aggregates treat it otherwise than null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def without_bands(names: Column, outgoing: Sequence[str]) -> Column:
    """Bands of a scene that are listed, in the scene's order."""
    return F.filter(names, lambda n: n.isin(list(outgoing)))


def restricted_bands(names: Column, incoming: Sequence[str] | None) -> Column:
    """Bands to read: those wanted that are there, sorted; all in their order without a restriction."""
    return names if incoming is None else F.array_sort(F.array_intersect(names, F.array(*[F.lit(b) for b in incoming])))


def selected(names: Column, spectrum: Column, wanted: Sequence[str]) -> Column:
    """Values of the wanted bands in the wanted order; null for one that isn't there."""
    by = F.map_from_arrays(names, spectrum)
    return F.array(*[F.try_element_at(by, F.lit(b)) for b in wanted])


def missing_bands(names: Column, wanted: Sequence[str]) -> Column:
    return F.array_except(F.array(*[F.lit(b) for b in wanted]), names)


def valid(spectrum: Column) -> Column:
    """All bands above 0."""
    return F.forall(spectrum, lambda v: v > 0)


def analysable(spectrum: Column) -> Column:
    """First band above 0 and all others not 0; negative ones pass."""
    return (F.get(spectrum, F.lit(0)) > 0) & F.forall(F.slice(spectrum, 2, F.greatest(F.size(spectrum) - 1, F.lit(1))), lambda v: v != 0)


def lit(spectrum: Column) -> Column:
    """Sum of the bands above 0."""
    return F.aggregate(spectrum, F.lit(0.0), lambda s, v: s + v) > 0


def masked(spectrum: Column, mask: Column, cut: float = 0.01) -> Column:
    """All bands 0 where the mask is below the cut."""
    return F.when(mask < cut, F.transform(spectrum, lambda _: F.lit(0.0))).otherwise(spectrum)


def layers_of(scenes: DataFrame, layers: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Each scene with each layer all of whose bands it has."""
    known = F.array(*[F.struct(F.lit(n).alias("layer"), F.array(*[F.lit(b) for b in bs]).alias("wanted")) for n, bs in layers])
    made = scenes.withColumn("l_", F.explode(known)).select("*", "l_.*").drop("l_")
    return made.where(F.size(F.array_except("wanted", "bands")) == 0)


def with_band(pixels: DataFrame, band: str, value: Column) -> DataFrame:
    """Scene-to-scene functions add a plane: the name to bands and the value to each spectrum."""
    return pixels.withColumns({"bands": F.concat("bands", F.array(F.lit(band))), "spectrum": F.concat("spectrum", F.array(value.cast("double")))})


class Registry:
    """Named scene-to-scene functions, applied one after the other; code is registered, not read from files."""

    def __init__(self) -> None:
        self._known: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def register(self, name: str):
        def keep(f):
            self._known[name] = f
            return f

        return keep

    def apply(self, pixels: DataFrame, names: Sequence[str]) -> DataFrame:
        for name in names:
            if name not in self._known:
                raise KeyError(f"no scene function {name}; there are {sorted(self._known)}")
            pixels = pixels.transform(self._known[name])
        return pixels


def class_planes(classes: DataFrame, keys: list[str], label: str = "label", by_label: bool = False) -> DataFrame:
    """Three planes of a class image: clouds, land and water slots hold 1/class times the slot's number; slots beyond the
    third count into the first. A class's slot is its rank among those present, or its label as such."""
    present = classes.select(label).distinct()
    if by_label:
        ranked = present.withColumn("slot", F.col(label).cast("int"))
    else:  # one row a class
        ranked = present.withColumn("slot", (F.dense_rank().over(W.orderBy(label)) - 1).cast("int"))
    rows = classes.join(F.broadcast(ranked), label)
    value = F.lit(1.0) / F.col(label)
    plane = lambda k: F.when(F.col("slot") == k, value * (k + 1)).otherwise(F.when(F.col("slot") >= 3, value).otherwise(0.0) if k == 0 else 0.0)
    return rows.select(*keys, label, "slot", *[plane(k).alias(n) for k, n in enumerate(("clouds", "land", "water"))])


def tags(features: Column, threshold: Column) -> Column:
    return F.when(features < threshold, 1).otherwise(0)

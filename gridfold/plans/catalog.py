"""The registered queries of the library's own operators, each with the DuckDB SQL that it must equal."""

from __future__ import annotations

from gridfold.plans import inputs, maps, pictures, spectra
from gridfold.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "inputs", "maps", "pictures", "spectra"]

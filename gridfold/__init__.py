"""Multispectral raster, tile and point analytics on Spark."""

"""Gridded coastal flood depth from unstructured-mesh forecasts, as Spark DataFrames.

Sub-packages
------------
functions  column expressions (grid arithmetic, geometry, flags)
sources    readers: mesh text, crosswalks, coverage tables, mask layers, terrain tiles
operators  DataFrame -> DataFrame steps (joins, overlay, masks, weights, zonal mean, tiles)
sinks      writers: tables, raster tiles, chunk store, mesh exports
plans      whole jobs composed from the operators
streaming  incremental processing of landed forecast runs
"""

"""Thalweg: river-network, catchment, lake and raster-cell analytics as Spark DataFrame plans."""

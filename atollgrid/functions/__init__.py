"""Part of the raster land-cover engine."""

"""Spark operators for raster map tiles and satellite-scene catalogs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# tasks carry the functions they run, so executors need no copy of this package
register_pickle_by_value(sys.modules[__name__])

"""wattlake: energy analytics on Spark, from landed API pages to a star-schema mart."""

__version__ = "0.1.0"

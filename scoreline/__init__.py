"""scoreline: tournament analytics (landing -> bronze -> silver -> gold -> serving) on Spark."""

__version__ = "0.1.0"

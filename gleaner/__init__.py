"""Evidence analytics on Spark: selection, scoring, roll-up, calibration and ranking of short opinion texts."""

__version__ = "0.1.0"

"""Panel analytics on Spark DataFrames: features, splits, models and scoring."""

__version__ = "0.1.0"

"""Customer-retention analytics on Spark: quality, cleaning, features, models, reports."""

__version__ = "0.1.0"

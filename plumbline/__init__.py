"""Customer-text evaluation on Spark: sampling, validation, metrics, text features and model-response tables."""

__version__ = "0.1.0"

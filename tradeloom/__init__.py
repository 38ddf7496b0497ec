"""Trade analytics on Spark: clean, integrate, encode, stream and aggregate a trade star schema."""

__version__ = "0.1.0"

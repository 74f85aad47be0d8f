"""strata: layered (raw -> bronze -> silver -> gold) table building on Spark DataFrames."""
__version__ = "0.1.0"

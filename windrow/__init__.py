"""windrow: labelled-text preparation, vectorising, modelling and evaluation on Spark DataFrames."""

__version__ = "0.1.0"

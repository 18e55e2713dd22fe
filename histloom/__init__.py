"""histloom: historised party/agreement data-mart loads on Spark DataFrames."""

__version__ = "0.1.0"

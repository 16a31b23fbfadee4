"""taxoloom: link free-text records to a taxonomy and weave the result into a property graph, on Spark DataFrames."""

__version__ = "0.1.0"

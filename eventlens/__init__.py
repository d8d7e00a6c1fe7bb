"""eventlens: clickstream analytics on Spark DataFrames and Structured Streaming.

Every metric is a pure ``DataFrame -> DataFrame`` function that runs unchanged on
a batch table or a streaming DataFrame; only the source and the sink differ.
"""

__version__ = "0.1.0"

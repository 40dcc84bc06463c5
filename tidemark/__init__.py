"""tidemark: e-commerce event-stream analytics as Spark DataFrame plans.

Every analysis is a function from DataFrames to DataFrames.  Batch forms are
plain DataFrame/SQL plans that Catalyst optimises; streaming forms use
Structured Streaming (watermarks, windowed aggregation, stream-stream joins
and ``transformWithState`` processors).
"""

__version__ = "0.1.0"

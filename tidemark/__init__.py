"""tidemark: e-commerce event analytics on Spark.

Batch and Structured Streaming transforms over one event model: ingest from
CSV files, JSON topics and manual requests, validate with a reject split,
count per event-time window, rank the top categories of each window, and
write to table, topic or text sinks.
"""

__version__ = "0.1.0"

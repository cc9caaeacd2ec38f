"""Inputs: CSV files, topic records (Kafka or files), manual requests, order changes."""

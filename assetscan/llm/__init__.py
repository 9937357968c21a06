"""Operators for training-data pipelines: ten operators over document tables and their queries."""

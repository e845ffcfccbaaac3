"""Sources and sinks: raw CSV feeds and the lake layout."""

from bankmart.sources.bronze import CORRUPT, bronze_view, corrupt_counts, read_bronze, read_csv_text
from bankmart.sources.lake import Lake

__all__ = ["CORRUPT", "Lake", "bronze_view", "corrupt_counts", "read_bronze", "read_csv_text"]

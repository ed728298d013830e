"""navlake: fund price (NAV) histories as Spark DataFrames.

Feeds are parsed, deduplicated and merged into year-partitioned Parquet, labelled
from a scheme table, and queried for latest prices, summaries, as-of lookups,
returns, coverage and freshness. Every function takes and returns DataFrames.
"""

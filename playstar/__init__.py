"""A song-play warehouse built from Spark DataFrames.

Activity logs and song metadata come in as JSON, are staged as Parquet, and are
turned into a star schema of song plays that a few analytic reports read.
"""

"""Article monitoring on Spark: canonical articles, incremental loads, verdicts, digests."""

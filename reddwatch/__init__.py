"""Tag-detection analytics on Spark: passage times, daily entries, lengths, releases, gauges."""

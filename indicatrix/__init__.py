"""Internet-threat indicator analytics as Spark DataFrame, streaming and MLlib jobs."""

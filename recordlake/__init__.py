"""Build, enrich, profile, check and query partitioned record lakes on Spark."""

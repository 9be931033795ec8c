"""Company-registry open data on Spark: scan, clean, type, prune, enrich, profile."""

"""lexweave: analytics over hierarchical, time-stamped, cross-citing documents, on Spark."""

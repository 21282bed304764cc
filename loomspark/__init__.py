"""loomspark: curation, scoring and auditing of large corpora, as Spark DataFrame queries."""

"""Job-posting analytics as Spark jobs: feeds, history, signals, enrichment, ranking, delivery and monitoring."""

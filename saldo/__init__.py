"""Tax ledgers, price history and activity snapshots as Spark jobs."""

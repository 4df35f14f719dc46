"""Credit-risk lakehouse jobs on Spark: monthly snapshots, cleaned tables, label and feature stores."""

"""Reading and writing day-partitioned tables."""

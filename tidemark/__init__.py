"""Change-data replication on Spark: row-change events in, replica tables out."""

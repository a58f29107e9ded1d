"""Event-log analytics on Spark: ordering, intervals, attribution, ratings and data-quality gates."""

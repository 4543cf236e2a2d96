"""Commerce analytics on Spark: raw extracts to a published star schema."""

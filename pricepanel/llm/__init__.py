"""Training-data operators (near-dedup, packing, sharding, scoring, extraction) as Spark jobs."""

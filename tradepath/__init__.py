"""Commerce analytics on Spark: contracts, quality, Silver, KPIs, warehouse, streams."""

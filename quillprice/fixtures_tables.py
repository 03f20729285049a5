"""Names of the testdata tables (one parquet file each)."""

TESTDATA_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                   "events", "documents", "embeddings", "pages", "benchmark", "labels",
                   "conversations")

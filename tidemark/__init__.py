"""tidemark: Spark operators for point-in-time feature pipelines on tables and streams."""

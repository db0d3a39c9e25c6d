from tallyspark.sources.tables import RAW_TABLES, read_table  # noqa: F401

"""User-facing operators: DataFrame in, DataFrame out."""

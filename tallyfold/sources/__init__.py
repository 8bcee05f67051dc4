"""Reading delimited extracts and curated tables; writing Parquet and JDBC."""

"""tidemark: lakehouse data operators written with the public Spark APIs."""

"""Domain tables derived from the supplied tables, in Spark and in DuckDB SQL."""

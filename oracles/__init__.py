"""DuckDB SQL for every registered query, written against the given tables."""

"""Independent DuckDB SQL for the correctness check."""

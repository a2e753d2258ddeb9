"""Query registry, batch jobs, load audit and the DuckDB oracle texts."""

"""The registered queries, their inputs and their DuckDB twins."""

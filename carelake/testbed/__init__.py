"""Stand-in claims tables derived from the driver's test tables, the driver queries
built on them, and the DuckDB SQL each query is checked against."""

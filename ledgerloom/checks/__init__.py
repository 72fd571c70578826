"""Every operator as a query over the bundled test tables, and DuckDB SQL with the same result."""

"""Query catalogue (Spark) and its oracle (DuckDB SQL) over the driver's tables."""

"""Analytics over collections of semi-structured reports, as Spark DataFrame operations."""

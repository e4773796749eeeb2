"""Analytics over collections of benchmark-run artifacts, as Spark jobs over all runs at once."""

"""strataloom: medallion-style table work written as Spark DataFrame jobs."""

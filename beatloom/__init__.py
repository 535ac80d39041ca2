"""Heart-rate-variability analytics as Spark DataFrame operators."""

"""Daily ad-traffic and visit-path analytics as Spark DataFrame plans."""

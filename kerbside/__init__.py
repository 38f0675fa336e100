"""Kerbside: ride-hailing event analytics written as Spark DataFrame jobs."""

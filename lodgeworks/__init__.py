"""Booking analytics on Spark: every operator is a ``DataFrame -> DataFrame`` function."""

"""Utility-meter statistics as Spark jobs: consumption, tariffs, carbon and grain roll-ups."""

"""Odds analytics on PySpark: generic DataFrame operators plus ready plans."""

"""Spatio-temporal panel analytics on PySpark: plain DataFrame-to-DataFrame operators."""

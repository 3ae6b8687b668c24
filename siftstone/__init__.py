"""Screening analytics and text-corpus operators on PySpark."""

"""Operators of a training-data pipeline. The rest of the library imports nothing from here."""

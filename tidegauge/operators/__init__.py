"""Operators on readings: plain ``DataFrame -> DataFrame`` functions."""

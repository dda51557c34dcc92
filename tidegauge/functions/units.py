"""Temperature units."""

from pyspark.sql import Column, functions as F


def celsius(fahrenheit: Column | str) -> Column:
    column = F.col(fahrenheit) if isinstance(fahrenheit, str) else fahrenheit
    return (column - 32) * (5.0 / 9.0)

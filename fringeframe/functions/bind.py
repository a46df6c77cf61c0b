"""Bind an expression to a name inside another one.

Catalyst may inline a column into the lambda of a higher-order function, where
it would be evaluated once per element; a bound value is computed once per row.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(expr: Column, body) -> Column:
    return F.get(F.transform(F.array(expr), body), F.lit(0))

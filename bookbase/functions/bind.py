"""Naming a value inside an expression."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value, body) -> Column:
    """`body(v)` with `v` worked out once, however often and however deep `body` uses it.

    An expression named in a lambda is otherwise evaluated again for every element, also when
    it was given its own column first, since the optimizer may put it back in place.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))

"""Evaluate an expensive expression once.

Spark repeats an expression wherever it is referred to inside branches and pushes filters on it
below the projection that computes it. A lambda variable or a generator pins it to one evaluation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def keep_if(value: Column, test: Callable[[Column], Column]) -> Column:
    """Generator for ``select``: the value where it passes the test, no row where it does not."""
    return F.explode(F.filter(F.array(value), test))

"""Helpers for array higher-order expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Reusing a Column object in Python copies its expression subtree into the
    plan; binding it through a one-element ``transform`` keeps the plan small
    and computes the value once per row.
    """
    return F.get(F.transform(F.array(value), body), 0)


_CACHE: dict = {}


def cached_expr(key: tuple, build):
    """Build a (large, unresolved) Column once per Spark application and reuse it.

    Building an expression costs one JVM call per node; the parse/typing
    expressions have thousands of nodes, so rebuilding them for every query
    dominated planning time.  Unresolved Columns reference inputs by name, so
    one instance serves every DataFrame with those column names."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    app = sc.applicationId if sc is not None else None
    full = (app,) + key
    col = _CACHE.get(full)
    if col is None:
        # The keys are a few names of stages and columns; an older application's entries go.
        for old in [k for k in _CACHE if k[0] != app]:
            del _CACHE[old]
        col = build()
        _CACHE[full] = col
    return col

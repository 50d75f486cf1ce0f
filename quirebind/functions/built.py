"""Columns that are built once.

Every call that makes a Column goes to the JVM and back.  The conversion has thousands of
them, which took longer than a micro-batch's rows; Columns name what they read, so one
built for the first batch serves all.
"""

from collections.abc import Callable
from functools import wraps
from typing import Any

from pyspark import SparkContext


def built_once(build: Callable[..., Any]) -> Callable[..., Any]:
    """Keep what ``build`` makes of names and numbers alone, as long as the JVM lives."""
    kept: dict[tuple, Any] = {}

    @wraps(build)
    def get(*args):
        key = (SparkContext._gateway, *args)
        if key not in kept:
            if any(k[0] is not key[0] for k in kept):
                kept.clear()
            kept[key] = build(*args)
        return kept[key]

    return get

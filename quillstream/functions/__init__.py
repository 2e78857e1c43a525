"""Column functions.  Public functions accept Column objects or column names
for their leading column arguments."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F


def columns(n: int = 1):
    """Let the first ``n`` positional arguments be column names as well."""

    def deco(fn):
        @functools.wraps(fn)
        def wrapper(*args, **kwargs):
            args = [F.col(a) if i < n and isinstance(a, str) else a for i, a in enumerate(args)]
            return fn(*args, **kwargs)

        return wrapper

    return deco

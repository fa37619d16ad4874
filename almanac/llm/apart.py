"""Columns of an operator's own beside those of its input."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame

OWN = "__"


def own_columns_apart(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Lets an operator take tables with columns that are named like those it makes for itself and drops again.

    Those begin with ``OWN``.  Columns of the first table that do so bear other names inside the operator and their own again in its
    result; a table without any is passed on as it is.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        given = [c for c in docs.columns if c.startswith(OWN)]
        if not given:
            return operator(docs, *args, **kwargs)
        start = "given"
        while any(c.lower().startswith(start) for c in docs.columns):
            start += "_"
        inside = {c: start + c for c in given}
        result = operator(docs.withColumnsRenamed(inside), *args, **kwargs)
        return result.withColumnsRenamed({new: c for c, new in inside.items()})

    return run

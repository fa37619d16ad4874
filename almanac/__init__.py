"""almanac: calendar, run-log and model-building operators on Spark DataFrames.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a ``Column``
expression), so pipelines are written with ``df.transform(...)`` and planned by
Catalyst as one query.
"""

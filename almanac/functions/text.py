"""Run-date macros, JSON fields, URL parameters and message rendering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ds(ts: Column | str) -> Column:
    """Run date as ``YYYY-MM-DD``."""
    return _col(ts).cast("date").cast("string")


def ds_add(ts: Column | str, days: int) -> Column:
    """Run date moved by ``days``, as ``YYYY-MM-DD``."""
    return F.date_add(_col(ts).cast("date"), days).cast("string")


def json_field(document: Column | str, path: str, default: str = "") -> Column:
    """Text at ``path``, or ``default`` where the field is absent or the JSON broken."""
    return F.coalesce(F.get_json_object(_col(document), path), F.lit(default))


def with_json_fields(df: DataFrame, document: str, names: Sequence[str]) -> DataFrame:
    """Add several top-level fields as text columns, parsing each document once."""
    return df.select("*", F.json_tuple(document, *names).alias(*names))


def json_int(document: Column | str, path: str) -> Column:
    """Integer at ``path``; NULL where absent or not a number."""
    return F.get_json_object(_col(document), path).try_cast("int")


def json_equals(document: Column | str, path: str, number: int) -> Column:
    """Does the field hold ``number``?  Absent fields answer false."""
    return F.coalesce(json_int(document, path) == number, F.lit(False))


def has_text(body: Column | str, needle: str) -> Column:
    """Does the whole body contain ``needle``?"""
    return F.contains(_col(body), F.lit(needle))


def url_host(url: Column | str) -> Column:
    return F.try_parse_url(_col(url), F.lit("HOST"))


def url_param(url: Column | str, name: str) -> Column:
    """Decoded query parameter; NULL where absent."""
    return F.try_url_decode(F.try_parse_url(_col(url), F.lit("QUERY"), F.lit(name)))


def form_param(body: Column | str, name: str) -> Column:
    """Decoded field of an ``a=b&c=d`` form body; NULL where absent."""
    return url_param(F.concat(F.lit("http://form/?"), _col(body)), name)


def render(template: str, *values: Column | str) -> Column:
    """printf-style message, e.g. ``render("run %s of %s", "run_id", "owner")``."""
    return F.format_string(template, *[_col(v) for v in values])


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value

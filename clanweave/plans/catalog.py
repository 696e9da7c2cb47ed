"""Registry of runnable queries: each has a name, a DataFrame form and, where SQL can express it, a SQL form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clanweave.plans.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_VIEWS: dict[tuple[str, str], Views] = {}


def views(spark: SparkSession, sf_dir: str) -> Views:
    """Views are shared within a session, so a materialised view is computed once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _VIEWS:
        _VIEWS[key] = Views(spark, sf_dir)
    return _VIEWS[key]


def forget_views() -> None:
    """Let the next query materialise its views again (for timing)."""
    _VIEWS.clear()


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(views(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return register


def load_all() -> None:
    """Import every query module that registers itself here."""
    import importlib
    import pkgutil

    from clanweave import plans

    for m in sorted(m.name for m in pkgutil.iter_modules(plans.__path__) if m.name.startswith("q_")):
        importlib.import_module(f"clanweave.plans.{m}")

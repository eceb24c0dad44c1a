"""All queries of the library's own operators."""

from . import checks, curation, ranking, registry, relational, text, wording  # noqa: F401


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict:
    return dict(registry.ORACLE)

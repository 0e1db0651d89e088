"""All registered queries (batch catalogue + streaming catalogue), and those that return an estimate."""

from __future__ import annotations


def all_queries():
    from candela.plans import catalog, stream_catalog  # noqa: F401  (the latter registers into catalog.QUERIES)

    return dict(catalog.QUERIES)


def estimates():
    from candela.plans import catalog

    return dict(catalog.ESTIMATES)

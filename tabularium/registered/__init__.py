"""Queries over the star-schema tables, each next to the SQL that must give the same rows."""

from tabularium.registered import columns, files, pages, registry, tables  # noqa: F401
from tabularium.registered.book import ORACLES, QUERIES

"""Checks of the operators on the test tables, each with an independent SQL statement."""

from weirgate.catalogue import audits, joins, readers, shaping, streams, strict, targets  # noqa: F401
from weirgate.catalogue.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

"""Named queries over the test tables, each with an independent SQL formulation where SQL can say it."""

from . import access, ads, audit, calls, groups, landed, scalars, sources, visits, warehouse  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

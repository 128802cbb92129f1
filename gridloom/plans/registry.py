"""Names, plans and SQL of every query."""

from gridloom.plans import fields, grid, stored  # noqa: F401  they register
from gridloom.plans.derived import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

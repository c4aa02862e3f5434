"""Reads (select, SQL with parameters, recent rows, running totals), table changes and constraint checks."""

from .bloom import might_hold
from .constraints import ConstraintViolation, check_constraints
from .reads import execute, recent, select
from .tables import BUCKET, delete, drop, execute_many, insert, recover, update, vacuum
from .windows import ranked, running_total

__all__ = [
    "BUCKET",
    "ConstraintViolation",
    "check_constraints",
    "delete",
    "drop",
    "execute",
    "execute_many",
    "insert",
    "might_hold",
    "ranked",
    "recent",
    "recover",
    "running_total",
    "select",
    "update",
    "vacuum",
]

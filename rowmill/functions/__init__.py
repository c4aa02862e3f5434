"""Column-level functions: JSON containment, interval filters, SQL literals and the typing ladders."""

from .added import infer_types_of_files
from .containment import json_contains
from .ladders import apply_types, infer_types, map_types
from .literals import sql_literal

__all__ = ["apply_types", "infer_types", "infer_types_of_files", "json_contains", "map_types", "sql_literal"]

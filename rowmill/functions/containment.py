"""JSON containment as a Column predicate (``document @> literal``)."""

from __future__ import annotations

import json
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F

_BIGINT_MIN, _BIGINT_MAX = -(2**63), 2**63 - 1


def json_contains(document: Column | str, literal: str) -> Column:
    """True where the JSON ``document`` contains the JSON ``literal``.

    Objects match when every member of the literal is contained in the member of the same name, arrays when every
    element of the literal is contained in some element of the document, scalars when kind and value are equal
    (``69`` and ``69.0`` are equal, ``69`` and ``"69"`` are not). An array document contains a bare top-level
    scalar when one of its elements equals it. Null documents give NULL, so a filter drops them.

    ``document`` is a VARIANT column; for JSON text pass ``F.try_parse_json(column)``. The literal is parsed once, on
    the driver, into one predicate per member, so the whole test stays in built-in expressions.
    """
    wanted = json.loads(literal, parse_float=Decimal)
    variant = F.col(document) if isinstance(document, str) else document
    test = _contains(variant, "$", wanted)
    if not isinstance(wanted, (dict, list)):
        test = test | _some_element_contains(variant, "$", wanted)
    return F.when(variant.isNotNull(), test)


def _get(variant: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(variant, path, kind)


def _kind(variant: Column, path: str) -> Column:
    return F.schema_of_variant(variant if path == "$" else _get(variant, path, "variant"))


def _contains(variant: Column, path: str, wanted: object) -> Column:
    """Never NULL. The value at ``path`` is compared in place; only what may match is looked at more closely."""
    if isinstance(wanted, dict):
        if not wanted:
            return F.coalesce(_kind(variant, path).startswith("OBJECT"), F.lit(False))
        return reduce(lambda a, b: a & b, [_member_contains(variant, path, *member) for member in wanted.items()])
    if isinstance(wanted, list):
        if not wanted:
            return _get(variant, path, "array<variant>").isNotNull()
        return reduce(lambda a, b: a & b, [_some_element_contains(variant, path, value) for value in wanted])
    return F.coalesce(_equals(variant, path, wanted), F.lit(False))


def _member_contains(variant: Column, path: str, name: str, wanted: object) -> Column:
    if name and "'" not in name and "?" not in name:
        return _contains(variant, f"{path}['{name}']", wanted)
    # a name that extraction paths cannot spell
    members = _get(variant, path, "map<string,variant>")
    return _contains(F.try_element_at(members, F.lit(name)), "$", wanted)


def _some_element_contains(variant: Column, path: str, wanted: object) -> Column:
    elements = _get(variant, path, "array<variant>")
    return F.coalesce(F.exists(elements, lambda element: _contains(element, "$", wanted)), F.lit(False))


def _equals(variant: Column, path: str, wanted: object) -> Column:
    """Equal value first, which is cheap but converts between kinds, then the same kind."""
    if wanted is None:
        return _get(variant, path, "string").isNull() & (_kind(variant, path) == "VOID")
    if isinstance(wanted, bool):
        return (_get(variant, path, "boolean") == F.lit(wanted)) & (_kind(variant, path) == "BOOLEAN")
    if isinstance(wanted, str):
        return (_get(variant, path, "string") == F.lit(wanted)) & (_kind(variant, path) == "STRING")
    equal = _get(variant, path, "double") == F.lit(float(wanted))
    kind = _kind(variant, path)
    exact = Decimal(wanted)
    before_point = max(1, exact.adjusted() + 1)
    same = kind.isin("DOUBLE", "FLOAT")
    if before_point <= 38 and -exact.normalize().as_tuple().exponent <= 38 - before_point:
        # the decimal type that has all places a number of this size can have
        number = _get(variant, path, f"decimal(38,{38 - before_point})")
        same |= kind.startswith("DECIMAL") & (number == F.lit(str(exact)).cast(f"decimal(38,{38 - before_point})"))
    if exact == int(exact) and _BIGINT_MIN <= exact <= _BIGINT_MAX:
        same |= (kind == "BIGINT") & (_get(variant, path, "bigint") == F.lit(int(exact)))
    return equal & same

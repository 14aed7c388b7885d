"""Walks over a declared record type, which become one expression per record.

A walker follows the StructType, not the rows: what a record may hold is known when the plan is made, and lists are
walked by ``transform``. Paths carry the index of every list they pass, such as ``component[1].code.coding[0]``.
Branches that hold nothing of interest are never read, so column pruning still works.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paths import _STEP

#: What a leaf rule gets: the field's name and type, and the type of the struct around it. It returns a function that
#: makes the new value from the old one and the struct around it, or None.
Rule = Callable[[str, T.DataType, T.StructType], "Callable[[Column, Column], Column] | None"]

#: Whether any text of a list may be one that the rule of a leaf changes; it gets what a rule gets. Null counts as true.
May = Callable[[str, T.DataType, T.StructType], "Callable[[Column], Column]"]

CHANGE = "array<struct<path:string,old:string,new:string>>"


def _below(path: Column | None, name: str) -> Column:
    return F.lit(name) if path is None else F.concat(path, F.lit(f".{name}"))


def _item(path: Column, index: Column) -> Column:
    return F.concat(path, F.lit("["), index.cast("string"), F.lit("]"))


def is_reference(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and any(f.name == "reference" and isinstance(f.dataType, T.StringType) for f in kind.fields)


def holds(kind: T.DataType, test: Callable[[T.DataType], bool]) -> bool:
    """Whether a type or any type inside it passes a test."""
    if test(kind):
        return True
    if isinstance(kind, T.ArrayType):
        return holds(kind.elementType, test)
    return isinstance(kind, T.StructType) and any(holds(f.dataType, test) for f in kind.fields)


def type_at(schema: T.StructType, spec: str) -> T.DataType | None:
    """Type of a path such as ``a.b[0].c`` or ``a[*].b``, or None where the schema has no such field; nothing is analysed."""
    kind: T.DataType | None = schema
    many = False
    for name, brackets in _STEP.findall(spec):
        if many and isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return None
        kind = kind[name].dataType
        for inside in re.findall(r"\[([^\]]*)\]", brackets):
            if not isinstance(kind, T.ArrayType):
                return None
            many = many or inside == "*"
            kind = kind if inside == "*" else kind.elementType
    return T.ArrayType(kind) if many and not isinstance(kind, T.ArrayType) else kind


# ---- every reference of a record ----

_FOUND = "array<struct<path:string,reference:string>>"


def references(schema: T.StructType) -> Column:
    """All references of a record as a list of (path, reference), in the order of the schema.

    The path of an object is that of the object; one that is an element of a list ends in ``.reference``.
    """
    parts = [_references(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in schema.fields if holds(f.dataType, is_reference)]
    return F.concat(*parts) if parts else F.array().cast(_FOUND)


def _references(value: Column, kind: T.DataType, path: Column, in_list: bool = False) -> Column:
    if isinstance(kind, T.ArrayType):
        each = F.transform(value, lambda x, i: _references(x, kind.elementType, _item(path, i), True))
        return F.coalesce(F.flatten(each), F.array().cast(_FOUND))
    parts = []
    if is_reference(kind):
        ref = value["reference"]
        own = F.array(F.struct((_below(path, "reference") if in_list else path).alias("path"), ref.alias("reference")))
        parts.append(F.when(ref != "", own).otherwise(F.array().cast(_FOUND)))
    parts += [_references(value[f.name], f.dataType, _below(path, f.name)) for f in kind.fields if holds(f.dataType, is_reference)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


# ---- corrected copies and what changed ----

def _touched(kind: T.DataType, rule: Rule) -> bool:
    """Whether a rule changes anything inside a type."""
    return holds(kind, lambda k: isinstance(k, T.StructType) and any(rule(f.name, f.dataType, k) for f in k.fields))


def leaves(items: Column, kind: T.DataType, rule: Rule) -> list[tuple[str, T.DataType, T.StructType, Column]]:
    """Name, type, struct around and all values, as one flat list, of each leaf that a rule can change in the elements of a list."""
    if isinstance(kind, T.ArrayType):
        return leaves(F.flatten(F.array_compact(items)), kind.elementType, rule)  # flatten alone is null where an inner list is
    out = []
    for f in kind.fields:
        if rule(f.name, f.dataType, kind) is not None:
            out.append((f.name, f.dataType, kind, items[f.name]))
        elif _touched(f.dataType, rule):
            out += leaves(items[f.name], f.dataType, rule)
    return out


def makings(schema: T.StructType, rule: Rule, may: May) -> dict[str, Column]:
    """What corrected copies and change lists of a record are made of, by its path: the new value of each leaf outside lists, and for each
    outermost list its corrected copy, or null where it holds nothing to change. Lambdas are interpreted, so few lists should be walked."""
    out: dict[str, Column] = {}

    def visit(value, kind, path):
        if isinstance(kind, T.ArrayType):
            tests = [~may(name, leaf, around)(flat).eqNullSafe(F.lit(False)) for name, leaf, around, flat in leaves(value, kind.elementType, rule)]
            out[path] = F.when(value.isNotNull() & reduce(Column.__or__, tests), _rewrite(value, kind, rule))
            return
        for f in kind.fields:
            own, at = rule(f.name, f.dataType, kind), f"{path}.{f.name}" if path else f.name
            inner = F.col(f"`{f.name}`") if value is None else value[f.name]
            if own is not None:
                out[at] = own(inner, F.struct(*[F.col(f"`{x.name}`") for x in schema.fields]) if value is None else value)
            elif _touched(f.dataType, rule):
                visit(inner, f.dataType, at)

    visit(None, schema, "")
    return out


def rewrite(schema: T.StructType, rule: Rule, made: dict[str, Column] | None = None) -> dict[str, Column]:
    """New values of the columns that a rule can change; other columns, and other branches of these, are not rebuilt.

    ``made`` holds the columns of ``makings``; without it every list is walked.
    """
    out = {}
    for f in schema.fields:
        own = rule(f.name, f.dataType, schema)
        if own is not None:
            out[f.name] = made[f.name] if made else own(F.col(f"`{f.name}`"), F.struct(*[F.col(f"`{x.name}`") for x in schema.fields]))
        elif _touched(f.dataType, rule):
            out[f.name] = _rewrite(F.col(f"`{f.name}`"), f.dataType, rule, made, f.name)
    return out


def _rewrite(value: Column, kind: T.DataType, rule: Rule, made: dict[str, Column] | None = None, at: str = "") -> Column:
    if isinstance(kind, T.ArrayType):
        return F.coalesce(made[at], value) if made else F.transform(value, lambda x: _rewrite(x, kind.elementType, rule))
    new = value
    for f in kind.fields:
        own, inner = rule(f.name, f.dataType, kind), f"{at}.{f.name}"
        if own is not None:
            new = new.withField(f.name, made[inner] if made else own(value[f.name], value))
        elif _touched(f.dataType, rule):
            new = new.withField(f.name, _rewrite(value[f.name], f.dataType, rule, made, inner))
    return new  # a null struct stays null


def changes(schema: T.StructType, rule: Rule, made: dict[str, Column], label: Callable[[Column, str], Column]) -> Column:
    """A list of (path, old, new) of the leaves that a rule changes in a record; ``made`` holds the columns of ``makings``.

    ``label`` makes the logged path from the path of the struct and the name of the field.
    """
    def outside(value, kind, path, at):
        if isinstance(kind, T.ArrayType):
            return [F.when(made[at].isNotNull(), _changes(value, made[at], kind, rule, path, label)).otherwise(F.array().cast(CHANGE))]
        parts = []
        for f in kind.fields:
            inner = f"{at}.{f.name}"
            if rule(f.name, f.dataType, kind) is not None:
                parts.append(changed(value[f.name], made[inner], label(path, f.name)))
            elif _touched(f.dataType, rule):
                parts += outside(value[f.name], f.dataType, _below(path, f.name), inner)
        return parts

    parts = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`")
        if rule(f.name, f.dataType, schema) is not None:
            parts.append(changed(value, made[f.name], F.lit(f.name)))
        elif _touched(f.dataType, rule):
            parts += outside(value, f.dataType, F.lit(f.name), f.name)
    return F.concat(*parts) if parts else F.array().cast(CHANGE)


def _changes(before: Column, after: Column, kind: T.DataType, rule: Rule, path: Column, label: Callable[[Column, str], Column]) -> Column:
    if isinstance(kind, T.ArrayType):
        each = F.transform(before, lambda x, i: _changes(x, F.get(after, i), kind.elementType, rule, _item(path, i), label))
        return F.coalesce(F.flatten(each), F.array().cast(CHANGE))
    parts = []
    for f in kind.fields:
        old, new = before[f.name], after[f.name]
        if rule(f.name, f.dataType, kind) is not None:
            parts.append(changed(old, new, label(path, f.name)))
        elif _touched(f.dataType, rule):
            parts.append(_changes(old, new, f.dataType, rule, _below(path, f.name), label))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def changed(old: Column, new: Column, path: Column) -> Column:
    item = F.array(F.struct(path.alias("path"), old.cast("string").alias("old"), new.cast("string").alias("new")))
    return F.when(~old.eqNullSafe(new), item).otherwise(F.array().cast(CHANGE))


# ---- one type for drifting ones ----

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_REAL = [T.FloatType, T.DoubleType]


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both: fields of structs are united, elements of lists and values of
    maps are widened, whole numbers grow to the larger and, with real ones, to double, a date with an instant to the
    instant. Types that have nothing in common become text; a nested value is JSON there."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b.fields}
        own = [T.StructField(f.name, widest(f.dataType, other[f.name]) if f.name in other else f.dataType) for f in a.fields]
        return T.StructType(own + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.names])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, widest(a.valueType, b.valueType))
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, *_REAL, T.DecimalType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one type as another that ``widest`` made of it: absent fields are null, other branches are cast."""
    if _same(have, want):
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        made = F.struct(*[(conform(value[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])
        return F.when(value.isNotNull(), made)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(value, lambda _, x: conform(x, have.valueType, want.valueType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(want)


def _same(a: T.DataType, b: T.DataType) -> bool:
    """Whether types are alike but for what may be null."""
    return a.simpleString() == b.simpleString()

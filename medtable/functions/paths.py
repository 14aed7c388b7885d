"""Path projections over nested records, as native Column expressions.

``path("name[?use='official'].given[0]")`` builds a plain Catalyst expression, so nested column
pruning and code generation apply. A miss anywhere gives null.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"([A-Za-z_]\w*)((?:\[[^\]]*\])*)")
_COND = re.compile(r"\?\s*(\w+)\s*=\s*'([^']*)'")


class Nav:
    """A column with navigation steps; every step returns a new ``Nav``."""

    def __init__(self, col: Column, many: bool = False):
        self.col, self.many = col, many

    def f(self, name: str) -> Nav:
        """Field access; over a list it maps and drops nulls."""
        if self.many:
            mapped = F.transform(self.col, lambda x: x.getField(name))
            return Nav(F.filter(mapped, lambda x: x.isNotNull()), True)
        return Nav(self.col.getField(name))

    def flat(self, name: str) -> Nav:
        """Field that is itself a list; one flat list results."""
        if self.many:
            nested = F.transform(self.col, lambda x: F.coalesce(x.getField(name), F.array().cast("array<void>")))
            return Nav(F.flatten(nested), True)
        return Nav(self.col.getField(name), True)

    def at(self, index: int) -> Nav:
        """List index; null when out of range."""
        return Nav(F.get(self.col, F.lit(index)))

    def all(self) -> Nav:
        return Nav(self.col, True)

    def where(self, name: str, value: str) -> Nav:
        """List elements whose field equals a value."""
        return Nav(F.filter(self.col, lambda x: x.getField(name) == value), True)

    def first(self, default: str | None = None) -> Column:
        head = F.get(self.col, F.lit(0)) if self.many else self.col
        return head if default is None else F.coalesce(head, F.lit(default))

    def exists(self) -> Column:
        """True when the path yields anything."""
        if self.many:
            return F.coalesce(F.size(self.col) > 0, F.lit(False))
        return self.col.isNotNull()

    def values(self) -> Column:
        """The list without nulls, or null when empty."""
        kept = F.filter(self.col, lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)


def nav(name: str) -> Nav:
    return Nav(F.col(name))


def path(spec: str, root: Column | None = None) -> Column:
    """Dotted path with ``[n]``, ``[*]`` and ``[?field='v']`` selectors."""
    here: Nav | None = None if root is None else Nav(root)
    for step in re.split(r"\.(?![^\[]*\])", spec):
        found = _STEP.fullmatch(step)
        if not found:
            raise ValueError(f"bad path step {step!r} in {spec!r}")
        name, selectors = found.groups()
        here = nav(name) if here is None else here.f(name)
        for selector in re.findall(r"\[([^\]]*)\]", selectors):
            condition = _COND.fullmatch(selector)
            if selector == "*":
                here = here.all()
            elif condition:
                here = Nav(here.where(*condition.groups()).first())
            else:
                here = here.at(int(selector))
    return here.values() if here.many else here.col


def first_of(*options: str | Column) -> Column:
    """First non-null of several paths."""
    return F.coalesce(*[path(o) if isinstance(o, str) else o for o in options])


def text_of(col: Column, scalar: bool = True) -> Column:
    """Value as text; structured values as JSON."""
    return col.cast("string") if scalar else F.to_json(col)


def as_bool(col: Column) -> Column:
    """True for true / yes / 1; false for any other text; null stays null."""
    return F.when(col.isNotNull(), F.lower(F.trim(col.cast("string"))).isin("true", "yes", "1"))


def as_int(col: Column) -> Column:
    return col.try_cast("int")


def as_float(col: Column) -> Column:
    return col.try_cast("double")


def as_timestamp(col: Column) -> Column:
    return F.try_to_timestamp(col.cast("string"))


def as_array(col: Column) -> Column:
    """A scalar becomes a list of one."""
    return F.when(col.isNotNull(), F.array(col))


def strip_prefix(col: Column, prefix: str) -> Column:
    """C20: drop a leading ``Type/``."""
    return F.regexp_replace(col, "^" + re.escape(prefix), "")


def strip_tags(col: Column) -> Column:
    """Remove markup tags."""
    return F.regexp_replace(col, "<.*?>", "")


def template(fmt: str, *cols: Column) -> Column:
    """``{}`` slots filled with columns; null when any is null."""
    pieces = fmt.split("{}")
    parts = [F.lit(pieces[0])]
    for col, piece in zip(cols, pieces[1:]):
        parts += [col.cast("string"), F.lit(piece)]
    return F.concat(*parts)


def both(left: Column, right: Column) -> Column:
    """``&`` concatenation, null when either side is missing."""
    return F.concat(left, right)


def union_values(*lists: Column) -> Column:
    """``|`` union of lists, missing ones count as empty."""
    return F.array_distinct(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists]))

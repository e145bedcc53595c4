"""Typed wrappers of Spark columns, as row lambdas see them.

Comparison follows the object language: two nulls are equal, and a predicate is true or
false. Equality is null-safe; other comparisons stay plain, so they reach the scan, and
are made two-valued only where they are negated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from queryset.errors import TranslationError


def column(value) -> Column:
    """The Spark column of an expression, a constant or a Column."""
    if isinstance(value, Expr):
        return value.col
    if isinstance(value, Column):
        return value
    if isinstance(value, Fields):
        return value.struct()
    if isinstance(value, (list, tuple)):
        return F.array(*(column(v) for v in value))
    if callable(value):
        raise TranslationError(f"client code {getattr(value, '__name__', value)!r} can't run inside a query; use select_client for the final projection")
    if hasattr(value, "to_column"):
        return value.to_column()
    return F.lit(value)


class Expr:
    """A scalar expression. Python's and, or, not, in and if can't be captured: use & | ~, isin and cond()."""

    __hash__ = None

    def __init__(self, col: Column):
        self.col = col

    def __bool__(self):
        raise TranslationError("an expression has no truth value in Python: use & | ~, isin() and cond()")

    def __iter__(self):
        raise TranslationError("an expression can't be iterated; use explode or array functions")

    def __contains__(self, item):
        raise TranslationError("use contains() or isin() in place of in")

    # Comparison

    def __eq__(self, other):
        if other is None:
            return Expr(self.col.isNull())
        return Expr(self.col == F.lit(other) if isinstance(other, (int, float, str, bool)) else self.col.eqNullSafe(column(other)))

    def __ne__(self, other):
        if other is None:
            return Expr(self.col.isNotNull())
        return Expr(~self.col.eqNullSafe(column(other)))

    def __lt__(self, other):
        return Expr(self.col < column(other))

    def __le__(self, other):
        return Expr(self.col <= column(other))

    def __gt__(self, other):
        return Expr(self.col > column(other))

    def __ge__(self, other):
        return Expr(self.col >= column(other))

    # Logic: a null predicate is false

    def __and__(self, other):
        return Expr(self.col & column(other))

    def __or__(self, other):
        return Expr(self.col | column(other))

    def __rand__(self, other):
        return Expr(column(other) & self.col)

    def __ror__(self, other):
        return Expr(column(other) | self.col)

    def __invert__(self):
        return Expr(~F.coalesce(self.col, F.lit(False)))

    # Arithmetic

    def __add__(self, other):
        return Expr(self.col + column(other))

    def __radd__(self, other):
        return Expr(column(other) + self.col)

    def __sub__(self, other):
        return Expr(self.col - column(other))

    def __rsub__(self, other):
        return Expr(column(other) - self.col)

    def __mul__(self, other):
        return Expr(self.col * column(other))

    def __rmul__(self, other):
        return Expr(column(other) * self.col)

    def __truediv__(self, other):
        return Expr(self.col / column(other))

    def __rtruediv__(self, other):
        return Expr(column(other) / self.col)

    def __floordiv__(self, other):
        """Division of integers, toward zero; an error for a zero divisor."""
        return int_div(self, other)

    def __mod__(self, other):
        return Expr(self.col % column(other))

    def __pow__(self, other):
        return Expr(F.pow(self.col, column(other)))

    def __neg__(self):
        return Expr(-self.col)

    # Bits

    def bit_and(self, other):
        return Expr(self.col.bitwiseAND(column(other)))

    def bit_or(self, other):
        return Expr(self.col.bitwiseOR(column(other)))

    def bit_xor(self, other):
        return Expr(self.col.bitwiseXOR(column(other)))

    def bit_not(self):
        return Expr(F.bitwise_not(self.col))

    def shift_left(self, n: int):
        return Expr(F.shiftleft(self.col, n))

    def shift_right(self, n: int):
        return Expr(F.shiftright(self.col, n))

    # Nulls, types, membership

    def is_null(self):
        return Expr(self.col.isNull())

    def has_value(self):
        return Expr(self.col.isNotNull())

    def value_or(self, default):
        return Expr(F.coalesce(self.col, column(default)))

    def cast(self, kind: str):
        return Expr(self.col.cast(kind))

    def try_cast(self, kind: str):
        return Expr(self.col.try_cast(kind))

    def isin(self, items: Iterable | None):
        """Membership in a list: null matches a null in the list; no list, or an empty one, matches nothing."""
        items = list(items or [])
        known = [i for i in items if i is not None]
        found = self.col.isin(*known) if known else F.lit(False)
        if len(known) < len(items):
            found = F.coalesce(found, F.lit(False)) | self.col.isNull()
        return Expr(found)

    # Strings: patterns are literal unless a method says otherwise

    def contains(self, other):
        return Expr(self.col.contains(column(other)))

    def startswith(self, other):
        return Expr(self.col.startswith(column(other)))

    def endswith(self, other):
        return Expr(self.col.endswith(column(other)))

    def equals_ignore_case(self, other):
        return Expr(F.lower(self.col) == F.lower(column(other)))

    def length(self):
        return Expr(F.char_length(self.col))

    def upper(self):
        return Expr(F.upper(self.col))

    def lower(self):
        return Expr(F.lower(self.col))

    def trim(self):
        return Expr(F.btrim(self.col))

    def trim_start(self):
        return Expr(F.ltrim(self.col))

    def trim_end(self):
        return Expr(F.rtrim(self.col))

    def substring(self, start, size=None):
        """From a zero-based place on."""
        rest = F.char_length(self.col) if size is None else column(size)
        return Expr(F.substring(self.col, column(start) + 1, rest))

    def index_of(self, other):
        """Zero-based place, -1 if absent."""
        return Expr(F.instr(self.col, column(other)) - 1)

    def replace(self, old, new):
        return Expr(F.replace(self.col, column(old), column(new)))

    def concat(self, *others):
        return Expr(F.concat(self.col, *(column(o) for o in others)))

    def is_null_or_empty(self):
        return Expr(self.col.isNull() | (self.col == ""))

    def like(self, pattern: str, escape: str | None = None):
        return Expr(F.like(self.col, F.lit(pattern), F.lit(escape)) if escape else self.col.like(pattern))

    def regex(self, pattern: str):
        return Expr(self.col.rlike(pattern))

    def bytes(self, charset: str = "UTF-8"):
        return Expr(F.encode(self.col, charset))

    def octets(self):
        return Expr(F.octet_length(self.col))

    def split(self, separator: str):
        return Array(F.split(self.col, separator))

    # Dates and times

    def part(self, name: str):
        return Expr(F.date_part(F.lit(name), self.col).cast("int"))

    def truncate(self, unit: str):
        return Expr(F.date_trunc(unit, self.col).cast("timestamp_ntz"))

    def add(self, unit: str, n):
        return Expr(F.timestamp_add(unit, column(n), self.col))

    def until(self, unit: str, other):
        """Whole units from here to another time."""
        return Expr(F.timestamp_diff(unit, self.col, column(other)))

    def date(self):
        return Expr(self.col.cast("date"))

    # Maths

    def abs(self):
        return Expr(F.abs(self.col))

    def ceiling(self):
        return Expr(F.ceil(self.col))

    def floor(self):
        return Expr(F.floor(self.col))

    def round(self, digits: int = 0):
        """Half away from zero; round_even for half to even."""
        return Expr(F.round(self.col, digits))

    def round_even(self, digits: int = 0):
        return Expr(F.bround(self.col, digits))

    def sqrt(self):
        return Expr(F.sqrt(self.col))

    def exp(self):
        return Expr(F.exp(self.col))

    def log(self):
        return Expr(F.ln(self.col))

    def log10(self):
        return Expr(F.log10(self.col))

    def sin(self):
        return Expr(F.sin(self.col))

    def cos(self):
        return Expr(F.cos(self.col))

    def sign(self):
        return Expr(F.signum(self.col))

    # Documents

    def json(self, path: str, kind: str = "string"):
        """A value of a JSON text; null if the path is absent or the value has another type."""
        return Expr(F.try_variant_get(F.try_parse_json(self.col), path, kind))

    def from_json(self, schema: str):
        return Fields.of_struct(F.from_json(self.col, schema), schema) if not schema.startswith("array") else Array(F.from_json(self.col, schema))

    def as_array(self):
        return Array(self.col)

    def as_map(self):
        return Map(self.col)


class Array(Expr):
    """An array column: primitive collections and owned collections."""

    def count(self, where: Callable | None = None):
        found = self.col if where is None else F.filter(self.col, lambda x: column(where(_element(x))))
        return Expr(F.coalesce(F.size(found), F.lit(0)))

    def contains(self, item):
        return Expr(F.coalesce(F.array_contains(self.col, column(item)), F.lit(False)))

    def any(self, where: Callable):
        return Expr(F.coalesce(F.exists(self.col, lambda x: column(where(_element(x)))), F.lit(False)))

    def all(self, where: Callable):
        return Expr(F.coalesce(F.forall(self.col, lambda x: F.coalesce(column(where(_element(x))), F.lit(False))), F.lit(True)))

    def where(self, where: Callable):
        return Array(F.filter(self.col, lambda x: column(where(_element(x)))))

    def select(self, fn: Callable):
        return Array(F.transform(self.col, lambda x: column(fn(_element(x)))))

    def order(self):
        return Array(F.array_sort(self.col))

    def order_desc(self):
        return Array(F.sort_array(self.col, asc=False))

    def skip(self, n: int):
        return Array(F.slice(self.col, F.lit(n + 1), F.greatest(F.size(self.col) - n, F.lit(0))))

    def take(self, n: int):
        return Array(F.slice(self.col, F.lit(1), F.lit(n)))

    def distinct(self):
        return Array(F.array_distinct(self.col))

    def union(self, other):
        return Array(F.array_union(self.col, column(other)))

    def concat(self, other):
        return Array(F.concat(self.col, column(other)))

    def intersect(self, other):
        return Array(F.array_intersect(self.col, column(other)))

    def except_(self, other):
        return Array(F.array_except(self.col, column(other)))

    def sum(self, kind: str = "double"):
        return Expr(F.aggregate(self.col, F.lit(0).cast(kind), lambda a, x: a + x.cast(kind)))

    def __getitem__(self, index):
        """Zero-based; null outside."""
        return Expr(F.get(self.col, column(index)))

    def length(self):
        return Expr(F.size(self.col))

    def element_at_or_default(self, index):
        return self[index]


def _element(x: Column):
    return Element(x)


class Element(Expr):
    """An element of an array of structs or scalars: fields by attribute."""

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return Element(self.col[name])


class Map(Expr):
    def __getitem__(self, key):
        return Expr(F.try_element_at(self.col, column(key)))

    def keys(self):
        return Array(F.map_keys(self.col))

    def contains_key(self, key):
        return Expr(F.map_contains_key(self.col, column(key)))


class Fields:
    """A named record: what an anonymous type, a tuple or a row constructor gives."""

    def __init__(self, **fields):
        self.__dict__["fields"] = fields

    @classmethod
    def of_struct(cls, col: Column, schema: str) -> Fields:
        from pyspark.sql.types import _parse_datatype_string

        return cls(**{f.name: Expr(col[f.name]) for f in _parse_datatype_string(schema)})

    def __getattr__(self, name: str):
        try:
            return self.__dict__["fields"][name]
        except KeyError:
            raise TranslationError(f"the record has no field {name!r}") from None

    def struct(self) -> Column:
        return F.struct(*(column(v).alias(k) for k, v in self.fields.items()))

    def __eq__(self, other):
        """Field by field, null-safe; only records with the same fields compare."""
        if not isinstance(other, Fields) or list(other.fields) != list(self.fields):
            raise TranslationError("records of different types can't be compared")
        found = F.lit(True)
        for k, v in self.fields.items():
            found = found & column(v).eqNullSafe(column(other.fields[k]))
        return Expr(found)

    def __ne__(self, other):
        return ~(self == other)

    __hash__ = None


def record(**fields) -> Fields:
    return Fields(**fields)


def cond(test, then, otherwise) -> Expr:
    return Expr(F.when(column(test), column(then)).otherwise(column(otherwise)))


def coalesce(*items) -> Expr:
    return Expr(F.coalesce(*(column(i) for i in items)))


def least(*items) -> Expr:
    return Expr(F.least(*(column(i) for i in items)))


def greatest(*items) -> Expr:
    return Expr(F.greatest(*(column(i) for i in items)))


def constant(value) -> Expr:
    return Expr(column(value))


def array(*items) -> Array:
    return Array(F.array(*(column(i) for i in items)))


def map_of(key, value) -> Map:
    return Map(F.create_map(column(key), column(value)))


def make_date(year, month, day) -> Expr:
    return Expr(F.make_date(column(year), column(month), column(day)))


#: The forms of an identifier's text: bare digits, with hyphens, and these in braces or parentheses.
_HYPHENS = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
_GUID = rf"^(?:[0-9a-f]{{32}}|{_HYPHENS}|\{{{_HYPHENS}\}}|\({_HYPHENS}\))$"


def guid(text) -> Expr:
    """An identifier from its text, in the form with hyphens, which compares by value; null where the text is none."""
    lower = F.lower(F.trim(column(text)))
    digits = F.regexp_replace(lower, "[^0-9a-f]", "")
    parts = [F.substring(digits, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return Expr(F.when(lower.rlike(_GUID), F.concat_ws("-", *parts)))


def new_guid() -> Expr:
    """A random identifier; for projections only."""
    return Expr(F.uuid())


def int_div(a, b) -> Expr:
    """Integer division toward zero; an error for a zero divisor."""
    a, b = column(a), column(b)
    return Expr((a - a % b) / b).cast("long")

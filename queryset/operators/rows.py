"""What row lambdas see: entities with navigations, records, scalars and related rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType

from queryset.errors import TranslationError
from queryset.functions.expr import Array, Expr, Fields, Map, column
from queryset.sources.model import Collection, EntityType, Reference, Skip

_numbers = count()


def fresh(name: str) -> str:
    """A column name that no other column has; every plan keeps its columns apart by it."""
    return f"q{next(_numbers)}__{name}"


@dataclass(frozen=True)
class Scalar:
    name: str


@dataclass(frozen=True)
class Entity:
    """Columns of an entity under a prefix; ``optional`` rows may be absent (outer joins)."""

    type: EntityType
    prefix: str
    columns: tuple[str, ...]
    optional: bool = False


@dataclass(frozen=True)
class Record:
    fields: tuple[tuple[str, object], ...]


def entity_frame(df: DataFrame, kind: EntityType) -> tuple[DataFrame, Entity]:
    prefix = fresh("")
    return df.select(*(F.col(f"`{c}`").alias(prefix + c) for c in df.columns)), Entity(kind, prefix, tuple(df.columns))


class Scope:
    """The frame that a lambda's navigations join to; references are joined once.

    ``every_row``: references never lose or repeat a row, whatever keys dangle or repeat;
    for writes, which rewrite what the frame holds.
    """

    def __init__(self, context, df: DataFrame, joined: dict | None = None, every_row: bool = False):
        self.context, self.df, self.joined, self.every_row = context, df, dict(joined or {}), every_row

    def bind(self, shape):
        if isinstance(shape, Entity):
            return EntityRow(self, shape)
        if isinstance(shape, Record):
            return Fields(**{k: self.bind(v) for k, v in shape.fields})
        return typed(self.df, shape.name)

    def follow(self, shape: Entity, name: str, nav: Reference) -> Entity:
        """The referenced entity, by an inner join where the key is required, else by a left one."""
        at = (shape.prefix, name)
        if at not in self.joined:
            target = self.context.set(nav.target)
            other = target.shape
            keys = target.shape.type.key
            on = [F.col(shape.prefix + a) == F.col(other.prefix + b) for a, b in zip(nav.columns, keys, strict=True)]
            inner = nav.required and not shape.optional and not other.type.filters and not self.every_row
            rows = target.df.dropDuplicates([other.prefix + k for k in keys]) if self.every_row else target.df
            self.df = self.df.join(rows, on, "inner" if inner else "left")
            self.joined[at] = Entity(other.type, other.prefix, other.columns, not inner)
        return self.joined[at]

    def lookup(self, shape: Entity, keys: tuple[str, ...], found: DataFrame, names: list[str]) -> None:
        """Left join to one row by key; ``names`` are the key columns of ``found``."""
        on = [F.col(shape.prefix + a) == F.col(b) for a, b in zip(keys, names, strict=True)]
        self.df = self.df.join(found, on, "left")


def typed(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    return Array(F.col(name)) if isinstance(kind, ArrayType) else Map(F.col(name)) if isinstance(kind, MapType) else Expr(F.col(name))


class EntityRow:
    """A row of an entity type: columns and navigations by attribute."""

    __hash__ = None

    def __init__(self, scope: Scope, shape: Entity):
        self._scope, self._shape = scope, shape

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        kind = self._shape.type
        if name in kind.navigations:
            nav = kind.navigations[name]
            if isinstance(nav, Reference):
                return EntityRow(self._scope, self._scope.follow(self._shape, name, nav))
            return Related(self._scope, self._shape, nav)
        if name in kind.hidden:
            raise TranslationError(f"{kind.name}.{name} is read by name only: use prop()")
        return self._prop(name)

    def _prop(self, name: str):
        if name not in self._shape.columns:
            raise TranslationError(f"{self._shape.type.name} has no member {name!r}")
        return typed(self._scope.df, self._shape.prefix + name)

    def _key(self) -> list[Column]:
        if not self._shape.type.key:
            raise TranslationError(f"{self._shape.type.name} has no key to compare by")
        return [F.col(self._shape.prefix + k) for k in self._shape.type.key]

    def __eq__(self, other):
        """By key: with another row of the type, a key value (tuple for several columns), or None for absence."""
        own = self._key()
        if other is None:
            return Expr(own[0].isNull())
        if isinstance(other, EntityRow):
            if other._shape.type.name != self._shape.type.name:
                raise TranslationError(f"{self._shape.type.name} can't be compared with {other._shape.type.name}")
            values = other._key()
        else:
            values = [column(v) for v in (other if isinstance(other, tuple) else (other,))]
        found = F.lit(True)
        for a, b in zip(own, values, strict=True):
            found = found & a.eqNullSafe(b)
        return Expr(found)

    def __ne__(self, other):
        return ~(self == other)

    def isin(self, keys: list):
        """In a list of keys of one column; absent entries (None) match nothing."""
        (own,) = self._key()
        return Expr(own).isin([k for k in keys if k is not None])

    def to_column(self) -> Column:
        found = F.struct(*(F.col(self._shape.prefix + c).alias(c) for c in self._shape.columns))
        return F.when(self._key()[0].isNotNull(), found) if self._shape.optional else found


def prop(row: EntityRow, name: str):
    """A column by its name, hidden ones too."""
    return row._prop(name)


def type_is(row: EntityRow, name: str) -> Expr:
    """Whether a row is of a derived type."""
    kind = row._scope.context.model[name]
    if kind.name == row._shape.type.name:
        return Expr(F.lit(True))
    if kind.base != row._shape.type.name or not kind.discriminator:
        raise TranslationError(f"{name} is not derived from {row._shape.type.name}")
    where, value = kind.discriminator
    return Expr(F.col(row._shape.prefix + where) == value)


class Related:
    """The rows of a collection navigation. Its operators are combined by foreign key and joined once to the outer row, never run by row."""

    def __init__(self, scope: Scope, shape: Entity, nav: Collection | Skip, query=None, order=None, limit: int | None = None, offset: int = 0):
        self._scope, self._shape, self._nav = scope, shape, nav
        self._order, self._limit, self._offset = list(order or []), limit, offset
        self._query = query or self._root()

    def _root(self):
        """Target rows with the columns ``_fk`` that hold the outer key."""
        target = self._scope.context.set(self._nav.target)
        if isinstance(self._nav, Collection):
            self._fk = [target.shape.prefix + c for c in self._nav.columns]
            return target
        link = self._scope.context.set(self._nav.link)
        pairs = link.df.select(*(F.col(link.shape.prefix + c) for c in self._nav.own + self._nav.other)).distinct()
        on = [F.col(link.shape.prefix + a) == F.col(target.shape.prefix + b) for a, b in zip(self._nav.other, target.shape.type.key, strict=True)]
        self._fk = [link.shape.prefix + c for c in self._nav.own]
        return target.with_frame(pairs.join(target.df, on))

    def _with(self, query=None, **changes):
        kept = {"order": self._order, "limit": self._limit, "offset": self._offset} | changes
        out = Related(self._scope, self._shape, self._nav, query or self._query, **kept)
        out._fk = self._fk
        return out

    def where(self, fn: Callable):
        if self._limit is not None:
            raise TranslationError("filter related rows before paging them")
        return self._with(self._query.where(fn))

    def order_by(self, fn: Callable, desc: bool = False):
        scope = Scope(self._scope.context, self._query.df, self._query.joined)
        name = fresh("order")
        value = column(fn(scope.bind(self._query.shape)))
        query = self._query.with_frame(scope.df.withColumn(name, value), scope.joined)
        return self._with(query, order=[*self._order, F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_first()])

    def skip(self, n: int):
        return self._with(offset=self._offset + n)

    def take(self, n: int):
        return self._with(limit=n)

    def rows(self):
        """The related rows as a query, paged by foreign key."""
        if self._limit is None and not self._offset:
            return self._query
        if not self._order:
            raise TranslationError("paging needs an order")
        key = [F.col(self._query.shape.prefix + k) for k in self._query.shape.type.key]
        at = fresh("row")
        ranked = self._query.df.withColumn(at, F.row_number().over(Window.partitionBy(*self._fk).orderBy(*self._order, *key)))
        upto = (F.col(at) > self._offset) & (F.lit(True) if self._limit is None else F.col(at) <= self._offset + self._limit)
        return self._query.with_frame(ranked.where(upto))

    def _fold(self, make: Callable) -> Column:
        query = self.rows()
        scope = Scope(self._scope.context, query.df, query.joined)
        value, names = fresh("fold"), [fresh("fk") for _ in self._fk]
        folded = make(scope.bind(query.shape))
        found = scope.df.groupBy(*(F.col(f).alias(n) for f, n in zip(self._fk, names))).agg(folded.alias(value))
        self._scope.lookup(self._shape, self._shape.type.key, found, names)
        return F.col(value)

    def count(self, where: Callable | None = None) -> Expr:
        return Expr(F.coalesce((self.where(where) if where else self)._fold(lambda _: F.count(F.lit(1))), F.lit(0)))

    def sum(self, fn: Callable) -> Expr:
        return Expr(F.coalesce(self._fold(lambda row: F.sum(column(fn(row)))), F.lit(0)))

    def average(self, fn: Callable) -> Expr:
        return Expr(self._fold(lambda row: F.avg(column(fn(row)))))

    def min(self, fn: Callable) -> Expr:
        return Expr(self._fold(lambda row: F.min(column(fn(row)))))

    def max(self, fn: Callable) -> Expr:
        return Expr(self._fold(lambda row: F.max(column(fn(row)))))

    def any(self, where: Callable | None = None) -> Expr:
        return self.count(where) > 0

    def all(self, where: Callable) -> Expr:
        return ~self.any(lambda row: ~Expr(column(where(row))))

    def to_list(self, fn: Callable | None = None) -> Array:
        """Related rows as a sorted array of structs (of scalars, where ``fn`` gives one); empty where there are none."""
        found = self._fold(lambda row: F.sort_array(F.collect_list(F.struct(column(fn(row) if fn else row).alias("x")))))
        items = F.transform(found, lambda s: s["x"])
        return Array(F.coalesce(items, F.array().cast(self._array_type(fn))))

    def _array_type(self, fn) -> str:
        query = self.rows()
        scope = Scope(self._scope.context, query.df, query.joined)
        value = column(fn(scope.bind(query.shape)) if fn else scope.bind(query.shape))
        return f"array<{scope.df.select(value.alias('x')).schema['x'].dataType.simpleString()}>"

    def first_or_default(self, fn: Callable) -> Expr:
        """A value of the first related row in order; null where there is none."""
        if not self._order:
            raise TranslationError("first_or_default needs an order")
        return Expr(self._with(limit=1)._fold(lambda row: F.first(column(fn(row)))))

"""Query: operators that compose into one Spark plan."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType

from queryset.errors import CardinalityError, TranslationError
from queryset.functions.expr import Expr, Fields, column
from queryset.operators.rows import Entity, EntityRow, Record, Related, Scalar, Scope, entity_frame, fresh, type_is
from queryset.sources.model import EntityType, Reference


#: Sequence operators that are refused.
POSITIONAL = ("skip_while", "take_while", "skip_last", "take_last", "chunk", "append", "prepend", "aggregate", "sequence_equal")


#: Rows of a block of join_below: few, so that a cycle of them is much shorter than the 64 KB in which codecs look back.
BLOCK_BITS = 8


def root(context, kind: EntityType, ignore_filters: bool | list[str] = False) -> Query:
    """All rows of an entity set, with its filters and, for a derived type, its discriminator."""
    if kind.defining is not None:
        frame = kind.defining(context).to_df()
    else:
        frame = context.table(kind.table)
    df, shape = entity_frame(frame, kind)
    query = Query(context, df, shape)
    if kind.base:
        query = query.where(lambda row: Expr(F.col(shape.prefix + kind.discriminator[0]) == kind.discriminator[1]))
    for name, test in kind.filters.items():
        if ignore_filters is True or (ignore_filters and name in ignore_filters):
            continue
        query = query.where(test)
    return query


def _blocks(df: DataFrame, key: str, block: str) -> DataFrame:
    """Rows with a key, in sorted arrays of neighbouring keys (the key first); a repeated key takes as many as it needs.

    Dealt over so many partitions that the pairs of two sides keep all cores busy. The order is total, so a task that is run again numbers the rows as before.
    """
    parts = math.ceil(4 * math.sqrt(df.sparkSession.sparkContext.defaultParallelism))
    tie, number = fresh("tie"), fresh("number")
    ranged = df.where(F.col(key).isNotNull()).withColumn(tie, F.xxhash64("*")).repartitionByRange(parts, key, tie).sortWithinPartitions(key, tie)
    numbered = ranged.withColumn(number, F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS))
    row = F.struct(key, *(c for c in df.columns if c != key))
    return numbered.groupBy(number).agg(F.sort_array(F.collect_list(row)).alias(block)).select(block).repartition(parts)


class Query:
    """A frame and the shape of its rows. ``order`` and the page (rows to skip and to take) are pending until something needs them."""

    def __init__(self, context, df: DataFrame, shape, order: list[tuple[Column, bool]] | None = None, joined: dict | None = None, includes: dict | None = None, page: tuple[int, int | None] = (0, None)):
        self.context, self.all_rows, self.shape, self.order, self.joined, self.includes, self.page = context, df, shape, order or [], joined or {}, includes or {}, page
        self._paged: DataFrame | None = None

    @property
    def df(self) -> DataFrame:
        """The rows, of the page only. Order, offset and limit come as one, so Spark keeps the first rows of each partition and no more."""
        if self._paged is None:
            offset, limit = self.page
            rows = self.all_rows
            if self.page != (0, None):
                rows = rows.orderBy(*_directed(self.order)) if self.order else rows
                rows = rows.offset(offset) if offset else rows
                rows = rows.limit(limit) if limit is not None else rows
            self._paged = rows
        return self._paged

    def _page(self, skip: int, take: int | None) -> Query:
        offset, limit = self.page
        if limit is not None:
            skip = min(skip, limit)
            limit -= skip
        limit = take if limit is None else limit if take is None else min(limit, take)
        return Query(self.context, self.all_rows, self.shape, self.order, self.joined, self.includes, (offset + skip, limit))

    @classmethod
    def of_scalar(cls, context, df: DataFrame) -> Query:
        name = fresh("value")
        return cls(context, df.select(F.col(df.columns[0]).alias(name)), Scalar(name))

    def with_frame(self, df: DataFrame, joined: dict | None = None) -> Query:
        return Query(self.context, df, self.shape, self.order, joined or self.joined, self.includes)

    def _scope(self) -> Scope:
        return Scope(self.context, self.df, self.joined)

    # Filters

    def where(self, fn: Callable) -> Query:
        scope = self._scope()
        test = column(fn(scope.bind(self.shape)))
        return self.with_frame(scope.df.where(test), scope.joined)

    def of_type(self, name: str) -> Query:
        kind = self.context.model[name]
        query = self.where(lambda row: type_is(row, name))
        shape = Entity(kind, self.shape.prefix, self.shape.columns, self.shape.optional)
        return Query(self.context, query.df, shape, self.order, query.joined)

    def where_exists(self, other: Query, on: Callable) -> Query:
        """Rows with a match in another query; ``on`` gives pairs of equal keys."""
        return self._semi(other, on, "left_semi")

    def where_not_exists(self, other: Query, on: Callable) -> Query:
        return self._semi(other, on, "left_anti")

    def _semi(self, other: Query, on: Callable, how: str) -> Query:
        mine, theirs = self._scope(), other._scope()
        test = column(on(mine.bind(self.shape), theirs.bind(other.shape)))
        return self.with_frame(mine.df.join(theirs.df, test, how), mine.joined)

    # Projection

    def select(self, fn: Callable) -> Query:
        """A scalar, a record of scalars, records and entities, or an entity. One plan, whatever the navigations."""
        scope = self._scope()
        value = fn(scope.bind(self.shape))
        columns: list[Column] = []
        shape = _shape(value, columns, "value")
        return Query(self.context, self._sorted(scope.df).select(*columns), shape)

    def let(self, **values: Callable) -> Query:
        """The row and named values computed from it, as a record of ``row`` and the names."""
        return self.select(lambda row: Fields(row=row, **{k: fn(row) for k, fn in values.items()}))

    def select_many(self, collection: Callable, result: Callable | None = None, outer: bool = False) -> Query:
        """Each row with each of its related rows or array elements; ``outer`` keeps rows without any."""
        scope = self._scope()
        row = scope.bind(self.shape)
        found = collection(row)
        result = result or (lambda _, x: x)
        if isinstance(found, Related):
            inner = found.rows()
            on = [F.col(found._shape.prefix + a) == F.col(b) for a, b in zip(found._shape.type.key, found._fk, strict=True)]
            both = Scope(self.context, scope.df.join(inner.df, on, "left" if outer else "inner"), {**scope.joined, **inner.joined})
            other = both.bind(_optional(inner.shape) if outer else inner.shape)
        else:
            name = fresh("item")
            make = F.explode_outer if outer else F.explode
            both = Scope(self.context, scope.df.withColumn(name, make(column(found))), scope.joined)
            other = both.bind(Scalar(name))
        return Query(self.context, both.df, None)._project(both, result(both.bind(self.shape), other))

    def _project(self, scope: Scope, value) -> Query:
        columns: list[Column] = []
        shape = _shape(value, columns, "value")
        return Query(self.context, scope.df.select(*columns), shape)

    def _fragments(self, fragments: tuple[Callable, ...]) -> DataFrame:
        return self.select(lambda row: Fields(**{f"_{k}": f(row) for k, f in enumerate(fragments)})).to_df()

    def select_client(self, fn: Callable, *fragments: Callable) -> list:
        """Client code in the final projection, over a result that fits the driver: ``fragments`` run in Spark, ``fn`` on their values as rows arrive."""
        return [fn(*row) for row in self._fragments(fragments).toLocalIterator()]

    def select_client_rows(self, schema: str, fn: Callable, *fragments: Callable) -> DataFrame:
        """The same where the rows are: ``fn`` runs in the tasks, on Arrow batches, and gives a tuple of ``schema`` by row."""
        sent = self._fragments(fragments)
        return sent.select(F.udf(fn, schema, useArrow=True)(*sent.columns).alias("row")).select("row.*")

    # Joins

    def join(self, other: Query, outer_key: Callable, inner_key: Callable, result: Callable | None = None, how: str = "inner") -> Query:
        """Equal keys (records field by field); nulls never match. ``how``: inner, left, right."""
        mine, theirs = self._scope(), other._scope()
        a, b = outer_key(mine.bind(self.shape)), inner_key(theirs.bind(other.shape))
        pairs = list(zip(_parts(a), _parts(b), strict=True))
        test = pairs[0][0] == pairs[0][1]
        for x, y in pairs[1:]:
            test = test & (x == y)
        return self._joined(mine, theirs, other, test, how, result)

    def left_join(self, other: Query, outer_key: Callable, inner_key: Callable, result: Callable | None = None) -> Query:
        return self.join(other, outer_key, inner_key, result, "left")

    def right_join(self, other: Query, outer_key: Callable, inner_key: Callable, result: Callable | None = None) -> Query:
        return self.join(other, outer_key, inner_key, result, "right")

    def cross_join(self, other: Query, result: Callable | None = None, where: Callable | None = None) -> Query:
        """All pairs, or those that a condition over both rows admits: for small sides only, as the reader asks for it.

        Both sides are dealt over all cores, as small files are one partition but their pairs are many.
        """
        mine, theirs = self._scope(), other._scope()
        test = column(where(mine.bind(self.shape), theirs.bind(other.shape))) if where else None
        tasks = 2 * self.context.spark.sparkContext.defaultParallelism
        left, right = mine.df.repartition(tasks), theirs.df.repartition(tasks)
        joined = left.crossJoin(right) if test is None else left.join(right, test)
        return self._after(joined, mine, theirs, other, "inner", result)

    def join_below(self, other: Query, outer_key: Callable, inner_key: Callable, result: Callable | None = None) -> Query:
        """Pairs whose outer key is below the inner one; rows with a null key have none. Columns must be sortable; select the needed ones before.

        The pairs grow with the square of the rows and all are made, so the room of each counts. Blocks of rows with
        neighbouring keys meet, so most pairs of blocks have all their pairs or none, and each outer row of a block gets
        the inner ones in the same order. In column files the outer columns are runs and the inner ones short cycles.
        """
        mine, theirs = self._scope(), other._scope()
        a, b, x, y = (fresh(n) for n in ("key", "key", "block", "block"))
        left = _blocks(mine.df.withColumn(a, column(outer_key(mine.bind(self.shape)))), a, x)
        right = _blocks(theirs.df.withColumn(b, column(inner_key(theirs.bind(other.shape)))), b, y)
        met = left.hint("shuffle_replicate_nl").join(right, F.element_at(x, 1)[a] < F.element_at(y, -1)[b])
        outer = met.select(F.inline(x), y)
        joined = outer.select(*(c for c in outer.columns if c != y), F.inline(y)).where(F.col(a) < F.col(b))
        return self._after(joined, mine, theirs, other, "inner", result)

    def _joined(self, mine: Scope, theirs: Scope, other: Query, test: Column, how: str, result: Callable | None) -> Query:
        return self._after(mine.df.join(theirs.df, test, how), mine, theirs, other, how, result)

    def _after(self, df: DataFrame, mine: Scope, theirs: Scope, other: Query, how: str, result: Callable | None) -> Query:
        both = Scope(self.context, df, {**mine.joined, **theirs.joined})
        a = both.bind(_optional(self.shape) if how == "right" else self.shape)
        b = both.bind(_optional(other.shape) if how == "left" else other.shape)
        return self._project(both, (result or (lambda x, y: Fields(outer=x, inner=y)))(a, b))

    def group_join(self, other: Query, outer_key: Callable, inner_key: Callable, element: Callable, result: Callable) -> Query:
        """Each row with the sorted list of its matches, empty where there are none."""
        theirs = other._scope()
        row = theirs.bind(other.shape)
        keys, value, name = _parts(inner_key(row)), column(element(row)), fresh("group")
        names = [fresh("key") for _ in keys]
        kind = theirs.df.select(value.alias("x")).schema["x"].dataType.simpleString()
        grouped = theirs.df.groupBy(*(k.alias(n) for k, n in zip(keys, names))).agg(F.sort_array(F.collect_list(F.struct(value.alias("x")))).alias(name))
        mine = self._scope()
        on = [a == F.col(n) for a, n in zip(_parts(outer_key(mine.bind(self.shape))), names, strict=True)]
        df = mine.df.join(grouped, on, "left")
        df = df.withColumn(name, F.coalesce(F.transform(name, lambda s: s["x"]), F.array().cast(f"array<{kind}>")))
        both = Scope(self.context, df, mine.joined)
        return self._project(both, result(both.bind(self.shape), both.bind(Scalar(name))))

    def zip(self, other: Query, result: Callable) -> Query:
        """The n-th row with the n-th of another query; both need an order. Numbers one global order: for short results."""
        if not self.order or not other.order:
            raise TranslationError("zip needs an order on both sides")
        a, b = fresh("n"), fresh("n")
        left, right = self._numbered(a), other._numbered(b)
        both = Scope(self.context, left.join(right, F.col(a) == F.col(b)))
        return self._project(both, result(both.bind(self.shape), both.bind(other.shape)))

    def _numbered(self, name: str) -> DataFrame:
        return self.df.withColumn(name, F.row_number().over(Window.orderBy(*_directed(self.order))))

    # Grouping

    def group_by(self, key: Callable, element: Callable | None = None) -> Grouping:
        return Grouping(self, key, element)

    # Scalars: a value in Python; as_row() variants give one-row queries

    def fold(self, **values: Callable) -> Query:
        """One row of aggregates over a group of all rows: ``fold(n=lambda g: g.count())``."""
        return Grouping(self, None, None).select(lambda g: Fields(**{k: fn(g) for k, fn in values.items()}))

    def _one(self, fn: Callable):
        return self.fold(x=fn).to_df().first()["x"]

    def count(self, where: Callable | None = None) -> int:
        return self._one(lambda g: g.count(where))

    def sum(self, fn: Callable):
        """0 over no rows."""
        return self._one(lambda g: g.sum(fn))

    def average(self, fn: Callable):
        return self._needed(self._one(lambda g: g.average(fn)), fn)

    def min(self, fn: Callable):
        return self._needed(self._one(lambda g: g.min(fn)), fn)

    def max(self, fn: Callable):
        return self._needed(self._one(lambda g: g.max(fn)), fn)

    def _needed(self, value, fn):
        if value is None and not self.any():
            raise CardinalityError("Sequence contains no elements")
        return value

    def any(self, where: Callable | None = None) -> bool:
        return bool((self.where(where) if where else self).df.limit(1).count())

    def all(self, where: Callable) -> bool:
        return not self.any(lambda row: ~Expr(column(where(row))))

    def contains(self, value) -> bool:
        return self.any(lambda row: row == value if not isinstance(row, Fields) else row == value)

    # Order and paging

    def order_by(self, fn: Callable, desc: bool = False) -> Query:
        return self._ordered([], fn, desc)

    def order_by_desc(self, fn: Callable) -> Query:
        return self._ordered([], fn, True)

    def then_by(self, fn: Callable, desc: bool = False) -> Query:
        if not self.order:
            raise TranslationError("then_by needs an order")
        return self._ordered(self.order, fn, desc)

    def _ordered(self, before: list, fn: Callable, desc: bool) -> Query:
        scope = self._scope()
        value = column(fn(scope.bind(self.shape)))
        out = self.with_frame(scope.df, scope.joined)
        out.order = [*before, (value, desc)]
        return out

    def reverse(self) -> Query:
        if not self.order:
            raise TranslationError("reverse needs an order")
        out = self.with_frame(self.df)
        out.order = [(c, not desc) for c, desc in self.order]
        return out

    def _sorted(self, df: DataFrame) -> DataFrame:
        sorted_already = self.page != (0, None) and df is self._paged
        return df.orderBy(*_directed(self.order)) if self.order and not sorted_already else df

    def skip(self, n: int) -> Query:
        return self._page(n, None)

    def take(self, n) -> Query:
        """The first n rows; n may be a query of one number, which is evaluated first."""
        if isinstance(n, Query):
            n = n.to_df().first()[0]
        return self._page(0, n)

    # Single rows

    def _rows(self, n: int) -> list:
        return self.take(n).to_df().collect()

    def first(self):
        found = self._rows(1)
        if not found:
            raise CardinalityError("Sequence contains no elements")
        return found[0]

    def first_or_default(self):
        """None where there is no row, never a row of zeros."""
        return next(iter(self._rows(1)), None)

    def single(self):
        found = self._rows(2)
        if len(found) != 1:
            raise CardinalityError("Sequence contains no elements" if not found else "Sequence contains more than one element")
        return found[0]

    def single_or_default(self):
        return self.single() if self._rows(1) else None

    def last(self):
        return self.reverse().first()

    def last_or_default(self):
        return self.reverse().first_or_default()

    def element_at(self, n: int):
        return self.skip(n).first()

    def element_at_or_default(self, n: int):
        return self.skip(n).first_or_default()

    def find(self, *key):
        return self.where(lambda row: row == key).first_or_default()

    # Sets

    def distinct(self) -> Query:
        self._refuse_collections()
        return Query(self.context, self.df.select(*_columns(self.shape)).distinct(), self.shape)

    def _refuse_collections(self) -> None:
        for name in _columns(self.shape):
            if isinstance(self.df.schema[name].dataType, (ArrayType, MapType)):
                raise TranslationError("rows that hold a collection have no distinct")

    def distinct_by(self, key: Callable) -> Query:
        """The first row of each key in the query's order, which must be total to be repeatable."""
        if not self.order:
            raise TranslationError("distinct_by needs an order")
        scope = self._scope()
        at = fresh("row")
        window = Window.partitionBy(*_parts(key(scope.bind(self.shape)))).orderBy(*_directed(self.order))
        return self.with_frame(scope.df.withColumn(at, F.row_number().over(window)).where(F.col(at) == 1), scope.joined)

    def _aligned(self, other: Query) -> tuple[DataFrame, DataFrame]:
        mine, theirs = _columns(self.shape), _columns(other.shape)
        if _outline(self.shape) != _outline(other.shape):
            raise TranslationError("set operations need rows of one type")
        return self.df.select(*mine), other.df.select(*(F.col(b).alias(a) for a, b in zip(mine, theirs, strict=True)))

    def _set(self, df: DataFrame) -> Query:
        return Query(self.context, df, self.shape)

    def union(self, other: Query) -> Query:
        a, b = self._aligned(other)
        return self._set(a.unionByName(b).distinct())

    def concat(self, other: Query) -> Query:
        a, b = self._aligned(other)
        return self._set(a.unionByName(b))

    def intersect(self, other: Query) -> Query:
        a, b = self._aligned(other)
        return self._set(a.intersect(b))

    def except_(self, other: Query) -> Query:
        a, b = self._aligned(other)
        return self._set(a.subtract(b))

    def union_by(self, other: Query, key: Callable, order: Callable) -> Query:
        """First of each key, rows of this query before those of the other; ``order`` breaks ties within one."""
        a, b = self._aligned(other)
        side = fresh("side")
        both = Query(self.context, a.withColumn(side, F.lit(0)).unionByName(b.withColumn(side, F.lit(1))), self.shape)
        return both._ordered([(F.col(side), False)], order, False).distinct_by(key)

    def intersect_by(self, keys: Query, key: Callable, order: Callable) -> Query:
        """First row of each key that is among ``keys``, a query of scalars."""
        return self.order_by(order).distinct_by(key).where_exists(keys, lambda row, k: Expr(column(key(row)).eqNullSafe(column(k))))

    def except_by(self, keys: Query, key: Callable, order: Callable) -> Query:
        return self.order_by(order).distinct_by(key).where_not_exists(keys, lambda row, k: Expr(column(key(row)).eqNullSafe(column(k))))

    # Related data

    def include(self, path: str, where: Callable | None = None, order_by: Callable | None = None, desc: bool = False, take: int | None = None) -> Query:
        """Related entities nested into the rows along a path of navigations; options hold for its last step."""
        steps, kind = path.split("."), self.shape.type
        for step in steps:
            if step not in kind.navigations:
                raise TranslationError(f"{kind.name} has no navigation {step!r}")
            kind = self.context.model[kind.navigations[step].target]
        out = self.with_frame(self.df)
        out.includes = _with_path(self.includes, steps, {"where": where, "order_by": order_by, "desc": desc, "take": take})
        return out

    def ignore_auto_includes(self) -> Query:
        out = self.with_frame(self.df)
        out.includes = {**self.includes, "": {}}
        return out

    def as_no_tracking(self) -> Query:
        """A hint about the client's objects; the plan is the same."""
        return self

    as_tracking = as_split_query = as_single_query = as_no_tracking

    def tag_with(self, text: str) -> Query:
        self.context.spark.sparkContext.setJobDescription(text)
        return self

    # Operators without a set-oriented meaning

    def __getattr__(self, name: str):
        if name in POSITIONAL:
            raise TranslationError(f"{name} has no meaning over a set of rows; page an ordered query, or use Python on its results")
        raise AttributeError(name)

    # Results

    def to_df(self) -> DataFrame:
        """Columns by the shape: an entity's columns, a record's fields, or ``value``."""
        query = self._included()
        return query._sorted(query.df).select(*query._output())

    def _output(self) -> list[Column]:
        if isinstance(self.shape, Entity):
            extra = [c for c in self.df.columns if c.startswith(self.shape.prefix + "@")]
            return [F.col(self.shape.prefix + c).alias(c) for c in self.shape.columns if c not in self.shape.type.hidden] + [F.col(c).alias(c.split("@", 1)[1]) for c in extra]
        if isinstance(self.shape, Record):
            return [_value(s).alias(k) for k, s in self.shape.fields]
        return [F.col(self.shape.name).alias("value")]

    def _included(self) -> Query:
        wanted = dict(self.includes)
        if wanted.pop("", None) is None and isinstance(self.shape, Entity):
            for path in self.shape.type.auto_includes:
                wanted = _with_path(wanted, path.split("."), {})
        if not wanted:
            return self
        if not isinstance(self.shape, Entity):
            raise TranslationError("include needs rows of an entity type")
        df = self.df
        for name, (options, below) in wanted.items():
            df = _nest(self.context, df, self.shape, name, options, below)
        return Query(self.context, df, self.shape, self.order)

    def to_list(self) -> list:
        """All rows in Python; for results that are meant to be small."""
        return self.to_df().collect()

    def to_dict(self, key: str) -> dict:
        return {row[key]: row for row in self.to_df().toLocalIterator()}


def _directed(order: list[tuple[Column, bool]]) -> list[Column]:
    """Nulls come first, and last in descending order."""
    return [c.desc_nulls_last() if desc else c.asc_nulls_first() for c, desc in order]


def _parts(key) -> list[Column]:
    if isinstance(key, Fields):
        return [c for v in key.fields.values() for c in _parts(v)]
    if isinstance(key, EntityRow):
        return key._key()
    if not isinstance(key, (Expr, Column, int, float, str)):
        raise TranslationError(f"{type(key).__name__} has no equality to join or group by")
    return [column(key)]


def _shape(value, columns: list[Column], name: str):
    """The shape of a lambda's result; appends the columns that it needs."""
    if isinstance(value, EntityRow):
        shape = value._shape
        prefix = fresh("")
        columns += [F.col(shape.prefix + c).alias(prefix + c) for c in shape.columns]
        return Entity(shape.type, prefix, shape.columns, shape.optional)
    if isinstance(value, Fields):
        return Record(tuple((k, _shape(v, columns, k)) for k, v in value.fields.items()))
    if isinstance(value, (Query, Related)):
        raise TranslationError("Collections in the final projection must be turned into lists: use to_list()")
    at = fresh(name)
    columns.append(column(value).alias(at))
    return Scalar(at)


def _columns(shape) -> list[str]:
    if isinstance(shape, Entity):
        return [shape.prefix + c for c in shape.columns]
    if isinstance(shape, Record):
        return [c for _, s in shape.fields for c in _columns(s)]
    return [shape.name]


def _outline(shape):
    if isinstance(shape, Entity):
        return shape.type.base or shape.type.name
    if isinstance(shape, Record):
        return tuple((k, _outline(s)) for k, s in shape.fields)
    return "scalar"


def _optional(shape):
    if isinstance(shape, Entity):
        return Entity(shape.type, shape.prefix, shape.columns, True)
    if isinstance(shape, Record):
        return Record(tuple((k, _optional(s)) for k, s in shape.fields))
    return shape


def _value(shape) -> Column:
    if isinstance(shape, Scalar):
        return F.col(shape.name)
    if isinstance(shape, Record):
        return F.struct(*(_value(s).alias(k) for k, s in shape.fields))
    found = F.struct(*(F.col(shape.prefix + c).alias(c) for c in shape.columns if c not in shape.type.hidden))
    return F.when(F.col(shape.prefix + shape.type.key[0]).isNotNull(), found) if shape.optional and shape.type.key else found


def _with_path(tree: dict, steps: list[str], options: dict) -> dict:
    old, below = tree.get(steps[0], ({}, {}))
    if len(steps) == 1:
        return {**tree, steps[0]: ({**old, **options}, below)}
    return {**tree, steps[0]: (old, _with_path(below, steps[1:], options))}


def _nest(context, df: DataFrame, shape: Entity, name: str, options: dict, below: dict) -> DataFrame:
    """One more column: the related row as a struct, or related rows as a sorted array. Each is made before its join, so several do not multiply."""
    nav, at = shape.type.navigations[name], shape.prefix + "@" + name
    if isinstance(nav, Reference):
        target = context.set(nav.target)
        keys, fk = [target.shape.prefix + k for k in target.shape.type.key], [shape.prefix + c for c in nav.columns]
    else:
        related = Related(Scope(context, df), shape, nav)
        if options.get("where"):
            related = related.where(options["where"])
        if options.get("order_by"):
            related = related.order_by(options["order_by"], options.get("desc", False))
        if options.get("take") is not None:
            related = related.take(options["take"])
        target = related.rows()
        keys, fk = related._fk, [shape.prefix + k for k in shape.type.key]
    found = target.df
    for inner, (inner_options, inner_below) in below.items():
        found = _nest(context, found, target.shape, inner, inner_options, inner_below)
    inner = [c for c in found.columns if c.startswith(target.shape.prefix + "@")]
    row = F.struct(*(F.col(target.shape.prefix + c).alias(c) for c in target.shape.columns), *(F.col(c).alias(c.split("@", 1)[1]) for c in inner))
    names = [fresh("fk") for _ in keys]
    pairs = [F.col(k).alias(n) for k, n in zip(keys, names)]
    if isinstance(nav, Reference):
        found = found.select(*pairs, row.alias(at))
    else:
        order = F.struct(*(F.col(target.shape.prefix + k) for k in target.shape.type.key), row.alias("row"))
        found = found.groupBy(*pairs).agg(F.sort_array(F.collect_list(order)).alias(at))
        found = found.withColumn(at, F.transform(at, lambda s: s["row"]))
    on = [F.col(a) == F.col(n) for a, n in zip(fk, names, strict=True)]
    out = df.join(found, on, "left").drop(*names)
    if not isinstance(nav, Reference):
        kind = out.schema[at].dataType.simpleString()
        out = out.withColumn(at, F.coalesce(at, F.array().cast(kind)))
    return out


class Grouping:
    """A grouped query; select() folds each group in one aggregation."""

    def __init__(self, query: Query, key: Callable | None, element: Callable | None, tests: tuple[Callable, ...] = ()):
        self.query, self.key, self.element, self.tests = query, key, element, tests

    def where(self, test: Callable) -> Grouping:
        """A condition on groups: their key and aggregates."""
        return Grouping(self.query, self.key, self.element, (*self.tests, test))

    having = where

    def select(self, fn: Callable) -> Query:
        scope = self.query._scope()
        row = scope.bind(self.query.shape)
        keys: list[Column] = []
        key = self.key(row) if self.key else None
        if self.key:
            _parts(key)  # refuses a key without equality
        key_shape = _shape(key, keys, "key") if self.key else None
        element = self.element(row) if self.element else row
        names = []
        for k in keys:  # the key's columns get names, so that aggregates can refer to them
            names.append(fresh("key"))
            scope.df = scope.df.withColumn(names[-1], k)
        group = Group(_renamed(key_shape, iter(names), scope) if self.key else None, element)
        value = fn(group)
        tests = [column(t(group)) for t in self.tests]
        columns: list[Column] = []
        shape = _shape(value, columns, "value")
        marks = [fresh("test") for _ in tests]
        grouped = scope.df.groupBy(*(F.col(n) for n in names)).agg(*columns, *(t.alias(m) for t, m in zip(tests, marks)))
        for m in marks:
            grouped = grouped.where(F.col(m))
        return Query(self.query.context, grouped.select(*_columns(shape)), shape)

    def to_groups(self, element: Callable | None = None) -> Query:
        """Key and sorted list of elements. A group must fit a row; aggregate where groups grow with the data."""
        return self.select(lambda g: Fields(key=g.key, items=g.to_list(element)))


def _renamed(shape, names, scope: Scope):
    if isinstance(shape, Record):
        return Fields(**{k: _renamed(s, names, scope) for k, s in shape.fields})
    if isinstance(shape, Entity):
        return Fields(**{c: Expr(F.col(next(names))) for c in shape.columns})
    return Expr(F.col(next(names)))


class Group:
    """Key and aggregates of a group."""

    def __init__(self, key, row):
        self.key, self._row = key, row

    def _col(self, fn: Callable | None) -> Column:
        return column(fn(self._row) if fn else self._row)

    def count(self, where: Callable | None = None) -> Expr:
        return Expr(F.count(F.lit(1)) if where is None else F.count_if(self._col(where)))

    def sum(self, fn: Callable | None = None) -> Expr:
        """0 over no values."""
        return Expr(F.coalesce(F.sum(self._col(fn)), F.lit(0)))

    def average(self, fn: Callable | None = None) -> Expr:
        return Expr(F.avg(self._col(fn)))

    def min(self, fn: Callable | None = None) -> Expr:
        return Expr(F.min(self._col(fn)))

    def max(self, fn: Callable | None = None) -> Expr:
        return Expr(F.max(self._col(fn)))

    def min_by(self, fn: Callable, key: Callable) -> Expr:
        return Expr(F.min_by(self._col(fn), self._col(key)))

    def max_by(self, fn: Callable, key: Callable) -> Expr:
        return Expr(F.max_by(self._col(fn), self._col(key)))

    def any(self, where: Callable) -> Expr:
        return Expr(F.coalesce(F.bool_or(self._col(where)), F.lit(False)))

    def all(self, where: Callable) -> Expr:
        return Expr(F.coalesce(F.bool_and(F.coalesce(self._col(where), F.lit(False))), F.lit(True)))

    def count_distinct(self, fn: Callable) -> Expr:
        """Distinct values, null counting as one."""
        value = self._col(fn)
        return Expr(F.count_distinct(value) + F.coalesce(F.max(value.isNull().cast("int")), F.lit(0)))

    def to_list(self, fn: Callable | None = None) -> Expr:
        items = F.sort_array(F.collect_list(F.struct(self._col(fn).alias("x"))))
        return Expr(F.transform(items, lambda s: s["x"]))

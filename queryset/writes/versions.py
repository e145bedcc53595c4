"""Versioned tables and transactions by copy-on-write.

A table's rows are never changed in place: a write makes a new folder of Parquet files,
and a commit adds one file to the log, named by its number, which readers take the latest
entry of each table from. The file appears at once and only if no other commit has its
number. Source tables stay as they are. All tables are written by Spark, on any file
system that it reaches.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from queryset.errors import ConcurrencyError, TransactionError, TranslationError
from queryset.functions.expr import column
from queryset.operators.rows import Entity, EntityRow, Scope, entity_frame
from queryset.sources.context import Context
from queryset.sources.model import Model

LOG = "commit long, table_name string, path string"


class Versions:
    """The current versions of the tables of a folder; ``folder`` holds versions and log."""

    def __init__(self, spark: SparkSession, folder: str, source: str, model: Model):
        self.spark, self.folder, self.source, self.model = spark, folder.rstrip("/"), source.rstrip("/"), model
        self.open: dict[str, Transaction] = {}
        self.publish(0, {})

    def publish(self, commit: int, paths: dict[str, str]) -> bool:
        """Add a commit to the log as a whole; False if there is one of this number."""
        text = "".join(json.dumps({"commit": commit, "table_name": t, "path": p}) + "\n" for t, p in sorted(paths.items()))
        made, final = f"{self.folder}/_log/.{uuid.uuid4().hex}", f"{self.folder}/_log/{commit:020d}.json"
        if "://" not in self.folder.replace("file://", ""):
            made, final = (p.replace("file://", "") for p in (made, final))
            os.makedirs(os.path.dirname(made), exist_ok=True)
            with open(made, "w", encoding="utf-8") as out:
                out.write(text)
            try:
                os.link(made, final)  # fails where there is such a file
            except FileExistsError:
                return False
            finally:
                os.unlink(made)
            return True
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        fs = jvm.org.apache.hadoop.fs
        made, final = fs.Path(made), fs.Path(final)
        store = made.getFileSystem(conf)
        out = store.create(made, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        try:
            fs.FileContext.getFileContext(final.toUri(), conf).rename(made, final, self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0))
        except Exception as failed:
            store.delete(made, False)
            if "FileAlreadyExists" not in str(failed):
                raise
            return False
        return True

    def _log(self) -> DataFrame:
        return self.spark.read.schema(LOG).json(f"{self.folder}/_log")

    def paths(self) -> tuple[int, dict[str, str]]:
        """The last commit, and the path of each table that has versions."""
        latest = Window.partitionBy("table_name").orderBy(F.desc("commit"))
        rows = self._log().withColumn("k", F.row_number().over(latest)).where("k = 1").collect()
        return max([0, *(r["commit"] for r in rows)]), {r["table_name"]: r["path"] for r in rows}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.paths()[1].get(name, f"{self.source}/{name}.parquet"))

    def context(self) -> Context:
        return Context(self.spark, self.source, self.model, self.table)

    def begin(self) -> Transaction:
        found = Transaction(self)
        self.open[found.token] = found
        return found

    def join(self, token: str) -> Transaction:
        """An open transaction from elsewhere; only its owner ends it."""
        if token not in self.open:
            raise TransactionError(f"no open transaction {token}")
        return Transaction(self, self.open[token])


class Transaction:
    """Staged versions that only this transaction reads, until commit."""

    def __init__(self, versions: Versions, owner: Transaction | None = None):
        self.versions, self.owner = versions, owner
        self.token = owner.token if owner else uuid.uuid4().hex
        self.base, self.seen = (owner.base, owner.seen) if owner else versions.paths()
        self._staged: dict[str, str] = {}
        self._points: list[tuple[str, dict[str, str]]] = []

    @property
    def staged(self) -> dict[str, str]:
        return self.owner.staged if self.owner else self._staged

    def _check(self) -> None:
        if self.token not in self.versions.open:
            raise TransactionError("the transaction has ended")

    def table(self, name: str) -> DataFrame:
        self._check()
        path = self.staged.get(name) or self.seen.get(name) or f"{self.versions.source}/{name}.parquet"
        return self.versions.spark.read.parquet(path)

    def context(self) -> Context:
        return Context(self.versions.spark, self.versions.source, self.versions.model, self.table)

    def write(self, name: str, rows: DataFrame) -> None:
        self._check()
        path = f"{self.versions.folder}/{name}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        self.staged[name] = path

    def savepoint(self, name: str) -> None:
        self._check()
        self._points.append((name, dict(self.staged)))

    def _point(self, name: str) -> int:
        for k in range(len(self._points) - 1, -1, -1):
            if self._points[k][0] == name:
                return k
        raise TransactionError(f"no savepoint {name!r}")

    def rollback_to(self, name: str) -> None:
        self._check()
        k = self._point(name)
        staged = self.staged
        staged.clear()
        staged.update(self._points[k][1])
        del self._points[k + 1 :]

    def release(self, name: str) -> None:
        self._check()
        del self._points[self._point(name) :]

    def commit(self) -> None:
        """Ends the transaction; ending twice does nothing. Fails if another commit wrote one of the tables since the start.

        Of commits at the same time one gets the next number; the others look again at
        what it wrote, and fail or try the number after it.
        """
        if self.owner or self.token not in self.versions.open:
            return
        while self.staged:
            last, now = self.versions.paths()
            moved = [t for t in self.staged if now.get(t) != self.seen.get(t)]
            if moved:
                self.rollback()
                raise ConcurrencyError(f"another commit wrote {', '.join(sorted(moved))}")
            if self.versions.publish(last + 1, self.staged):
                break
        del self.versions.open[self.token]

    def rollback(self) -> None:
        if not self.owner:
            self.versions.open.pop(self.token, None)
            self._staged = {}

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, *_) -> None:
        self.rollback() if kind else self.commit()


def _target(context: Context, name: str, where: Callable | None) -> tuple[Scope, Entity, EntityRow, Column]:
    """All rows of the table of an entity type, and which of them a write is for.

    That are rows of a derived type and such as the type's filters admit. References are
    followed without losing or repeating a row; a condition that is null is false.
    """
    kind = context.model[name]
    if kind.defining is not None:
        raise TranslationError(f"{name} has no table to write")
    df, shape = entity_frame(context.table(kind.table), kind)
    scope = Scope(context, df, every_row=True)
    row, found = scope.bind(shape), F.lit(True)
    tests = [*kind.filters.values(), *([where] if where else [])]
    if kind.base:
        found = F.col(shape.prefix + kind.discriminator[0]).eqNullSafe(kind.discriminator[1])
    for test in tests:
        found = found & F.coalesce(column(test(row)), F.lit(False))
    return scope, shape, row, found


def updated(context: Context, name: str, where: Callable | None, setters: dict[str, Callable], seen: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(all rows of the table after the update, the number of rows it changes as one row ``n``).

    Conditions and values may follow references, whose keys may dangle: every row stays
    once, and what is read through a key without a row is null. ``seen`` observes ``n``
    while the rows are written, instead of a second pass.
    """
    if not setters:
        raise TranslationError("an update sets at least one column")
    scope, shape, row, test = _target(context, name, where)
    unknown = [c for c in setters if c not in shape.columns]
    if unknown:
        raise TranslationError(f"{name} has no column {', '.join(unknown)}")
    values = {c: column(fn(row) if callable(fn) else fn) for c, fn in setters.items()}
    old = {c: F.col(shape.prefix + c) for c in shape.columns}
    kinds = {c: scope.df.schema[shape.prefix + c].dataType for c in shape.columns}
    out = [F.when(test, values[c].cast(kinds[c])).otherwise(old[c]).alias(c) if c in values else old[c].alias(c) for c in shape.columns]
    rows = scope.df.observe(seen, F.count_if(test).alias("n")) if seen else scope.df
    return rows.select(*out), scope.df.where(test).agg(F.count("*").alias("n"))


def deleted(context: Context, name: str, where: Callable | None, seen: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(the rows that stay, the number of rows that go as one row ``n``). Rows where the condition is null stay."""
    scope, shape, _, test = _target(context, name, where)
    rows = scope.df.observe(seen, F.count_if(test).alias("n")) if seen else scope.df
    stay = rows.where(~test).select(*(F.col(shape.prefix + c).alias(c) for c in shape.columns))
    return stay, scope.df.where(test).agg(F.count("*").alias("n"))


def execute_update(tx: Transaction, name: str, where: Callable | None, **setters: Callable) -> int:
    """Update a table within a transaction, in one pass; the number of rows changed."""
    seen = Observation()
    rows, _ = updated(tx.context(), name, where, setters, seen)
    tx.write(tx.versions.model[name].table, rows)
    return seen.get["n"]


def execute_delete(tx: Transaction, name: str, where: Callable | None) -> int:
    """Delete rows of a table within a transaction, in one pass; the number of rows that went."""
    seen = Observation()
    rows, _ = deleted(tx.context(), name, where, seen)
    tx.write(tx.versions.model[name].table, rows)
    return seen.get["n"]


def conflicts(base: DataFrame, originals: DataFrame, key: list[str], token: str) -> DataFrame:
    """Keys of changes whose original token is not the stored one, or whose row is gone."""
    stored = base.select(*key, F.col(token).alias("_stored"), F.lit(True).alias("_there"))
    read = originals.select(*key, F.col(token).alias("_read"))
    found = read.join(stored, key, "left")
    return found.where(F.col("_there").isNull() | ~F.col("_stored").eqNullSafe(F.col("_read"))).select(*key)


def applied(base: DataFrame, key: list[str], inserts: DataFrame | None = None, updates: DataFrame | None = None, deletes: DataFrame | None = None) -> DataFrame:
    """A table after a change set.

    ``updates`` holds the key, values, and ``_changed`` (array of the columns to write,
    so that a change to null is one). ``deletes`` holds keys. ``inserts`` holds whole
    rows. Unchanged columns keep their stored value.
    """
    out = base
    if deletes is not None:
        out = out.join(deletes.select(*key), key, "left_anti")
    if updates is not None:
        new = updates.select(*key, F.col("_changed"), *(F.col(c).alias(f"_new_{c}") for c in updates.columns if c not in [*key, "_changed"]))
        joined = out.join(new, key, "left")
        pick = lambda c: F.when(F.array_contains("_changed", c), F.col(f"_new_{c}").cast(base.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        out = joined.select(*(pick(c) if f"_new_{c}" in joined.columns else F.col(c) for c in base.columns))
    out = out.select(*base.columns)
    if inserts is not None:
        out = out.unionByName(inserts.select(*(F.col(c).cast(base.schema[c].dataType).alias(c) for c in base.columns)))
    return out


class UnitOfWork:
    """Added, modified and removed rows, saved in one transaction.

    Keys may be placeholders (``new_key``): saving gives them real keys, and follows them
    wherever they were used, by entity type and placeholder. Deletes go first, then rows
    in the order of their references.
    """

    def __init__(self, versions: Versions, token_columns: dict[str, str] | None = None):
        self.versions, self.tokens = versions, token_columns or {}
        self.added: dict[str, list[dict]] = {}
        self.modified: dict[str, list[tuple[tuple, dict, object]]] = {}
        self.removed: dict[str, list[tuple[tuple, object]]] = {}
        self.nested: dict[str, list[tuple[tuple, str, tuple, object]]] = {}
        self.original: dict[tuple[str, tuple], object] = {}
        self.steps: list[tuple[str, str]] = []  # what the last save did, in order
        self.keys: dict[tuple[str, int], int] = {}
        self._next = 0

    def new_key(self, entity: str) -> Placeholder:
        self._next -= 1
        return Placeholder(entity, self._next)

    def add(self, entity: str, **values) -> None:
        self.added.setdefault(entity, []).append(values)

    def modify(self, entity: str, key, original_token=None, **changes) -> None:
        self.modified.setdefault(entity, []).append((key if isinstance(key, tuple) else (key,), changes, original_token))

    def modify_document(self, entity: str, key, column_name: str, path: tuple, value, original_token=None) -> None:
        """Set one value inside a nested column: ``path`` holds field names and ordinals of lists. Siblings keep what is stored."""
        at = key if isinstance(key, tuple) else (key,)
        self.nested.setdefault(entity, []).append((at, column_name, tuple(path), value))
        if original_token is not None:
            self.original[entity, at] = original_token

    def remove(self, entity: str, key, original_token=None) -> None:
        self.removed.setdefault(entity, []).append((key if isinstance(key, tuple) else (key,), original_token))

    def _order(self) -> list[str]:
        """Entity types, referenced ones first."""
        names, done = {*self.added, *self.modified, *self.removed, *self.nested}, []

        def visit(name: str, path: tuple[str, ...] = ()) -> None:
            if name in done or name in path:
                return
            for nav in self.versions.model[name].navigations.values():
                if type(nav).__name__ == "Reference" and nav.target in names:
                    visit(nav.target, (*path, name))
            done.append(name)

        for name in sorted(names):
            visit(name)
        return done

    def _real(self, value):
        if not isinstance(value, Placeholder):
            return value
        found = self.keys.get((value.entity, value.number))
        if found is None:
            raise TranslationError(f"{value.entity} has no row for the placeholder {value.number}")
        return found

    def save(self, tx: Transaction | None = None) -> dict[str, int]:
        """Rows added, modified and removed by entity type."""
        own = tx or self.versions.begin()
        try:
            counts = self._save(own)
        except Exception:
            if tx is None:
                own.rollback()
            raise
        if tx is None:
            own.commit()
        return counts

    def _save(self, tx: Transaction) -> dict[str, int]:
        """Deletes of all types first, dependents before what they refer to; then the other changes, principals first."""
        spark, order = self.versions.spark, self._order()
        self.steps = []
        tables: dict[str, DataFrame] = {}
        kinds = {name: self.versions.model[name] for name in order}
        types: dict[str, dict[str, str]] = {}
        for name, kind in kinds.items():
            tables[kind.table] = tables.get(kind.table) or tx.table(kind.table)
            types[name] = {f.name: f.dataType.simpleString() for f in tables[kind.table].schema.fields}
            self._documents(name, tables[kind.table], kind.key)
        for name in order:
            self._check_tokens(name, tables[kinds[name].table], list(kinds[name].key), types[name])
        for name in reversed(order):
            if name in self.removed:
                kind = kinds[name]
                gone = spark.createDataFrame([tuple(map(self._real, k)) for k, _ in self.removed[name]], ", ".join(f"`{k}` {types[name][k]}" for k in kind.key))
                tables[kind.table] = applied(tables[kind.table], list(kind.key), deletes=gone)
                self.steps.append(("delete", name))
        for name, kind in kinds.items():
            base, key, updates, inserts = tables[kind.table], list(kind.key), None, None
            self._give_keys(name, tx.table(kind.table), key)
            if name in self.modified:
                columns = sorted({c for _, changes, _ in self.modified[name] for c in changes} - set(key))
                rows = [(*map(self._real, k), sorted(changes), *(self._real(changes.get(c)) for c in columns)) for k, changes, _ in self.modified[name]]
                schema = ", ".join([*(f"`{k}` {types[name][k]}" for k in key), "_changed array<string>", *(f"`{c}` {types[name][c]}" for c in columns)])
                updates = spark.createDataFrame(rows, schema)
            if name in self.added:
                inserts = spark.createDataFrame([tuple(self._real(r.get(c)) for c in base.columns) for r in self.added[name]], base.schema)
            if updates is not None or inserts is not None:
                tables[kind.table] = applied(base, key, inserts, updates)
                self.steps.append(("write", name))
        for table in dict.fromkeys(kind.table for kind in kinds.values()):
            tx.write(table, tables[table])
        return {name: sum(len(d.get(name, [])) for d in (self.added, self.modified, self.removed)) for name in order}

    def _documents(self, name: str, base: DataFrame, key: tuple[str, ...]) -> None:
        """Changes inside nested documents become changes of the whole column: the stored document with its siblings, one value replaced."""
        for at, column_name, path, value in self.nested.pop(name, []):
            changes = next((c for k, c, _ in self.modified.get(name, []) if k == at and column_name in c), None)
            if changes is None:
                found = base.where(" AND ".join(f"`{k}` <=> {_literal(v)}" for k, v in zip(key, at))).select(column_name).first()
                if found is None:
                    raise ConcurrencyError(f"{name} has no row {at} to change")
                changes = {column_name: found.asDict(recursive=True)[column_name]}
                self.modified.setdefault(name, []).append((at, changes, self.original.get((name, at))))
            inside = changes[column_name]
            for step in path[:-1]:
                inside = _inside(name, inside, step)
            _inside(name, inside, path[-1])
            inside[path[-1]] = value

    def _give_keys(self, name: str, base: DataFrame, key: list[str]) -> None:
        wanted = [r[key[0]] for r in self.added.get(name, []) if key and isinstance(r.get(key[0]), Placeholder) and r[key[0]].entity == name]
        if wanted:
            last = base.agg(F.max(key[0]).alias("k")).first()["k"] or 0
            self.keys.update({(name, w.number): last + 1 + k for k, w in enumerate(wanted)})

    def _check_tokens(self, name: str, base: DataFrame, key: list[str], types: dict[str, str]) -> None:
        token = self.tokens.get(name)
        if not token:
            return
        read = [(*k, t) for k, _, t in self.modified.get(name, [])] + [(*k, t) for k, t in self.removed.get(name, [])]
        if not read:
            return
        schema = ", ".join([*(f"{k} {types[k]}" for k in key), f"{token} {types[token]}"])
        stale = conflicts(base, self.versions.spark.createDataFrame(read, schema), key, token).limit(5).collect()
        if stale:
            raise ConcurrencyError(f"{name}: rows changed since they were read: {[tuple(r) for r in stale]}")


def _literal(value) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def _inside(name: str, document, step):
    """What a document holds at a field or an ordinal that exists."""
    if isinstance(step, str) and isinstance(document, dict) and step in document:
        return document[step]
    if isinstance(step, int) and isinstance(document, list) and 0 <= step < len(document):
        return document[step]
    raise TranslationError(f"a document of {name} has nothing at {step!r}")


class Placeholder:
    """A key that saving will give."""

    def __init__(self, entity: str, number: int):
        self.entity, self.number = entity, number

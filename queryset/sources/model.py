"""A declared model: entity types with keys, columns, navigations and filters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from queryset.errors import TranslationError


@dataclass(frozen=True)
class Reference:
    """To one row of another entity type: foreign key columns here, key columns there."""

    target: str
    columns: tuple[str, ...]
    required: bool = True


@dataclass(frozen=True)
class Collection:
    """To many rows: foreign key columns of the target that hold this entity's key."""

    target: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Skip:
    """Many to many through a link entity: the link's columns to this side and to the target."""

    target: str
    link: str
    own: tuple[str, ...]
    other: tuple[str, ...]


@dataclass
class EntityType:
    """``schema`` is DDL text, or empty to take the table's own; ``key`` is empty for a keyless type.

    ``base`` and ``discriminator`` (column, value) declare a derived type over the base's
    table. ``filters`` are named predicates over a row, applied at every root.
    ``defining`` gives the rows of a keyless type from a context. ``hidden`` columns are
    read by name only.
    """

    name: str
    table: str
    key: tuple[str, ...] = ()
    navigations: dict[str, Reference | Collection | Skip] = field(default_factory=dict)
    filters: dict[str, Callable] = field(default_factory=dict)
    base: str | None = None
    discriminator: tuple[str, str] | None = None
    defining: Callable | None = None
    hidden: tuple[str, ...] = ()
    auto_includes: tuple[str, ...] = ()


class Model:
    def __init__(self, *types: EntityType):
        self.types = {t.name: t for t in types}

    def __getitem__(self, name: str) -> EntityType:
        if name not in self.types:
            raise TranslationError(f"the model has no entity type {name!r}")
        return self.types[name]

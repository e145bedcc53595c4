"""Errors of the query surface; the type is the contract, not the text."""


class TranslationError(Exception):
    """A query that has no meaning as one Spark plan."""


class CardinalityError(Exception):
    """A single-row operator met no row, or more than one."""


class ConcurrencyError(Exception):
    """A stored concurrency token is not the one that was read."""


class TransactionError(Exception):
    """A transaction that is unknown or has ended."""


class CancelledError(Exception):
    """The work was cancelled."""

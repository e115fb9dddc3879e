"""Errors that callers can tell apart."""


class ContractError(ValueError):
    """Input, rules or settings don't fit their contract."""


class RowCountError(RuntimeError):
    """A write made another number of rows than its source has; nothing was published."""

"""Errors raised while a table is being opened or written."""


class TableReadError(Exception):
    """A table could not be opened; the message names the path and the reason."""


class MissingPathError(TableReadError):
    """Nothing exists at the given path."""


class UnsupportedFormatError(TableReadError):
    """No reader is known for the suffix, and no format was named."""


class UnreadableTableError(TableReadError):
    """The path exists, but its content does not match the format."""


class TableWriteError(Exception):
    """A table could not be written; the message names the path and the reason."""

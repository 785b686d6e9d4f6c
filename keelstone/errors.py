"""Errors of the library; all are refusals of data or of access."""


class Refused(ValueError):
    """Data that breaks a contract; nothing of the batch is written."""


class BoundaryError(Refused):
    """Data or a path outside its scope."""


class AccessError(Refused):
    """A reader without the role or the clearance."""


class ConflictError(Refused):
    """A known key with other content."""

    def __init__(self, keys: list):
        super().__init__(f"known keys with other content: {', '.join(map(str, keys))}")
        self.keys = keys

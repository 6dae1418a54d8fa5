"""Declared sources and targets."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# fixed values
MODES = ("snapshot", "watermark")
FETCH_SIZE = 10_000

_IDENTIFIER = re.compile(r"[a-z_][a-z0-9_]*")


@dataclass(frozen=True)
class Split:
    """How a database table is read in parallel: ranges of one column. The bounds only place the
    cuts; rows outside them are read by the first and last range."""

    column: str
    lower: object
    upper: object
    partitions: int


@dataclass(frozen=True)
class SourceSpec:
    """One declared source: where it is, what it must hold, what is taken and where it lands.

    ``location`` is a path for file formats and a table name for ``jdbc``. ``filter`` is a literal
    SQL condition that the source evaluates. ``split`` makes a jdbc source readable in parallel.
    """

    name: str
    location: str
    expected_columns: tuple[str, ...]
    select_columns: tuple[str, ...] = ()
    filter: str | None = None
    target: str | None = None
    mode: str = "snapshot"
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict, hash=False)
    split: Split | None = None

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"{self.name}: mode must be one of {MODES}")
        if not self.expected_columns:
            raise ValueError(f"{self.name}: expected_columns must not be empty")
        for c in (self.name, *self.expected_columns, *self.select_columns):
            if not _IDENTIFIER.fullmatch(c):
                raise ValueError(f"{self.name}: {c!r} is not a lower-case identifier")

        if self.target is not None and not all(map(_IDENTIFIER.fullmatch, self.target.split("."))):
            raise ValueError(f"{self.name}: target {self.target!r} is not of the form schema.table")
        if self.split and (self.format != "jdbc" or self.split.column not in self.expected_columns):
            raise ValueError(f"{self.name}: a split needs a jdbc source and an expected column")

    @property
    def columns(self) -> tuple[str, ...]:
        """Columns taken; those declared as expected unless narrowed."""
        return self.select_columns or self.expected_columns

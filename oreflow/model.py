"""Descriptions of sources, datasets and quality rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql.types import StringType, StructField, StructType

CRITICAL, HIGH, MEDIUM = "critical", "high", "medium"


def text_schema(*names: str) -> StructType:
    """All-text schema: a raw layer keeps values as they came, silver types them."""
    return StructType([StructField(name, StringType()) for name in names])


@dataclass(frozen=True)
class SourceSpec:
    """A raw dataset: where it lies, how it is encoded, who delivers it."""

    name: str
    file_name: str
    file_format: str
    source_system: str
    schema: StructType
    # Quoted CSV values may hold line breaks only when this is set; such files
    # cannot be split between tasks.
    multi_line: bool = False


@dataclass(frozen=True)
class Rule:
    """A named check. ``violated`` maps the checked column to a three-valued mask."""

    name: str
    severity: str
    column: str
    violated: Callable[[Column], Column]

    def __post_init__(self) -> None:
        if not self.name.isidentifier():
            raise ValueError(f"rule names are identifiers, got {self.name!r}")


@dataclass(frozen=True)
class DatasetSpec:
    """What silver demands of one dataset."""

    name: str
    required: tuple[str, ...]
    unique_key: str | None = None
    rules: tuple[Rule, ...] = field(default=())

    @property
    def bronze_table(self) -> str:
        return f"bronze_{self.name}"

    @property
    def silver_table(self) -> str:
        return f"silver_{self.name}"

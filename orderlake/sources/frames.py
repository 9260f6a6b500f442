"""A source whose tables Spark can already read: files, a catalog, or any other frames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from orderlake.functions.columns import watermark_text
from orderlake.operators.incremental import highest, load_spec, select_batch


@dataclass(frozen=True)
class FrameSource:
    read: Callable[[str], DataFrame]

    def highest(self, table: str = "order_items") -> str | None:
        """Largest watermark in the table."""
        column = load_spec(table).watermark
        return highest(self.read(table), column).select(watermark_text(column)).first()[0]

    def batch(self, table: str, lo: str, hi: str) -> DataFrame:
        """The rows of ``table`` in the load ``(lo, hi]``."""
        return select_batch(table, self.read, lo, hi)

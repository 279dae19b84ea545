"""The stateless first stages over streams of alignment lines; the code is the batch code."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.cs import tokens


def stream_tokens(lines: DataFrame, by: list[str], cs: str = "cs") -> DataFrame:
    """Tokens of a streaming (or batch) table of difference strings."""
    return tokens(lines, by, cs)

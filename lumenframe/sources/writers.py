"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> str:
    """CSV with a header that reads back unchanged (blanks kept, quotes doubled)."""
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("quoteAll", quote_all)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_lines(df: DataFrame, line: Column, path: str, encoding: str = "UTF-8") -> str:
    """One text line per row."""
    lines = df.select(line.alias("value"))
    if encoding.upper() == "UTF-8":
        lines.write.text(path)
    else:
        (
            lines.write.option("encoding", encoding)
            .option("sep", "\u0001")
            .option("quote", "")
            .option("quoteAll", False)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    return path

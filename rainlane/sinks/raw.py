"""Landing in the raw zone."""

from __future__ import annotations

from pyspark.sql import DataFrame


def land_documents(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON file per document, as a download leaves it; NULLs are kept."""
    (
        docs.write.mode(mode)
        .option("maxRecordsPerFile", 1)
        .option("ignoreNullFields", False)
        .json(path)
    )


def land_extract(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in every file and no index column; doubled quotes, and texts with
    the blanks they have at both ends."""
    (
        rows.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

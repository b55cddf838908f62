"""Label encoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordinal_code(column: Column, codes: Mapping[str, int], default: int) -> Column:
    """Code of a label; NULL and unknown labels get ``default``, so never NULL."""
    code = F.lit(default)
    for label, value in reversed(list(codes.items())):
        code = F.when(column == F.lit(label), F.lit(value)).otherwise(code)
    return code.cast("int")

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def now(as_of: Column | None) -> Column:
    """``CURRENT_TIMESTAMP`` as a default value; pass ``as_of`` for repeatable runs."""
    return as_of if as_of is not None else F.localtimestamp()

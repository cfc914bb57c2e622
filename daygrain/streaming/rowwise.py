"""Row-level cleaning on streaming DataFrames.

The batch operators that look at one row at a time work on a stream as they are.
Operators that need the whole table (median fill, percentiles, first row per key) are
batch steps on the written layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from daygrain.names import GENERIC, Names
from daygrain.operators.clean import clean_context, clean_incident, clean_measure_rows, clean_typed
from daygrain.operators.lineage import add_lineage, record_hash

ROWWISE = {
    "incident": clean_incident,
    "typed": clean_typed,
    "measure": clean_measure_rows,
    "context": clean_context,
}


def clean_stream(
    stream: DataFrame, table: str, source: str, batch: str, extracted_at: str, names: Names = GENERIC
) -> DataFrame:
    """Lineage, row hash and row-level cleaning for one source."""
    return ROWWISE[table](record_hash(add_lineage(stream, source, batch, extracted_at)), names)

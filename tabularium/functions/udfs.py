"""Named SQL functions and the one vectorised Python function."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# name -> parameters, result type, body
_DEC = "DECIMAL(18,2)"
SQL_FUNCTIONS = {
    "order_label": ("kind STRING, number BIGINT", "STRING", "upper(left(kind, 1)) || '-' || lpad(CAST(number AS STRING), 10, '0')"),
    "gross_price": (f"net {_DEC}, percent DECIMAL(9,4)", _DEC, "round(net + net * percent / 100, 2)"),
    "relative_change": (f"was {_DEC}, now {_DEC}", _DEC, "CASE WHEN was <> 0 THEN round((now / was - 1) * 100, 2) END"),
}


def create_sql_functions(spark: SparkSession) -> None:
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")


def create_table_function(spark: SparkSession, name: str, parameters: str, columns: str, body: str) -> None:
    """A table function over registered views; parameters may have defaults."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {body}")


MARKS = re.compile("[\u0300-\u036f]")
PART_CHARS = 1_000_000  # characters folded together


def in_parts(values: pa.Array, most: int = PART_CHARS) -> Iterator[pa.Array]:
    """Runs of texts that add up to about `most` characters; a longer text ends its run."""
    sizes = pc.fill_null(pc.utf8_length(values), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype="int64") // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(values)]
    for start, end in pairwise(cuts):
        yield values.slice(start, end - start)


def fold(text: str | None) -> str | None:
    return text if text is None or text.isascii() else MARKS.sub("", unicodedata.normalize("NFKD", text))


@F.arrow_udf(T.StringType())
def folded_letters(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Text in Unicode's compatibility form without accents, over Arrow batches: no built-in function folds them.

    A batch holds thousands of texts of any length, so only a part of it is unpacked at a time.
    """
    for values in batches:
        for part in in_parts(values):
            yield pa.array([fold(v.as_py()) for v in part], pa.string())

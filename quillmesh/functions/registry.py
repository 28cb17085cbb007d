"""Functions by name, for SQL and for callers that bring their own.

``install`` makes the library's expressions known to a session as SQL functions: expressions as
SQL functions of the session (they are inlined, so Catalyst sees through them), what needs Python as
Arrow functions, what gives rows as table functions. ``scorer`` puts a caller's own function beside
them, such as a reranking model; ``guarded`` keeps the order of a list when such a function fails.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import Row

from quillmesh.functions.numbers import nfc

EXPRESSIONS: dict[str, str] = {
    "qm_fold": "FOLD(x)",
    "qm_slug": "SLUG(x)",
    "qm_iso_date": "ISO(x)",
    "qm_one_line": "nullif(trim(regexp_replace(x, '\\\\s+', ' ')), '')",
    "qm_first_year": "CAST(nullif(regexp_extract(x, '((?:19|20)[0-9]{2})', 1), '') AS STRING)",
}


def semi_global(truth: str, text: str) -> tuple[int, int, int]:
    """(edits, begin, end) of the part of ``text`` that is nearest to the whole of ``truth``; of equally near ones the one that ends first.

    One row of the matrix at a time, whole rows by numpy: what comes from above is taken first, then
    runs of insertions by a running minimum.
    """
    t = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    steps = np.arange(len(t) + 1)
    row, begin = np.zeros(len(t) + 1, np.int64), steps.copy()
    for i, c in enumerate(truth, 1):
        above = row + 1
        cross = row[:-1] + (t != ord(c))
        new, start = above.copy(), begin.copy()
        better = cross <= above[1:]
        new[1:][better], start[1:][better] = cross[better], begin[:-1][better]
        new[0], start[0] = i, 0
        least = np.minimum.accumulate(new - steps)
        source = np.maximum.accumulate(np.where(new - steps == least, steps, 0))
        row, begin = least + steps, start[source]
    end = int(row.argmin())
    return int(row[end]), int(begin[end]), end


@F.arrow_udf(T.StructType([T.StructField(c, T.IntegerType()) for c in ("edits", "begin", "end")]))
def nearest_part(truth: pa.Array, text: pa.Array) -> pa.Array:
    """``semi_global`` for columns; null where either is null."""
    rows = [None if a is None or b is None else dict(zip(("edits", "begin", "end"), semi_global(a, b))) for a, b in zip(truth.to_pylist(), text.to_pylist())]
    return pa.array(rows, pa.struct([("edits", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))


class Zones:
    """Table function: the lines of a text with their number and offset."""

    def eval(self, text: str):
        at = 0
        for k, line in enumerate((text or "").split("\n"), 1):
            yield Row(line_no=k, start_pos=at, line=line)
            at += len(line) + 1


def install(spark: SparkSession) -> list[str]:
    """Makes the functions known to ``spark``; gives their names."""
    from quillmesh.plans.tables import expand

    for name, sql in EXPRESSIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS STRING RETURN {expand(sql, 'spark')}")
    spark.udf.register("qm_nfc", nfc)
    spark.udf.register("qm_nearest_part", nearest_part)
    spark.udtf.register("qm_lines", F.udtf(Zones, returnType="line_no int, start_pos int, line string"))
    return [*EXPRESSIONS, "qm_nfc", "qm_nearest_part", "qm_lines"]


def scorer(spark: SparkSession, name: str, score: Callable[[list, list], list]) -> Callable[[Column, Column], Column]:
    """Registers a caller's function (queries, texts) -> scores as an Arrow function ``name`` of two string columns."""

    @F.arrow_udf(T.DoubleType())
    def run(query: pa.Array, text: pa.Array) -> pa.Array:
        return pa.array(score(query.to_pylist(), text.to_pylist()), pa.float64())

    return spark.udf.register(name, run)


def guarded(make: Callable[[], DataFrame], otherwise: DataFrame) -> DataFrame:
    """The ranked list (key, rank) that ``make`` gives, or ``otherwise`` if its scorer fails."""
    from quillmesh.runtime import cut

    try:
        return cut(make())
    except Exception:  # whatever a model may raise
        return otherwise

"""Document numbers: the plain form in which two spellings of one number are equal."""

from __future__ import annotations

from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the dashes that count as "-"
DASHES = "­‐‑‒–—―⁃−﹘﹣－"


@F.arrow_udf(T.StringType())
def nfc(a: pa.Array) -> pa.Array:
    """Canonical composition of short strings; each distinct string of a batch once, null stays null.

    (``pyarrow.compute.utf8_normalize`` leaves canonical *de*composition for "NFC", so it is no help.)
    """
    d = a.dictionary_encode()
    words = [x if x is None or x.isascii() else normalize("NFC", x) for x in d.dictionary.to_pylist()]
    return pa.array(words, pa.string()).take(d.indices)


def plain_number(raw: Column) -> Column:
    """The plain form of a typed document number; null for null, blank or a bare "Số".

    Composed, upper case, no blanks, no leading "Số", no zeros before the first digit group,
    "-" for every dash, "Đ" for the letter eth.
    """
    s = F.translate(F.upper(nfc(raw)), "Ð" + DASHES, "Đ" + "-" * len(DASHES))
    s = F.regexp_replace(s, r"[\s\p{Z}\u0085​‌‍⁠﻿]+", "")
    s = F.regexp_replace(s, r"^SỐ[:.]?", "")
    s = F.regexp_replace(s, r"^([^0-9]*)0+(?=[0-9])", "$1")
    return F.nullif(s, F.lit(""))


#: The same rule for DuckDB; ``{0}`` is the column.
PLAIN_NUMBER_SQL = (
    "nullif(regexp_replace(regexp_replace(regexp_replace(translate(upper(nfc_normalize({0})), "
    f"'Ð{DASHES}', 'Đ{'-' * len(DASHES)}'), "
    "'[\\s\\p{{Z}}\\x{{85}}\\x{{200b}}\\x{{200c}}\\x{{200d}}\\x{{2060}}\\x{{feff}}]+', '', 'g'), "
    "'^SỐ[:.]?', ''), '^([^0-9]*)0+([0-9])', '\\1\\2'), '')"
)

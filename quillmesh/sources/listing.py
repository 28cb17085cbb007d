"""Tables in saved HTML pages, and page maps, as rows."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class _Rows(HTMLParser):
    """Cells of table rows, and the first link to a PDF in each."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[list[str], str | None]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append(([], None))
        elif tag in ("td", "th") and self.rows:
            self.cell = []
        elif tag == "a" and self.rows and self.rows[-1][1] is None:
            href = dict(attrs).get("href") or ""
            if href.lower().split("?")[0].endswith(".pdf"):
                self.rows[-1] = (self.rows[-1][0], href)

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None and self.rows:
            self.rows[-1][0].append(" ".join("".join(self.cell).split()))
            self.cell = None


def parse_listing(pages: DataFrame, least: int = 10) -> DataFrame:
    """(page_id, row_no, cells, pdf_url) of table rows with ``least`` cells or more in (page_id, html).

    Null and broken pages give what can be read of them; cells are stripped, entities decoded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for page, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parser = _Rows()
                parser.feed(html or "")
                parser.close()
                out += [(page, n, cells, pdf) for n, (cells, pdf) in enumerate(parser.rows) if len(cells) >= least]
            kinds = (("page_id", pa.int64()), ("row_no", pa.int32()), ("cells", pa.list_(pa.string())), ("pdf_url", pa.string()))
            yield pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in out], t) for i, (c, t) in enumerate(kinds)})

    return pages.select(F.col("page_id").cast("bigint"), "html").mapInArrow(run, "page_id bigint, row_no int, cells array<string>, pdf_url string")


def read_page_map(spark: SparkSession, path: str) -> DataFrame:
    """(article_id, source, page_start, page_end, confidence) from a JSON object of article ids."""
    entry = "struct<source: string, page_start: int, page_end: int, confidence: string>"
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string, {entry}>")).alias("article_id", "e"))
    return raw.select("article_id", "e.*")

"""Tables of pages whose HTML is not well formed: nested tables, cells, rows or tables that are not closed.

Functions of Spark tell such pages from the others, whose rows are cut by patterns. Only the irregular ones go through a
tokeniser, in Arrow batches; their cells are typed by the same functions as all others.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.sources.pages import extract_html_table, typed_cells


def is_irregular(html: Column) -> Column:
    """Whether the first table holds another one, has tags without their ends, or no end. False without a table."""
    inner = F.regexp_extract(html, r"(?is)<table\b[^>]*>(.*?)</table\s*>", 1)

    def uneven(tag: str) -> Column:
        opened, closed = (F.regexp_count(inner, F.lit(rf"(?i){p}")) for p in (rf"<{tag}\b", rf"</{tag}\s*>"))
        return opened != closed

    ended = html.rlike(r"(?is)<table\b.*?</table\s*>")
    odd = inner.rlike(r"(?i)<table\b") | uneven("tr") | uneven("t[dh]")
    return F.coalesce(html.rlike(r"(?i)<table\b") & (~ended | odd), F.lit(False))


def irregular_share(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row: pages, how many are irregular, and their share."""
    return pages.agg(
        F.count(F.lit(1)).alias("num_pages"), F.count_if(is_irregular(F.col(html_col))).alias("num_irregular"),
    ).withColumn("share", F.coalesce(F.try_divide("num_irregular", "num_pages"), F.lit(0.0)))


class _FirstTable(HTMLParser):
    """Texts of the cells of the first table, row by row; what a nested table holds is text of the cell around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.depth, self.row, self.cell, self.over = 0, None, None, False

    def _end_cell(self) -> None:
        if self.cell is not None:
            self.row.append(" ".join("".join(self.cell).split()))
            self.cell = None

    def _end_row(self) -> None:
        self._end_cell()
        if self.row is not None:
            self.rows.append(self.row)
            self.row = None

    def handle_starttag(self, tag, attrs):
        if self.over:
            return
        if tag == "table":
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self._end_row()
            self.row = []
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
            self.row = [] if self.row is None else self.row
            self.cell = []

    def handle_endtag(self, tag):
        if self.over or not self.depth:
            return
        if tag == "table":
            self.depth -= 1
            if not self.depth:
                self._end_row()
                self.over = True
        elif self.depth == 1 and tag == "tr":
            self._end_row()
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()

    def handle_data(self, data):
        if self.cell is not None and not self.over:
            self.cell.append(data)

    def read(self, html: str) -> list[list[str]]:
        self.feed(html)
        self.close()
        self._end_row()
        return self.rows


def first_table(html: str | None) -> list[list[str]]:
    return _FirstTable().read(html) if html else []


def _tokenised(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, position, _day, _number): the first two cells of every row, as text."""
    types = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)

    @F.arrow_udtf(returnType=f"{types}, position int, _day string, _number string")
    class Tokenise:
        def eval(self, batch: pa.RecordBatch):
            found = [first_table(html) for html in batch.column("_html").to_pylist()]
            of_page = pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int64())
            cells = [[row[k] if len(row) > k else None for rows in found for row in rows] for k in (0, 1)]
            yield pa.table({
                **{k: batch.column(k).take(of_page) for k in keys},
                "position": pa.array([p for rows in found for p in range(len(rows))], pa.int32()),
                "_day": pa.array(cells[0], pa.string()), "_number": pa.array(cells[1], pa.string()),
            })

    return Tokenise(pages.asTable())


def extract_any_table(
    pages: DataFrame, keys: Sequence[str], loaded_at: Column, html_col: str = "html", value_name: str = "rate"
) -> DataFrame:
    """Like ``extract_html_table``, but irregular pages are tokenised. ``loaded_at`` must not depend on the page."""
    odd = is_irregular(F.col(html_col))
    cut = _tokenised(pages.where(odd).select(*keys, F.col(html_col).alias("_html")), keys)
    regular = extract_html_table(pages.where(~odd), keys, loaded_at, html_col, value_name)
    return regular.unionByName(typed_cells(cut, keys, loaded_at, value_name))

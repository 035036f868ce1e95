"""Tables out of a corpus of HTML pages, one page per row."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html.entities import html5
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, functions as F

from starledger.functions.lists import let

_REPLACEMENT = "\N{REPLACEMENT CHARACTER}"


#: Parts of the list of entities, so that a name is compared with a few others: a map is searched from end to end.
_PARTS = 1024


@lru_cache(maxsize=1)
def _entities() -> str:
    """Names of characters, and the numbers that stand for characters of another page code, as a JSON array of objects by CRC."""
    named = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    # Numbers 128 to 159 are written where the characters of that code page are meant.
    for n in range(128, 160):
        named[f"#{n}"] = bytes([n]).decode("cp1252", errors="ignore") or chr(n)
    parts: list[dict[str, str]] = [{} for _ in range(_PARTS)]
    for name, text in named.items():
        parts[zlib.crc32(name.encode()) % _PARTS][name] = text
    return json.dumps(parts)


def _character(entity: Column) -> Column:
    """The text of one ``&...;``; unknown names stay as they are."""
    body = F.substring(entity, 2, 40)
    name = F.rtrim(body, F.lit(";"))
    number = F.when(
        name.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(name, 3, 6), 16, 10).try_cast("int")
    ).when(name.rlike("^#[0-9]{1,7}$"), F.substring(name, 2, 7).try_cast("int"))
    known = F.from_json(F.lit(_entities()), "array<map<string,string>>")

    def read(of: Column) -> Column:
        number, key = of["number"], of["key"]
        part = F.get(known, (F.crc32(key.cast("binary")) % _PARTS).cast("int"))
        text = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        outside = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
        return F.coalesce(F.try_element_at(part, key), F.when(outside, F.lit(_REPLACEMENT)).when(number.isNotNull(), text), entity)

    key = lambda n: F.coalesce(F.concat(F.lit("#"), n.cast("string")), name)
    return let(number, lambda n: let(F.struct(n.alias("number"), key(n).alias("key")), read))


def decoded(text: Column) -> Column:
    """``text`` with named and numeric character references replaced; each is read once."""
    return let(text, _decoded)


def _decoded(text: Column) -> Column:
    parts = F.regexp_extract_all(text, F.lit(r"&(?:[a-zA-Z][a-zA-Z0-9]{1,31}|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});|[^&]+|&"), F.lit(0))
    read = F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^&.+;$"), _character(p)).otherwise(p)), "")
    return F.when(F.contains(text, F.lit("&")), read).otherwise(text)


def cell_text(markup: Column) -> Column:
    """Cell markup without tags and entities, white space collapsed; empty cells are NULL."""
    text = decoded(F.regexp_replace(markup, r"(?s)<[^>]*>", ""))
    return let(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), lambda t: F.nullif(t, F.lit("")))


_ROW = r"(?is)(?:</?t(?:head|body|foot)\b[^>]*>\s*)*<tr\b.*?</tr\s*>"
_CELL = r"(?is)<(t[dh]\b[^>]*)>(.*?)</t[dh]\s*>"
#: Rows that are worked on together where a table has spans.
ROWS_AT_ONCE = 256


def _span(tag: Column, name: str, most: int | None = None) -> Column:
    """The number of columns or rows that a cell covers; what is no number, and 0, count as 1."""
    found = F.regexp_extract(tag, rf"(?i)\b{name}\s*=\s*[\"']?\s*(\d{{1,5}})", 1)
    # Most cells have none: a cast of their empty text would raise, and catch, an error for every cell.
    span = let(found, lambda f: F.when(f == "", F.lit(1)).otherwise(F.greatest(f.cast("int"), F.lit(1))))
    return span if most is None else F.least(span, F.lit(most))


def _grid(rows: Column, width: int) -> Column:
    """Per row of a table the texts of the cells of its first ``width`` columns, spans carried right and down.

    The state is, per column, a cell and in how many further rows it still stands. A row's own cells take the columns that
    are free, in order. A cell is read once, however far it spans. Rows are worked on in chunks, so that a long table is not
    copied row by row. A section ends what its rows carry.
    """
    kind = f"array<struct<text:string,left:int>>"
    nothing = F.array_repeat(F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).alias("left")), width).cast(kind)
    columns = F.sequence(F.lit(0), F.lit(width - 1))

    def units(row: Column) -> Column:
        """The row's cells, a cell as often as it covers columns."""
        cells = F.arrays_zip(
            F.regexp_extract_all(row, F.lit(_CELL), F.lit(1)).alias("tag"), F.regexp_extract_all(row, F.lit(_CELL), F.lit(2)).alias("body")
        )
        covering = F.transform(cells, lambda c: F.array_repeat(
            F.struct(cell_text(c["body"]).alias("text"), (_span(c["tag"], "rowspan") - 1).alias("left")), _span(c["tag"], "colspan", width)
        ))
        return F.flatten(covering).cast(kind)

    def next_row(held: Column, row: Column) -> Column:
        carried = F.when(row.rlike(r"(?i)^</?t(head|body|foot)"), nothing).otherwise(held)
        return let(F.struct(carried.alias("carried"), units(row).alias("units")), lambda s: F.transform(columns, lambda c: _at(s, c)))

    def _at(state: Column, c: Column) -> Column:
        above = F.get(state["carried"], c)
        free = c - F.size(F.filter(F.slice(state["carried"], F.lit(1), c), lambda k: k["left"] > 0))
        own = F.coalesce(F.get(state["units"], free), F.get(nothing, F.lit(0)))
        return F.when(above["left"] > 0, F.struct(above["text"].alias("text"), (above["left"] - 1).alias("left"))).otherwise(own)

    # A lambda's array copies what it holds, so what is gathered is handed on as it is; its last row is the one that carries.
    def step(done: Column, row: Column) -> Column:
        return F.concat(done, F.array(next_row(F.element_at(done, -1), row)))

    def chunk(done: Column, first: Column) -> Column:
        last = F.element_at(F.element_at(done, -1), -1)
        return F.concat(done, F.array(F.aggregate(F.slice(rows, first, F.lit(ROWS_AT_ONCE)), F.array(last), step)))

    firsts = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / ROWS_AT_ONCE).cast("int")), lambda n: n * ROWS_AT_ONCE + 1
    )
    # Every chunk begins with the last row of the one before.
    start = F.array(F.array(nothing)).cast(f"array<array<{kind}>>")
    chunks = F.transform(F.aggregate(firsts, start, chunk), lambda done: F.slice(done, F.lit(2), F.size(done)))
    return F.transform(F.flatten(chunks), lambda row: F.transform(row, lambda c: c["text"]))


def harvest_tables(
    pages: DataFrame, index: int, columns: Sequence[str], page_id: str = "page_id", html: str = "html"
) -> DataFrame:
    """Rows of the ``index``-th table of every page, cells named by position.

    For well-formed markup without nested tables; all expressions run in the JVM. Pages
    with fewer tables give no rows; short rows are filled with NULL. ``row_no`` counts
    all rows of the table, ``is_header`` marks rows of header cells only. A cell that spans columns or rows stands in each of them,
    as far as its section of the table goes.
    """
    table = F.get(
        F.regexp_extract_all(html, F.lit(r"(?is)<table\b.*?</table\s*>"), F.lit(0)), F.lit(index)
    )
    found = pages.select(page_id, F.regexp_extract_all(table, F.lit(_ROW), F.lit(0)).alias("rows"), _has_spans(table).alias("spans"))
    # Only tables with spans are laid out as a whole; the rows of others are read one by one.
    grid = F.when(F.col("spans") & (F.size("rows") > 0), _grid(F.col("rows"), len(columns)))
    laid = found.select(page_id, "rows", F.coalesce(grid, F.array().cast("array<array<string>>")).alias("grid"))
    rows = laid.select(page_id, F.posexplode(F.arrays_zip("rows", "grid")).alias("row_no", "at"))
    rows = rows.select(page_id, "row_no", F.col("at.rows").alias("row"), F.col("at.grid").alias("laid"))
    cells = F.slice(F.regexp_extract_all("row", F.lit(_CELL), F.lit(2)), 1, len(columns))
    read = rows.select(page_id, "row_no", _is_header("row"), F.coalesce("laid", F.transform(cells, cell_text)).alias("texts"))
    return read.select(page_id, "row_no", "is_header", *[F.get("texts", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def _has_spans(table: Column) -> Column:
    return F.coalesce(table.rlike(r"(?i)<t[dh]\b[^>]*\b(?:row|col)span\s*="), F.lit(False))


def _is_header(row: str) -> Column:
    return (F.col(row).rlike(r"(?i)<th\b") & ~F.col(row).rlike(r"(?i)<td\b")).alias("is_header")


ROWS_TOGETHER = 5_000


class _TableReader(HTMLParser):
    """Collects the rows of the ``index``-th outermost table; end tags are optional.

    A row is whether it has header cells only, whether it starts a section, and its cells: text, columns and rows covered.
    """

    def __init__(self, index: int):
        super().__init__(convert_charrefs=True)
        self.index, self.seen, self.depth = index, -1, 0
        self.rows: list[tuple[bool, bool, list[tuple[str, int, int]]]] = []
        self.cell: list[str] | None = None
        self.spans, self.section = (1, 1), False

    def _wanted(self) -> bool:
        return self.depth == 1 and self.seen == self.index

    def _close_cell(self) -> None:
        if self.cell is not None:
            self.rows[-1][2].append((" ".join("".join(self.cell).split()), *self.spans))
            self.cell = None

    def _open_row(self) -> None:
        self.rows.append((True, self.section, []))
        self.section = False

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.depth == 0:
                self.seen += 1
            self.depth += 1
        elif self._wanted() and tag in ("thead", "tbody", "tfoot"):
            self._close_cell()
            self.section = True
        elif self._wanted() and tag == "tr":
            self._close_cell()
            self._open_row()
        elif self._wanted() and tag in ("td", "th"):
            self._close_cell()
            if not self.rows:
                self._open_row()
            if tag == "td":
                self.rows[-1] = (False, *self.rows[-1][1:])
            given = dict(attrs)
            self.spans = _covered(given.get("colspan")), _covered(given.get("rowspan"))
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr") and self._wanted():
            self._close_cell()
        elif tag in ("thead", "tbody", "tfoot") and self._wanted():
            self._close_cell()
            self.section = True
        elif tag == "table" and self.depth:
            if self._wanted():
                self._close_cell()
            self.depth -= 1

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def _covered(span: str | None) -> int:
    span = (span or "").strip()
    return max(1, int(span[:5])) if span.isdecimal() else 1


def _spread(rows, width: int) -> Iterator[tuple[bool, list[str | None]]]:
    """Rows with their first ``width`` columns, spans carried right and down; rows without cells are none."""
    carried: list[tuple[str | None, int]] = [(None, 0)] * width
    for header, section, cells in rows:
        if section:
            carried = [(None, 0)] * width
        if not cells:
            continue
        units = iter([(text or None, down - 1) for text, across, down in cells for _ in range(min(across, width))])
        carried = [(text, left - 1) if left > 0 else next(units, (None, 0)) for text, left in carried]
        yield header, [text for text, _ in carried]


def harvest_tables_lenient(
    pages: DataFrame, index: int, columns: Sequence[str], page_id: str = "page_id", html: str = "html"
) -> DataFrame:
    """Like ``harvest_tables`` for markup with unclosed cells or rows, or nested tables.

    Pages are parsed one by one inside Arrow batches, spread over all tasks. Spans are carried in the same way. Only outermost
    tables count; the text of a nested one belongs to the cell around it. A task holds one batch of pages
    (``spark.sql.execution.arrow.maxRecordsPerBatch``; lower it for very large pages), the
    rows of one page and ``ROWS_TOGETHER`` others.
    """
    width = len(columns)
    names = [page_id, "row_no", "is_header", *columns]

    def parse(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = []
            for page, text in zip(batch[page_id], batch[html]):
                if text is None:
                    continue
                reader = _TableReader(index)
                reader.feed(text)
                reader.close()
                for row_no, (header, cells) in enumerate(_spread(reader.rows, width)):
                    out.append((page, row_no, header, *cells))
                if len(out) >= ROWS_TOGETHER:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    id_type = dict(pages.dtypes)[page_id]
    fields = ", ".join(f"`{c}` string" for c in columns)
    schema = f"`{page_id}` {id_type}, row_no int, is_header boolean, {fields}"
    return pages.select(page_id, html).mapInPandas(parse, schema)

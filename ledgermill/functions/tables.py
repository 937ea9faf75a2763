"""HTML tables to rows and cells, and the charge lines of bills that are tables.

A page is cut where tables and rows begin, and the pieces are folded in document order:
a table starts afresh, a row places its cells beside those that reach into it from rows
above. So a cell that spans columns or rows stands in each of its places, and the n-th
cell of a row lies under the n-th heading.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.text import html_to_text

# The largest spans that HTML knows.
MOST_COLUMNS, MOST_ROWS = 1000, 65534

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_CELL = r"""(?is)^<t[dh]\b((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_REACH = "array<struct<col:int,text:string,left:int>>"
_ROWS = "array<struct<table_no:int,cells:array<string>>>"

# Headings, in lower case, of the columns of a bill.
HEADINGS = {
    "description": ("description", "charge", "charges", "item", "details"),
    "period": ("period", "billing period", "dates"),
    "quantity": ("quantity", "qty", "usage", "units used"),
    "unit": ("unit", "units", "measure"),
    "rate": ("rate", "price", "unit price", "rate ($)"),
    "amount": ("amount", "total", "cost", "amount ($)", "charge ($)"),
}
_FIELDS = tuple(HEADINGS)
_ITEM = (
    "struct<description:string,period:string,quantity:decimal(18,4),unit:string,"
    "rate:decimal(18,4),amount:decimal(18,2)>"
)


def _span(attributes: Column, name: str, most: int) -> Column:
    said = F.regexp_extract(attributes, rf"(?i)\b{name}\s*=\s*[\"']?\s*([0-9]+)", 1)
    return F.least(F.greatest(F.coalesce(said.try_cast("int"), F.lit(1)), F.lit(1)), F.lit(most))


def _cells(row: Column) -> Column:
    """text, columns, rows of the cells of a row's markup."""
    inside = F.regexp_replace(row, r"(?is)</(?:tr|table)\s*>.*$", "")
    pieces = F.filter(F.split(inside, r"(?i)(?=<t[dh]\b)"), lambda p: p.rlike(_CELL))

    def cell(piece: Column) -> Column:
        attributes = F.regexp_extract(piece, _CELL, 1)
        content = F.regexp_replace(F.regexp_replace(piece, _CELL, ""), r"(?is)</t[dh]\s*>.*$", "")
        return F.struct(
            html_to_text(content).alias("text"),
            _span(attributes, "colspan", MOST_COLUMNS).alias("columns"),
            _span(attributes, "rowspan", MOST_ROWS).alias("rows"),
        )

    return F.transform(pieces, cell)


def _filled(cells: Column, reach: Column) -> Column:
    """``cells`` and the cells from above that stand right behind them."""
    return F.aggregate(
        reach,
        cells,
        lambda done, above: F.when(
            above["col"] == F.size(done), F.concat(done, F.array(above["text"]))
        ).otherwise(done),
    )


def _placed(row: Column, reach: Column) -> Column:
    """cells of a row, and what reaches into the next one."""

    def place(state: Column, cell: Column) -> Column:
        before = _filled(state["cells"], reach)
        below = F.transform(
            F.sequence(F.lit(0), cell["columns"] - 1),
            lambda i: F.struct(
                (F.size(before) + i).alias("col"),
                cell["text"].alias("text"),
                (cell["rows"] - 1).alias("left"),
            ),
        )
        return F.struct(
            F.concat(before, F.array_repeat(cell["text"], cell["columns"])).alias("cells"),
            F.when(cell["rows"] > 1, F.concat(state["below"], below.cast(_REACH)))
            .otherwise(state["below"])
            .alias("below"),
        )

    start = F.struct(
        F.array().cast("array<string>").alias("cells"), F.array().cast(_REACH).alias("below")
    )

    def finish(state: Column) -> Column:
        still = F.transform(
            F.filter(reach, lambda a: a["left"] > 1),
            lambda a: a.withField("left", a["left"] - 1),
        )
        return F.struct(
            _filled(state["cells"], reach).alias("cells"),
            F.array_sort(F.concat(still, state["below"])).alias("reach"),
        )

    return F.aggregate(_cells(row), start, place, finish)


def table_rows(html: Column) -> Column:
    """Rows of all tables of a page in order: table_no (from 1) and cells, spans filled in.

    A table inside a cell is a table of its own; what follows it in that row is left out.
    Rows outside tables belong to table 0. Null pages have no rows.
    """
    visible = F.regexp_replace(html, _HIDDEN, " ")
    pieces = F.filter(
        F.split(visible, r"(?i)(?=<(?:table|tr)\b)"), lambda p: p.rlike(r"(?i)^<(?:table|tr)\b")
    )
    start = F.struct(
        F.lit(0).alias("table_no"), F.array().cast(_REACH).alias("reach"), F.array().cast(_ROWS).alias("rows")
    )

    def step(state: Column, piece: Column) -> Column:
        done = _placed(piece, state["reach"])
        row = F.struct(state["table_no"].alias("table_no"), done["cells"].alias("cells"))
        return F.when(
            piece.rlike(r"(?i)^<table\b"),
            F.struct(
                (state["table_no"] + 1).alias("table_no"),
                F.array().cast(_REACH).alias("reach"),
                state["rows"].alias("rows"),
            ),
        ).otherwise(
            F.struct(
                state["table_no"].alias("table_no"),
                done["reach"].alias("reach"),
                F.concat(state["rows"], F.array(row)).alias("rows"),
            )
        )

    return F.aggregate(pieces, start, step, lambda state: state["rows"])


def _number(raw: Column, kind: str) -> Column:
    """A number with currency signs and separators; minus, brackets or CR make it negative."""
    bare = F.regexp_replace(raw, r"[$€£,\s]", "")
    size = F.regexp_extract(bare, r"([0-9]+(?:\.[0-9]+)?|\.[0-9]+)", 1).try_cast(kind)
    negative = bare.rlike(r"^-|^\(.*\)$|(?i)cr$")
    return F.when(negative, -size).otherwise(size)


def bill_items(html: Column) -> Column:
    """Charge lines of a page's tables, in the shape of ``bill_lines``.

    A row that names a description and an amount column is a heading; the rows of its
    table after it that have an amount are items. A quantity may carry its unit.
    """

    def places(cells: Column) -> Column:
        lower = F.transform(cells, lambda c: F.lower(c))

        def found(names: tuple[str, ...]) -> Column:
            known = F.array(*[F.lit(n) for n in names])
            hits = F.transform(lower, lambda c: F.array_contains(known, c))
            return F.array_position(hits, F.lit(True)).cast("int")

        return F.array(*[found(HEADINGS[f]) for f in _FIELDS])

    def item(cells: Column, at: Column) -> Column:
        def field(name: str) -> Column:
            place = F.element_at(at, _FIELDS.index(name) + 1)
            value = F.when(place > 0, F.try_element_at(cells, F.greatest(place, F.lit(1))))
            return F.nullif(value, F.lit(""))

        unit = F.nullif(F.regexp_extract(field("quantity"), r"([A-Za-z]+)\s*$", 1), F.lit(""))
        return F.struct(
            field("description").alias("description"),
            field("period").alias("period"),
            _number(field("quantity"), "decimal(18,4)").alias("quantity"),
            F.coalesce(field("unit"), unit).alias("unit"),
            _number(field("rate"), "decimal(18,4)").alias("rate"),
            _number(field("amount"), "decimal(18,2)").alias("amount"),
        ).cast(_ITEM)

    start = F.struct(
        F.lit(0).alias("table_no"),
        F.array_repeat(F.lit(0), len(_FIELDS)).alias("at"),
        F.array().cast(f"array<{_ITEM}>").alias("items"),
    )
    first, last = _FIELDS.index("description") + 1, _FIELDS.index("amount") + 1

    def step(state: Column, row: Column) -> Column:
        same = state["table_no"] == row["table_no"]
        at = F.when(same, state["at"]).otherwise(F.array_repeat(F.lit(0), len(_FIELDS)))
        named = places(row["cells"])
        heading = (F.element_at(named, first) > 0) & (F.element_at(named, last) > 0)
        made = item(row["cells"], at)
        counts = ~heading & (F.element_at(at, last) > 0) & made["amount"].isNotNull()
        return F.struct(
            row["table_no"].alias("table_no"),
            F.when(heading, named).otherwise(at).alias("at"),
            F.when(counts, F.concat(state["items"], F.array(made)))
            .otherwise(state["items"])
            .alias("items"),
        )

    return F.aggregate(table_rows(html), start, step, lambda state: state["items"])

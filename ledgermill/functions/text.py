"""Text clean-up: HTML, previews, message bodies, file names and bill lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREVIEW_CHARS = 500

# Characters a file name may not hold.
UNSAFE_IN_NAME = r"[\\/:*?\"<>|'‘’“”]"
UNSAFE_IN_STAGED_NAME = r"[\\/:\"*?<>|]"

_BLANKS = r"[ \t\r\n\f]+"

# Entities decoded after the tags are gone; the ampersand goes last.
_ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&amp;", "&"),
)

# One charge line: description, quantity, unit, rate, amount.
BILL_LINE = (
    r"^(.+?)\s+(-?[0-9.]+)\s+(kWh|MJ|days|months|units)\s+@\s+\$?([0-9.]+)"
    r"\s+=\s+(-?)\$?([0-9.,]+)(\s+CR)?$"
)


def drop_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\0"), F.lit(""))


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    """First ``chars`` characters without NULs; NULL for empty text."""
    return F.nullif(F.substring(drop_nul(text), 1, chars), F.lit(""))


def join_pages(pages: Column) -> Column:
    """Page texts joined by newlines; empty pages are skipped."""
    kept = F.filter(pages, lambda p: p.isNotNull() & (p != ""))
    return drop_nul(F.array_join(kept, "\n"))


def html_to_text(html: Column) -> Column:
    """Visible text of an HTML page: blocks, comments and tags out, entities decoded."""
    text = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style[^>]*>.*?</style>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return drop_nul(F.trim(F.regexp_replace(text, _BLANKS, " ")))


def decode_base64url(data: Column) -> Column:
    """URL-safe base64 to text; the missing padding is put back."""
    standard = F.translate(F.rtrim(data, F.lit("=")), "-_", "+/")
    width = (F.ceil(F.length(standard) / F.lit(4)) * 4).cast("int")
    return F.decode(F.unbase64(F.rpad(standard, width, "=")), "UTF-8")


def body_text(data: Column, snippet: Column) -> Column:
    """Decoded, tag-free message body, or the snippet where there is no body."""
    body = F.nullif(html_to_text(decode_base64url(data)), F.lit(""))
    return F.coalesce(body, snippet)


def sender_address(header: Column) -> Column:
    """``Name <a@b>`` to ``a@b``; a bare address stays as it is."""
    tail = F.substring_index(F.substring_index(header, "<", 2), "<", -1)
    return F.nullif(
        F.trim(
            F.when(
                header.contains("<") & header.contains(">"),
                F.regexp_replace(tail, ">+$", ""),
            ).otherwise(header)
        ),
        F.lit(""),
    )


def file_extension(name: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(name, r"\.([^./]*)$", 1)), F.lit(""))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def safe_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, UNSAFE_IN_NAME, ""))


def staged_name(name: Column) -> Column:
    """Variant for staged files: a bad character becomes an underscore."""
    return F.regexp_replace(name, UNSAFE_IN_STAGED_NAME, "_")


def filed_name(supplier: Column, file_name: Column) -> Column:
    """``Supplier - file``; the prefix is left out when no supplier is known."""
    return F.concat_ws(" - ", F.nullif(safe_name(supplier), F.lit("")), file_name)


def bill_lines(text: Column) -> Column:
    """Charge lines of a bill as an array of structs; credits come out negative."""

    def number(raw: Column, decimals: int) -> Column:
        return F.nullif(F.replace(raw, F.lit(","), F.lit("")), F.lit("")).try_cast(
            f"decimal(18,{decimals})"
        )

    def parse(line: Column) -> Column:
        def part(i: int) -> Column:
            return F.regexp_extract(line, BILL_LINE, i)

        size = number(part(6), 2)
        credit = (part(5) == "-") | (F.trim(part(7)) == "CR")
        return F.struct(
            part(1).alias("description"),
            F.lit(None).cast("string").alias("period"),
            number(part(2), 4).alias("quantity"),
            part(3).alias("unit"),
            number(part(4), 4).alias("rate"),
            F.when(credit, -size).otherwise(size).alias("amount"),
        )

    # The plain search keeps the expression away from ordinary lines.
    charge_lines = F.filter(
        F.split(text, r"\r?\n"), lambda s: s.contains(" @ ") & s.rlike(BILL_LINE)
    )
    return F.transform(charge_lines, parse)

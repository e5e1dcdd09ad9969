"""Expressions that turn one fixed-width line into typed columns.

``line`` is always the SQL text of the line to decode, usually just a column name. Everything
here is built in, so a decode is a single projection inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sondelake.functions.layout import Field, Layout

# The characters removed from both ends of a field, U+0000 to U+0020.
TRIMMED = "".join(rf"\u{code:04x}" for code in range(0x21))


def _slice(line: str, field: Field) -> str:
    return f"substring({line}, {field.start}, {field.length})"


def _text(line: str, field: Field) -> str:
    if field.length == 1:
        # Trimming a single character is one comparison.
        return f"CASE WHEN {_slice(line, field)} <= ' ' THEN '' ELSE {_slice(line, field)} END"
    return f"btrim({_slice(line, field)}, '{TRIMMED}')"


def _int(line: str, field: Field) -> str:
    # The cast ignores surrounding blanks and control characters itself, but also U+007F, which
    # is not among the trimmed ones: replaced by a letter, it makes the field malformed.
    return f"try_cast(replace({_slice(line, field)}, '\\u007f', 'x') AS int)"


def text_value(line: str, field: Field) -> Column:
    """Trimmed slice; a blank field is the empty string, not NULL."""
    return F.expr(_text(line, field))


def int_value(line: str, field: Field) -> Column:
    """Slice as integer; blank and malformed fields are both NULL (see `malformed_name`)."""
    return F.expr(_int(line, field))


def decode(line: str, layout: Layout) -> list[Column]:
    """All columns of ``layout``, typed and named, in column order."""
    return [
        F.expr(f"{(_text if f.is_text else _int)(line, f)} AS {f.name.lower()}")
        for f in layout.ordered
    ]


def malformed_name(line: str, layout: Layout) -> Column:
    """Name of the first number column that is NULL although its slice is not blank.

    Evaluated next to the decoded columns; NULL if every number was readable.
    """
    tests = ", ".join(
        f"CASE WHEN {name} IS NULL AND ({_text(line, f)}) <> '' THEN '{name}' END"
        for name, f in ((f.name.lower(), f) for f in layout.ordered)
        if not f.is_text
    )
    return F.expr(f"coalesce({tests})")


def block_uid(header: str, layout: Layout) -> Column:
    """Natural key of a block: its trimmed key slices, concatenated as text."""
    return F.expr(f"concat({', '.join(_text(header, f) for f in layout.key_fields)})")


def level_count(header: str, layout: Layout) -> Column:
    """Number of levels a header announces; NULL when blank or not a number."""
    return int_value(header, layout.count_field)


def csv_line(line: str, layout: Layout, uid: str) -> Column:
    """Delimited text of one record: text fields and the key quoted, numbers as written.

    Quotes inside a text field are passed through as they are.
    """
    cells = [
        f"""concat('"', {_text(line, f)}, '"')""" if f.is_text else _text(line, f)
        for f in layout.ordered
    ]
    return F.expr(f"""concat_ws(',', {', '.join(cells)}, concat('"', {uid}, '"'))""")

"""CSV records in one text column, in the dialect of Python's csv module.

``from_csv`` differs from that dialect on stray and unclosed quotes, carriage
returns and text after a record's end. It reads the records whose quoting is
regular; the others are split with linear regular expressions. Everything is a
built-in expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.schema import CSV_RECORD_OPTIONS

# What str.strip() of Python removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# One character stands for a doubled quote while a record is split, so that no
# pattern needs a repeated group (those recurse once per repetition in Java).
# Text that already holds the character is escaped around the split.
_PAIR = "\x01"
_ESCAPE = "\x02"
_FIELD = r'\G,(\x01*+"[^"]*+"?+[^,\r\n]*+|[^,\r\n]*+)'
_OPENED = r'^\x01*"'
_QUOTED_PART = r'^(\x01*"[^"]*)'
_LEADING_PAIRS = r"^(\x01*)"
# Every field either without quotes or in quotes from end to end.
_CELL = r'(?:"(?:[^"]++|"")*+"|[^",\r\n]*+)'
_REGULAR = rf"^{_CELL}(?:,{_CELL})*+\z"
_ODD = "_odd"


def utf8_text(value: Column) -> Column:
    """Bytes to text; NULL if they are not valid UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def strip_whitespace(text: Column) -> Column:
    return F.btrim(text, F.lit(PYTHON_WHITESPACE))


def csv_line(fields: Sequence[Column]) -> Column:
    """One CSV line: quotes only where needed, inner quotes doubled, outer whitespace stripped."""

    def quoted(field: Column) -> Column:
        text = F.coalesce(field.cast("string"), F.lit(""))
        return F.when(
            text.rlike('[",\r\n]'),
            F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')),
        ).otherwise(text)

    return strip_whitespace(F.concat_ws(",", *[quoted(f) for f in fields]))


def _swap(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _field_text(token: Column) -> Column:
    """Value of a raw field: quotes count only where the field begins with one."""
    opened = F.regexp_extract(token, _QUOTED_PART, 1)
    pairs = F.length(F.regexp_extract(token, _LEADING_PAIRS, 1))
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    return (
        F.when(~token.contains('"') & ~token.contains(_PAIR), token)
        # The usual quoted field: one quote at either end, pairs between.
        .when(
            token.startswith('"') & token.endswith('"') & ~inner.contains('"'),
            _swap(inner, _PAIR, '"'),
        )
        .when(
            token.rlike(_OPENED),
            F.concat(
                _swap(_swap(opened, '"', ""), _PAIR, '"'),
                _swap(F.substring(token, F.length(opened) + 2, F.length(token)), _PAIR, '""'),
            ),
        )
        .when(
            token.startswith(_PAIR),
            F.concat(
                F.repeat(F.lit('"'), pairs - 1),
                _swap(F.substring(token, pairs + 1, F.length(token)), _PAIR, '""'),
            ),
        )
        .otherwise(_swap(token, _PAIR, '""'))
    )


def _unescaped(value: Column) -> Column:
    return _swap(_swap(value, _ESCAPE + "p", _PAIR), _ESCAPE + "e", _ESCAPE)


def _special(text: Column) -> Column:
    return text.contains('"') | text.contains("\n") | text.contains("\r")


def regular_cells(text: Column, arity: int) -> Column:
    """Fields of a record that Spark's parser reads like Python's; NULL for any other.

    That is a record with quotes, all of them regular, no carriage return or zero
    byte, no byte order mark at its start, and ``arity`` fields.
    """
    names = [f"c{i}" for i in range(arity)]
    schema = ", ".join(f"{name} string" for name in [*names, _ODD])
    options = {**CSV_RECORD_OPTIONS, "columnNameOfCorruptRecord": _ODD}
    plain = ~text.rlike("[\r\x00]") & ~text.startswith("\ufeff")
    regular = text.contains('"') & plain & text.rlike(_REGULAR)
    return F.when(regular, F.from_csv(text, schema, options))


def cell_array(cells: Column, arity: int) -> Column:
    """The fields as an array; NULL where ``regular_cells`` found none or another number."""
    values = F.array(*[F.coalesce(cells[f"c{i}"], F.lit("")) for i in range(arity)])
    return F.when(cells.isNotNull() & cells[_ODD].isNull(), values)


def marked_text(text: Column) -> Column:
    """Text with every doubled quote as one mark; NULL where commas alone split a record."""
    safe = _swap(_swap(text, _ESCAPE, _ESCAPE + "e"), _PAIR, _ESCAPE + "p")
    return F.when(_special(text), _swap(safe, '""', _PAIR))


def raw_fields(marked: Column) -> Column:
    """Fields of the first record of marked text, still quoted."""
    return F.regexp_extract_all(F.concat(F.lit(","), marked), F.lit(_FIELD), F.lit(1))


def record_of(
    text: Column, marked: Column, tokens: Column, field_limit: int | None = None
) -> Column:
    """Struct ``(fields, failure)`` of a record that is split already; see ``csv_record``."""
    # What follows the first record; evaluated only for text with line ends.
    rest = F.substring(marked, F.length(F.array_join(tokens, ",")) + 1, F.length(marked))
    bare_return = text.contains("\r") & rest.rlike("^\r+[^\r\n]")
    fields = (
        F.when(marked.isNull(), F.split(text, ","))
        .when(text.startswith("\r") | text.startswith("\n"), F.array().cast("array<string>"))
        .when(
            text.contains(_PAIR) | text.contains(_ESCAPE),
            F.transform(tokens, lambda t: _unescaped(_field_text(t))),
        )
        .otherwise(F.transform(tokens, _field_text))
    )
    wrong = bare_return
    if field_limit is not None:
        wrong |= beyond_limit(text, fields, field_limit)
    failure = F.when(text == "", "empty").when(wrong, "parse")
    return F.struct(fields.alias("fields"), failure.alias("failure"))


def beyond_limit(text: Column, fields: Column, limit: int) -> Column:
    return (F.length(text) > limit) & F.exists(fields, lambda f: F.length(f) > limit)


def csv_record(text: Column, field_limit: int | None = None) -> Column:
    """Struct ``(fields, failure)`` of the first CSV record in ``text``.

    ``failure`` is NULL, ``empty`` (no record at all) or ``parse`` (a bare
    carriage return inside the record, or a field above the limit if one is given).
    """
    marked = marked_text(text)
    return record_of(text, marked, raw_fields(marked), field_limit)


def csv_line_of(fields: Column) -> Column:
    """One CSV line from an array of text."""
    quoted = F.transform(
        fields,
        lambda f: F.when(
            f.rlike('[",\r\n]'), F.concat(F.lit('"'), _swap(f, '"', '""'), F.lit('"'))
        ).otherwise(f),
    )
    return strip_whitespace(F.array_join(quoted, ","))

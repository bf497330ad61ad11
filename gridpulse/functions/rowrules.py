"""Gate rules for one delivered row, as a single expression over text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridpulse.functions.columns import let, parse_timestamp
from gridpulse.schemas import RAW_COLUMNS, RAW_MEASURES

# What the gate accepts as an integer and as a number, and how it
# words a verdict. Underscores may group digits.
INTEGER_PATTERN = r"^[+-]?\d+(_\d+)*$"
NUMBER_PATTERN = (
    r"(?i)^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf|infinity|nan)$"
)
# eight fields in plain spelling: no signs, quotes, blanks or grouped digits
PLAIN_ROW = (
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2},\d+,\d*"
    r"(?:,(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)?){5}$"
)
PASSED = "Minimum quality checks passed"
BATCH_PASSED = "Validation passed"
NO_ROWS = "File contains header but no data rows"
EMPTY_FILE = "File is empty"
WRONG_ORDER = "columns are in an unexpected order"
WRONG_FIELD_COUNT = "wrong field count"
FIELD_LIMIT = 131072  # characters of one field
TOO_LONG = "Quality validation error: field larger than field limit (131072)"
# what surrounds a value without being part of it
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
# A quoted field up to before its closing quote, and a whole field: only a quote in front makes a field quoted, and
# what follows the closing quote belongs to the field as it is.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
RECORD_FIELD = rf'(?:{QUOTED}"[^,]*+|[^",][^,]*+|)'


def _failure(label: str, detail: Column | None = None) -> Column:
    shown = F.lit("") if detail is None else F.concat(F.lit(": "), detail)
    return F.struct(F.lit(label).alias("label"), shown.alias("detail"))


def _number(text: Column) -> Column:
    return F.regexp_replace(text, "_", "").try_cast("double")


def is_plain(line: Column) -> Column:
    """A row in the usual spelling that breaks no rule, told from its whole text.

    One pattern and one cast; what it does not cover is judged rule by rule.
    """
    start = F.substring_index(line, ",", 1)
    return line.rlike(PLAIN_ROW) & (F.length(line) <= FIELD_LIMIT) & start.try_cast("timestamp_ntz").isNotNull()


def _rule_by_rule(fields: Column) -> Column:
    text = {c: F.btrim(F.coalesce(F.get(fields, F.lit(i)), F.lit("")), F.lit(BLANKS)) for i, c in enumerate(RAW_COLUMNS)}
    blank = {c: text[c] == "" for c in RAW_COLUMNS}
    rules: list[tuple[Column, Column]] = [
        (F.exists(fields, lambda f: F.length(f) > FIELD_LIMIT), _failure(TOO_LONG)),
        (F.size(fields) != len(RAW_COLUMNS), _failure(WRONG_FIELD_COUNT)),
        (blank["datetime"], _failure("missing datetime")),
        (parse_timestamp(text["datetime"]).isNull(),
         _failure("invalid datetime", text["datetime"])),
        (blank["CellID"], _failure("missing CellID")),
        (~text["CellID"].rlike(INTEGER_PATTERN), _failure("invalid CellID", text["CellID"])),
        (~blank["countrycode"] & ~text["countrycode"].rlike(INTEGER_PATTERN),
         _failure("invalid countrycode", text["countrycode"])),
    ]
    for m in RAW_MEASURES:
        rules += [
            (~blank[m] & ~text[m].rlike(NUMBER_PATTERN), _failure(f"non-numeric {m}", text[m])),
            (~blank[m] & (_number(text[m]) < 0),
             _failure(f"negative {m}", _number(text[m]).cast("string"))),
        ]
    chain = F.when(*rules[0])
    for test, failure in rules[1:]:
        chain = chain.when(test, failure)
    return chain


def first_failure(line: Column, fields: Column) -> Column:
    """struct(label, detail) of the first rule a row breaks, null for a good row.

    Order of rules: length of fields, field count, datetime, CellID, countrycode, then each
    measure numeric and not negative. Blank measures and a blank countrycode
    are legal. ``fields`` is only computed for rows that are not plain.
    """
    return F.when(~is_plain(line), let(fields, _rule_by_rule))


def line_failure(line: Column) -> Column:
    """First failure of a text line."""
    return first_failure(line, split_line(line))


def row_failure() -> Column:
    """First failure of a row that holds the eight fields as text columns.

    A comma inside a field adds a separator to the joined text, so such a row
    is never taken for a plain one.
    """
    fields = F.array(*[F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS])
    return first_failure(F.array_join(fields, ","), fields)


def _listed(names: Column) -> Column:
    """['a', 'b'] as text; backslashes and breaks inside a name are written out."""
    def shown(name: Column) -> Column:
        for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            name = F.replace(name, F.lit(plain), F.lit(written))
        return F.concat(F.lit("'"), name, F.lit("'"))

    quoted = F.transform(names, shown)
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def header_failure(header: Column) -> Column:
    """Reason a header (array of names) is refused, null when it is exact."""
    expected = F.array(*[F.lit(c) for c in RAW_COLUMNS])
    missing = F.filter(expected, lambda c: ~F.array_contains(header, c))
    unexpected = F.filter(header, lambda c: ~F.array_contains(expected, c))
    parts = F.array_compact(F.array(
        F.when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), _listed(missing))),
        F.when(F.size(unexpected) > 0, F.concat(F.lit("unexpected columns: "), _listed(unexpected))),
        F.when((F.size(missing) == 0) & (F.size(unexpected) == 0), F.lit(WRONG_ORDER)),
    ))
    return F.when(header != expected, F.array_join(parts, "; "))


def split_line(line: Column) -> Column:
    """Fields of one CSV record; quoted fields may hold commas and line feeds.

    A quote counts only at the start of a field; inside such a field two quotes are one. A quote that is never closed
    ends with the record.
    """
    plain = F.split(line, ",")
    closed = F.concat(line, F.when(line.rlike(rf"\A(?:{RECORD_FIELD},)*+{QUOTED}\z"), '",').otherwise(","))
    inner = rf'\A{QUOTED.replace("[", "([", 1)})"([^,]*)\z'
    quoted = F.transform(
        F.regexp_extract_all(closed, F.lit(rf"({RECORD_FIELD}),"), F.lit(1)),
        lambda f: F.when(F.startswith(f, F.lit('"')), F.concat(
            F.replace(F.regexp_extract(f, inner, 1), F.lit('""'), F.lit('"')), F.regexp_extract(f, inner, 2))).otherwise(f))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)

"""Column -> Column cleansing rules. Everything stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "missing", per kind of field.
BLANK = ("", "nan", "none")
BLANK_PHASE = ("", "nan", "none", "null")
BLANK_DATE = ("", "nan", "none", "nat")
BLANK_OPENING = ("", "nan", "none", "nat", "não informada")
BLANK_STATE = ("", "nan", "none", "nat", "<na>")
BLANK_MONEY = ("", "nan", "none", "<na>")
TRUE_WORDS = ("S", "SIM", "TRUE", "1")
PLATE_PLACEHOLDER = "AVI0000"
EMAIL_PLACEHOLDER = "nao_informado@segurado.com"
EMAIL_PATTERN = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
NOT_INFORMED = "Não informado"

_WHITESPACE = " \t\n\r\x0b\x0c"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(_WHITESPACE))


def nullify(col: Column, sentinels: tuple[str, ...] = BLANK) -> Column:
    """NULL when the trimmed, lower-cased text is one of the sentinels."""
    return F.when(~F.lower(strip(col)).isin(*sentinels), col)


def clamp(col: Column, length: int) -> Column:
    return F.left(col, F.lit(length))


def text_or_null(col: Column, length: int, sentinels: tuple[str, ...] = BLANK) -> Column:
    """Stripped and clamped text, NULL when it says nothing."""
    text = strip(col)
    return F.when(~F.lower(text).isin(*sentinels), clamp(text, length))


def flag01(col: Column) -> Column:
    return F.coalesce(F.upper(strip(col.cast("string"))).isin(*TRUE_WORDS).cast("int"), F.lit(0))


def _by_file_type(col: Column, dpa: int, trc: int, other: int) -> Column:
    code = F.upper(strip(col))
    return F.when(code == "DPA", dpa).when(code == "TRC", trc).otherwise(other)


def file_type_code(col: Column) -> Column:
    return _by_file_type(col, 1, 2, 0)


def party_type_code(col: Column) -> Column:
    return _by_file_type(col, 1, 2, 1)


def to_number(col: Column) -> Column:
    """Decimal or scientific text as double; anything else, NaN and infinity included, is NULL."""
    text = strip(col)
    text = F.when(text.contains("_"), F.regexp_replace(text, "(?<=[0-9])_(?=[0-9])", "")).otherwise(text)
    value = F.when(text.rlike(_NUMBER), text).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def parse_money(col: Column, strip_currency: bool = False) -> Column:
    """Money text as double. A comma marks the decimals and makes dots group separators."""
    text = F.upper(strip(col))
    if strip_currency:
        text = strip(F.regexp_replace(text, r"^R\$", ""))
    plain = F.when(text.contains(","), F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    return to_number(nullify(F.coalesce(plain, text), BLANK_MONEY))


def to_money(col: Column) -> Column:
    return col.try_cast("decimal(18,2)")


def parse_int(col: Column) -> Column:
    """Whole number from text such as '7' or '7.0', cut towards zero; plain digits take the short way."""
    return F.coalesce(col.try_cast("int"), to_number(col).try_cast("int"))


def parse_year(col: Column) -> Column:
    return parse_int(col)


def area_number(col: Column) -> Column:
    """Area code from '11', ' 11 ' or '11.0'."""
    text = strip(F.replace(col, F.lit(".0"), F.lit("")))
    return F.when(text.rlike("^[0-9]+$"), text).try_cast("int")


def clean_phone(phone: Column, area: Column) -> Column:
    """struct(area int, number string).

    Fewer than eight digits is no phone. Ten or eleven digits without a separate
    area carry the area in front; otherwise the number is kept whole.
    """
    area = area.cast("string")
    digits = F.regexp_replace(phone.cast("string"), "[^0-9]", "")
    usable = ~F.lower(phone.cast("string")).isin(*BLANK) & (F.length(digits) >= 8)
    no_area = area.isNull() | area.isin("", "0", "0.0")
    split = no_area & F.length(digits).isin(10, 11)
    code = F.when(split, F.left(digits, F.lit(2)).try_cast("int")).otherwise(area_number(area))
    number = F.when(split, F.substr(digits, F.lit(3))).otherwise(digits)
    return F.struct(F.when(usable, code).alias("area"), F.when(usable, number).alias("number"))


def clean_plate(col: Column) -> Column:
    return F.coalesce(nullify(F.upper(strip(col))), F.lit(PLATE_PLACEHOLDER))


def _tax_digits(col: Column) -> tuple[Column, Column]:
    text = F.replace(col, F.lit(".0"), F.lit(""))
    return text, F.length(F.rtrim(text)) <= 11


def tax_id_type(col: Column) -> Column:
    """1 for a person (up to 11 characters), 2 otherwise and for NULL."""
    return F.when(_tax_digits(col)[1], 1).otherwise(2)


def format_tax_id(col: Column) -> Column:
    """Zero-filled to 11 or 14 characters; the rightmost ones stay."""
    text, person = _tax_digits(col)
    width = F.when(person, 11).otherwise(14)
    return F.right(F.concat(F.repeat(F.lit("0"), width), text), width)


def squash_spaces(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, " {2,}", " "))


def treated_claim(file_sigla: Column, claim: Column) -> Column:
    """Third-party files carry a 'T' behind the claim number."""
    return F.when(file_sigla == "TRC", F.concat(claim, F.lit("T"))).otherwise(claim)


def default_email(col: Column) -> Column:
    return F.when(F.rtrim(col) != "", col).otherwise(F.lit(EMAIL_PLACEHOLDER))


def join_phone(area: Column, number: Column) -> Column:
    """Area and number as one text, NULL if either is missing."""
    return F.concat(area.cast("string"), F.left(number, F.lit(30)))


def _emails(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(EMAIL_PATTERN), F.lit(0))


def first_email(col: Column) -> Column:
    return F.coalesce(F.get(_emails(col), F.lit(0)), F.lit(""))


def dedupe_emails(col: Column) -> Column:
    """Every address once, in order; the text itself when it holds none."""
    found = F.array_distinct(_emails(col))
    return (
        F.when(F.coalesce(col, F.lit("")).isin("", NOT_INFORMED), F.lit(NOT_INFORMED))
        .when(F.size(found) > 0, F.array_join(found, ", "))
        .otherwise(col)
    )


def email_parts(col: Column) -> Column:
    """Addresses of a ';' or ',' separated list, stripped and clamped."""
    parts = F.filter(F.split(col, "[;,]"), lambda part: part.contains("@"))
    return F.transform(parts, lambda part: clamp(strip(part), 150))


def iso_ts(col: Column, default: Column | None = None) -> Column:
    text = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    if default is None:
        return text
    return F.coalesce(text, F.date_format(default, "yyyy-MM-dd'T'HH:mm:ss"))


def iso_text(col: Column) -> Column:
    """The same form from a date already held as text."""
    return F.left(F.replace(col, F.lit(" "), F.lit("T")), F.lit(19))


def to_timestamp(col: Column, sentinels: tuple[str, ...] = BLANK_DATE) -> Column:
    return nullify(col, sentinels).try_cast("timestamp_ntz")


def placeholder(prefix: str, code: Column) -> Column:
    return F.concat(F.lit(prefix + " "), code.cast("string"))


def label_or_placeholder(label: Column, prefix: str, code: Column) -> Column:
    return F.coalesce(text_or_null(label, 100), placeholder(prefix, code))


def is_placeholder(label: Column, prefix: str) -> Column:
    return label.startswith(prefix)


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two stamps (10:00:59 to 10:01:00 is one)."""
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")

    def whole_minutes(col: Column) -> Column:
        return F.timestamp_diff("MINUTE", origin, col)

    return (whole_minutes(end) - whole_minutes(start)).cast("int")

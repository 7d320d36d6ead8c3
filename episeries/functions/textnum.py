"""Text clean-up and parsing of dates and locale-formatted numbers.

Everything here is a built-in expression. Functions that need an intermediate
value more than once, or inside a lambda, bind it with :func:`bind`; otherwise
the optimiser may copy the expression into the lambda and evaluate it per
element.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from episeries.functions.domains import DATE_LEADS, MONTHS

# All Unicode blanks and the separator controls.
BLANKS = r"(?U)[\s\x1c-\x1f]+"
# What may be such a blank, but for the space. Two ranges, as a class of many is slow.
PERHAPS_BLANK = r"[^ -~\xa1-\u024f]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_number(text: Column, kind: str = "long") -> Column:
    """Digits as a number, anything else as NULL.

    The test comes first because a failing cast raises inside the JVM, which
    costs far more than a regex when many values are no numbers.
    """
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(kind))


def iso_date(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")


def month_name_date(text: Column) -> Column:
    """``14JUL2021`` as a date."""
    return F.try_to_date(F.initcap(text), "ddMMMyyyy")


def compact_date(text: Column) -> Column:
    """``20210714`` as a date."""
    return F.try_to_date(text, "yyyyMMdd")


def pdf_creation_date(text: Column) -> Column:
    """Creation stamp of a document, ``D:20210714093000+02'00'``, as a date."""
    return compact_date(F.substring(text, 3, 8))


def normalise(text: Column) -> Column:
    """Drop line feeds, collapse blanks, trim."""
    flat = F.replace(text, F.lit("\n"), F.lit(""))
    other = F.contains(flat, F.lit("  ")) | flat.rlike(PERHAPS_BLANK)
    return F.trim(F.when(other, F.regexp_replace(flat, BLANKS, " ")).otherwise(flat))


def replace_literals(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements, one after the other."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def replace_patterns(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Regex replacements, one after the other."""
    for pattern, new in pairs:
        text = F.regexp_replace(text, pattern, new)
    return text


def replace_words(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements of phrases that stand between blanks."""
    return replace_literals(text, [(f" {old} ", f" {new} ") for old, new in pairs])


def spaced(name: Column) -> Column:
    """Underscores back to blanks."""
    return F.translate(name, "_", " ")


def tokens(text: Column) -> Column:
    """Words of a normalised text."""
    return F.split(text, " ")


def after_last(text: Column, marker: str) -> Column:
    """What follows the last occurrence of ``marker``."""
    return F.substring_index(text, marker, -1)


def at(items: Column, position: int | Column) -> Column:
    """Element by 1-based (or negative) position, NULL beyond the ends."""
    return F.try_element_at(items, F.lit(position) if isinstance(position, int) else position)


def every_second(items: Column, offset: int) -> Column:
    """Elements 0, 2, … (``offset`` 0) or 1, 3, … (``offset`` 1)."""
    return F.filter(items, lambda _, i: i % 2 == offset)


def _without_percent(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("%")), F.regexp_replace(text, "%$", "")).otherwise(text)


def locale_long(text: Column, thousands: str = ".") -> Column:
    """``1.234`` or ``1.234%`` as 1234; NULL if it is no number."""
    plain = F.replace(_without_percent(text), F.lit(thousands), F.lit(""))
    return whole_number(plain)


def locale_double(text: Column, decimal: str = ",", thousands: str | None = None) -> Column:
    """``12,5%`` as 12.5; NULL if it is no number."""
    plain = _without_percent(text)
    if thousands:
        plain = F.replace(plain, F.lit(thousands), F.lit(""))
    plain = F.replace(plain, F.lit(decimal), F.lit("."))
    # A bare cast would also take words such as NaN and suffixes such as 1d.
    # One without a digit is none either, and a failing cast is dear.
    return F.when(plain.rlike(r"^[-+.eE]*[0-9][-+.0-9eE]*$"), plain.try_cast("double"))


def numeric_range(text: Column) -> Column:
    """``(2-5)`` as struct(low, high); both NULL if there is no range."""
    pattern = r"([0-9]+)-([0-9]+)"
    return F.struct(
        whole_number(F.regexp_extract(text, pattern, 1)).alias("low"),
        whole_number(F.regexp_extract(text, pattern, 2)).alias("high"),
    )


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def spanish_date(raw: Column) -> Column:
    """``3 de junio de 2021``, ``3 junio de 2021`` or ``03-06-2021`` as a date."""
    worded = r"(?i)^(\d{1,2})(?: de)? (\p{L}+) de (\d{4})$"
    dashed = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
    month = F.array_position(
        F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(raw, worded, 2))
    )
    from_words = F.concat_ws(
        "-", F.regexp_extract(raw, worded, 3), month, F.regexp_extract(raw, worded, 1)
    )
    from_digits = F.concat_ws(
        "-", *[F.regexp_extract(raw, dashed, g) for g in (3, 2, 1)]
    )
    return F.when(raw.rlike(worded), F.try_to_date(from_words, "yyyy-M-d")).when(
        raw.rlike(dashed), F.try_to_date(from_digits, "yyyy-M-d")
    )


def cover_date(text: Column) -> Column:
    """Date after the first lead phrase (in list order) that the page holds."""
    raw = None
    for lead, skipped in DATE_LEADS:
        quoted = lead.replace(".", r"\.")
        found = F.regexp_extract(text, f"{quoted}.{{{skipped}}}(.*?202.)", 1)
        here = F.contains(text, F.lit(lead))
        raw = F.when(here, found) if raw is None else raw.when(here, found)
    return spanish_date(F.trim(raw))

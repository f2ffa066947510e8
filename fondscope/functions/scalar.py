"""Scalar functions of the analyses, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["digits_only", "to_year", "marc_year", "marc_language", "language_label", "field_link", "subfield_anchor", "group_label", "group_url", "group_text", "size_text", "percent_text", "count_text", "stripped", "http_date", "strip_prefix", "report_title", "xml_safe"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits_only(c) -> Column:
    """ASCII digits and nothing else; unlike `$`, `\\z` doesn't accept a line feed at the end."""
    return _col(c).rlike(r"^[0-9]+\z")


def to_year(c) -> Column:
    """The integer that a text spells; null where it spells none or a too large one."""
    return _col(c).try_cast("int")


def marc_year(c) -> Column:
    return F.substring(_col(c), 8, 4)


def marc_language(c) -> Column:
    return F.substring(_col(c), 36, 3)


def language_label(code, name) -> Column:
    """`code (Name)`, or the code alone where it has no name."""
    code, name = _col(code), _col(name)
    return F.when(name.isNull(), code).otherwise(F.concat(code, F.lit(" ("), name, F.lit(")")))


def _shown(c) -> Column:
    return F.coalesce(_col(c), F.lit("NA"))


def field_link(code, url) -> Column:
    """An HTML anchor on the code where there is a url; else the code."""
    code, url = _col(code), _col(url)
    return F.when(url.isNull() | (url == "NA"), code).otherwise(F.concat(F.lit('<a href="'), url, F.lit('">'), code, F.lit("</a>")))


def subfield_anchor(field, subfield) -> Column:
    return F.concat(F.lit('<a id="'), _col(field), _col(subfield), F.lit('">'), _col(subfield), F.lit("</a>"))


def group_label(url, code, description) -> Column:
    """`url|code: description`, with NA for what is missing."""
    return F.concat(_shown(url), F.lit("|"), _shown(code), F.lit(": "), _shown(description))


def group_url(label) -> Column:
    return F.regexp_extract(_col(label), r"^(.*?)\|", 1)


def group_text(label) -> Column:
    """What follows the first bar; anchored, since every match would be replaced."""
    return F.regexp_replace(_col(label), r"^.*?\|", "")


def size_text(c) -> Column:
    """Bytes in decimal units with one digit at most."""
    c, out = _col(c).cast("double"), None
    for unit, power in (("TB", 12), ("GB", 9), ("MB", 6), ("KB", 3)):
        text = F.concat(F.regexp_replace(F.call_function("format_number", F.round(c / 10.0**power, 1), F.lit("0.0")), r"\.0\z", ""), F.lit(f" {unit}"))
        out = F.when(c >= 10.0**power, text) if out is None else out.when(c >= 10.0**power, text)
    return out.otherwise(F.concat(c.cast("long").cast("string"), F.lit(" B")))


def percent_text(c, places: int = 2) -> Column:
    return F.concat(F.format_number(_col(c) * 100, places), F.lit("%"))


def count_text(c) -> Column:
    return F.format_number(_col(c), 0)


def stripped(c) -> Column:
    """Without white space of any kind at either end (trim removes blanks only)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+\z", "")


def http_date(c) -> Column:
    """`YYYY-MM-DD` of an HTTP date such as `Tue, 15 Nov 1994 08:12:31 GMT`; null where it is none."""
    day = F.try_to_timestamp(F.substring(_col(c), 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.date_format(day, "yyyy-MM-dd")


def strip_prefix(c) -> Column:
    """What follows the characters before the first `<`."""
    return F.regexp_replace(_col(c), r"^[^<]*", "")


def report_title(html, pattern: str = r"(?s)<title>.*?Composition Analysis of the (.*?)</title>") -> Column:
    """What the pattern's group matches over the whole page, stripped; empty where there is none."""
    return stripped(F.regexp_extract(_col(html), pattern, 1))


def xml_safe(c) -> Column:
    out = _col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_MARK = "\u0001 "


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, also after ``-``, ``'`` and digits.

    ``initcap`` only starts words after white space, so a marked blank is put
    behind every non-letter first and taken out again afterwards.
    """
    spaced = F.regexp_replace(F.lower(text), r"([^\p{L}])", "$1" + _MARK)
    return F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))


#: What ``\\s`` matches, and the ends of line before whose last one ``$`` matches too.
_SPACE, _LINE_ENDS = " \t\n\x0b\f\r", ("\u0085", "\u2028", "\u2029")


def trimmed_text(text: Column) -> Column:
    """Without white space at either end; a pattern, ten times as slow, only where an end of line follows that is no white space."""
    odd = text.endswith(_LINE_ENDS[0]) | text.endswith(_LINE_ENDS[1]) | text.endswith(_LINE_ENDS[2])
    return F.when(odd, F.regexp_replace(text, r"^\s+|\s+$", "")).otherwise(F.trim(text, F.lit(_SPACE)))


def standard_text(text: Column, case: str = "title") -> Column:
    """Trim all white space, then apply ``strip``, ``title``, ``upper`` or ``lower``."""
    trimmed = trimmed_text(text)
    if case == "strip":
        return trimmed
    if case == "title":
        return title_case(trimmed)
    if case == "upper":
        return F.upper(trimmed)
    if case == "lower":
        return F.lower(trimmed)
    raise ValueError(f"unknown case {case!r}")


def remap(value: Column, mapping: dict[str, str]) -> Column:
    """Replace known values, leave the rest as they are."""
    if not mapping:
        return value
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)

"""Text cleaning, JVM-side.

NFKC and full case folding come from ICU4J and white-space collapsing from
commons-lang3, both on Spark's own class path, through the public ``reflect``
function. No text crosses to Python. ``reflect`` counts as non-deterministic, so
put its result in a column before grouping or joining on it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: character classes of the cleaning rules ---
CONTROL_CHARS = (
    "\x00\x01\x02\x03\x04\x05\x06\x07\x08\x0b\x0c\x0e\x0f\x10\x11\x12\x13\x14\x15\x16\x17"
    "\x18\x19\x1a\x1b\x1c\x1d\x1e\x1f\x7f"
)
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
URL_PATTERN = (
    r"(?i)(?:https?://|www\.)"
    r"[^\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)
# --- end of fixed values ---

# NEL is white space for the rules but not for the collapsing function.
_TO_SPACE = CONTROL_CHARS + "\x85"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_if_null(value: Column | str) -> Column:
    return F.coalesce(_col(value).cast("string"), F.lit(""))


def null_if_blank(value: Column | str) -> Column:
    value = _col(value)
    return F.when(value != "", value)


def strip(value: Column | str) -> Column:
    """Trim Unicode white space on both sides; missing becomes blank."""
    return F.trim(blank_if_null(value), F.lit(WHITESPACE))


def first_filled(*values: Column | str) -> Column:
    """First value that is not blank, taken before stripping and stripped after."""
    return strip(F.coalesce(*[null_if_blank(v) for v in values], F.lit("")))


def first_filled_stripped(*values: Column | str) -> Column:
    """First value that is not blank once stripped."""
    return F.coalesce(*[null_if_blank(strip(v)) for v in values], F.lit(""))


def nfkc(value: Column | str) -> Column:
    return F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), blank_if_null(value), F.lit(True)
    )


def casefold(value: Column | str) -> Column:
    return F.reflect(
        F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), blank_if_null(value), F.lit(True)
    )


def clean_text(value: Column | str, remove_urls: bool = False) -> Column:
    """NFKC, control characters to spaces, optional URL removal, collapsed white space."""
    # Translating looks every character up, so texts without such a character pass by; NFKC makes none.
    normal = nfkc(value)
    spaced = F.translate(normal, _TO_SPACE, " " * len(_TO_SPACE))
    text = F.when(blank_if_null(value).rlike(f"[{_TO_SPACE}]"), spaced).otherwise(normal)
    if remove_urls:
        text = F.regexp_replace(text, URL_PATTERN, " ")
    return F.reflect(F.lit("org.apache.commons.lang3.StringUtils"), F.lit("normalizeSpace"), text)


def match_form(value: Column | str, case_sensitive: bool = False) -> Column:
    """The form of a text that dictionary terms are looked up in."""
    return clean_text(value) if case_sensitive else casefold(clean_text(value))


def combine_title(title: Column | str, body: Column | str) -> Column:
    """``title body`` unless one is blank or the body already holds the title."""
    title, body = _col(title), _col(body)
    return (
        F.when((title != "") & (body != "") & ~body.contains(title), F.concat_ws(" ", title, body))
        .when(body != "", body)
        .otherwise(title)
    )

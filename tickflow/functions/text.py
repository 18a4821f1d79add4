"""Text and time formatting columns (P7, P14, tokenisation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.isspace`` treats as whitespace,
# in code-point order (TAB..CR, FS..US, SPACE, NEL, NBSP, OGHAM SPACE MARK,
# EN QUAD..HAIR SPACE, LINE SEPARATOR, PARAGRAPH SEPARATOR, NARROW NBSP,
# MEDIUM MATHEMATICAL SPACE, IDEOGRAPHIC SPACE). Java's ``\s`` is ASCII-only,
# so the class is spelled out.
WHITESPACE_CLASS = (r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WHITESPACE_RUN = f"[{WHITESPACE_CLASS}]+"
URL_RUN = f"http[^{WHITESPACE_CLASS}]+"

WORD_TOKEN = "[a-z0-9]+"
SENTIMENT_TOKEN = "[a-z']+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """News text cleaning.

    Missing text becomes ''; URLs (``http`` up to the next whitespace) are
    deleted; newlines become spaces; backslashes are deleted; whitespace runs
    collapse to one space; the ends are stripped.
    """
    t = F.coalesce(_col(c).cast("string"), F.lit(""))
    t = F.regexp_replace(t, URL_RUN, "")
    t = F.regexp_replace(t, "\n", " ")
    t = F.regexp_replace(t, r"\\", "")
    t = F.regexp_replace(t, WHITESPACE_RUN, " ")
    return F.trim(t)


def tokens(c, pattern: str = WORD_TOKEN) -> Column:
    """Lower-case tokens of a text: every match of ``pattern`` in order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(pattern), 0)


def iso_format(c) -> Column:
    """ISO-8601 text of a zone-less timestamp, microseconds only when non-zero."""
    ts = _col(c)
    return (F.when(ts.isNull(), F.lit(None).cast("string"))
            .when(F.date_format(ts, "SSSSSS") == "000000",
                  F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))

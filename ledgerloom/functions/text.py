"""Text expressions: HTML to text, words, search terms, order ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.scripts import HAS_SPACELESS, TERM

BLANKS = r"[ \t\n\r]+"
NON_TERM = r"[^\p{L}\p{N}]+"
SCRIPTS = r"(?is)<(script|style)[^>]*>.*?</(script|style)>"
TAGS = r"(?s)<[^>]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
ORDER_ID = r"(?:^|[^0-9A-Za-z])ORD-([0-9]+)"


def squeeze(text: Column) -> Column:
    """One blank between words, none at the ends."""
    # To find such blanks is much cheaper than to write a text anew.
    untidy = reduce(Column.__or__, [F.contains(text, F.lit(b)) for b in ("\t", "\n", "\r", "  ")])
    return F.trim(F.when(untidy, F.regexp_replace(text, BLANKS, " ")).otherwise(text))


def html_to_text(html: Column) -> Column:
    """Text of an HTML page: scripts, styles and tags become blanks.

    Character references (``&amp;``) are not decoded.
    """
    return squeeze(F.regexp_replace(F.regexp_replace(html, SCRIPTS, " "), TAGS, " "))


def html_title(html: Column) -> Column:
    """Content of the first ``title`` element, empty if there is none."""
    return squeeze(F.regexp_extract(html, TITLE, 1))


def words(text: Column) -> Column:
    """Words as written, split at blanks."""
    return F.filter(F.split(F.trim(text), BLANKS), lambda w: w != "")


def terms(text: Column) -> Column:
    """Search terms, with repeats: lower-case runs of letters and digits.

    Scripts written without blanks have no such runs: there every two neighbouring
    characters of one script are a term, and a character without a neighbour is.
    """
    spaced = F.filter(F.split(F.lower(text), NON_TERM), lambda t: t != "")
    pairs = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(1))
    return F.when(text.rlike(HAS_SPACELESS), pairs).otherwise(spaced)


def parse_order_id(text: Column) -> Column:
    """The number after the first ``ORD-``; null if absent or beyond 64 bits."""
    return F.regexp_extract(text, ORDER_ID, 1).try_cast("bigint")

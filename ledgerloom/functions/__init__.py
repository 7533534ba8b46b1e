"""Column expressions. Nothing here starts a job."""

from ledgerloom.functions.dates import shifted_between
from ledgerloom.functions.names import user_slug
from ledgerloom.functions.text import html_title, html_to_text, parse_order_id, terms, words

__all__ = [
    "html_title",
    "html_to_text",
    "parse_order_id",
    "shifted_between",
    "terms",
    "user_slug",
    "words",
]

from quirefold.functions.dates import in_date_range, parse_date, parse_iso_argument
from quirefold.functions.hashing import content_hash, document_id, source_hash
from quirefold.functions.text import clean_text, html_to_text, strip_ws, token_estimate

__all__ = [
    "clean_text", "content_hash", "document_id", "html_to_text", "in_date_range", "parse_date",
    "parse_iso_argument", "source_hash", "strip_ws", "token_estimate",
]

"""String functions as native Columns: paths, URIs, whitespace, tokens, UTF-8."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.constants import USER_SLUG_CHARS

# The characters str.strip() and str.split() treat as white space: Unicode's, which Java
# tests in one lookup, and the four separators x1c to x1f.
SPACE = r"[\s\x1c-\x1f]"
UNICODE = "(?U)"
# --- fixed values: the same characters one by one
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
EXTENSION = r"[^/.][^/]*(\.[^./]*)\z"

# URI path, step by step: what is dropped, in this order.
URI_LEADING = r"^[\x00-\x20]+"
URI_BREAKS = r"[\t\r\n]"
URI_TAIL = r"(?s)[?#].*\z"
URI_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
URI_HOST = r"^//[^/]*"
URI_PARAMS = r";[^/]*\z"
URI_SLASHES = r"^/+"
# --- fixed values: schemes whose last path segment may carry ;parameters (or no scheme at all)
URI_WITH_PARAMS = (
    r"(?i)^(http|https|ftp|sftp|hdl|prospero|shttp|rtsp|rtsps|rtspu|sip|sips|mms|tel):"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def user_slug(email: Column | str, max_chars: int = USER_SLUG_CHARS) -> Column:
    """``First.Last@example.com`` -> ``firstlast``, at most ``max_chars`` long."""
    local = F.split_part(_col(email), F.lit("@"), F.lit(1))
    return F.substring(F.lower(F.replace(local, F.lit("."), F.lit(""))), 1, max_chars)


def extension(path: Column | str) -> Column:
    """Suffix from the last dot of the last segment; ``''`` if none. Case is kept."""
    return F.regexp_extract(_col(path), EXTENSION, 1)


def doc_uri(path: Column | str) -> Column:
    """Path of a URL without scheme, host, parameters, query, fragment, leading ``/``.

    Built from replacements because ``parse_url`` gives NULL for names with spaces.
    """
    raw = F.regexp_replace(F.regexp_replace(_col(path), URI_LEADING, ""), URI_BREAKS, "")
    cut = F.regexp_replace(raw, URI_TAIL, "")
    bare = F.regexp_replace(F.regexp_replace(cut, URI_SCHEME, ""), URI_HOST, "")
    has_params = cut.rlike(URI_WITH_PARAMS) | ~cut.rlike(URI_SCHEME)
    bare = F.when(has_params, F.regexp_replace(bare, URI_PARAMS, "")).otherwise(bare)
    return F.regexp_replace(bare, URI_SLASHES, "")


def flag_test(text: Column | str) -> Column:
    """``test`` if the text holds that word in lower case anywhere, else ``not test``."""
    return F.when(F.contains(_col(text), F.lit("test")), F.lit("test")).otherwise(F.lit("not test"))


def strip(text: Column | str) -> Column:
    """Cut all white space at both ends (``trim`` cuts spaces only), in one look at each end."""
    return F.btrim(_col(text), F.lit(SPACE_CHARACTERS))


def squeeze_blank_lines(text: Column | str) -> Column:
    """Strip, then turn three or more line breaks in a row into two."""
    return F.regexp_replace(strip(text), r"\n{3,}", "\n\n")


def utf8_text(content: Column | str) -> Column:
    """Bytes as text, NULL where they are not valid UTF-8."""
    return F.try_validate_utf8(_col(content).cast("string"))


def unquote(name: Column | str) -> Column:
    """Identifier without its backticks."""
    return F.replace(_col(name), F.lit("`"), F.lit(""))


def tokens(text: Column | str) -> Column:
    """White-space tokens in order, empty pieces left out."""
    return F.array_remove(F.split(_col(text), UNICODE + SPACE + "+"), "")


def ordered_join(order: Column | str, text: Column | str, sep: str = "\n") -> Column:
    """Aggregate: the texts of a group joined by ``sep`` in order of ``order``.

    The result is one string, so a group is never larger than one value may be.
    """
    parts = F.array_sort(F.collect_list(F.struct(_col(order).alias("o"), _col(text).alias("t"))))
    return F.array_join(F.transform(parts, lambda p: p["t"]), sep)

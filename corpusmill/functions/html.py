"""HTML to Markdown with ATX headings as one chain of native replacements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import squeeze_blank_lines

DROPPED_ELEMENTS = ("script", "style")

# --- fixed values: named references; the ampersand comes last so that &amp;lt; reads &lt;
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&trade;", "™"),
    ("&middot;", "·"),
    ("&bull;", "•"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&lsquo;", "‘"),
    ("&rsquo;", "’"),
    ("&ldquo;", "“"),
    ("&rdquo;", "”"),
    ("&laquo;", "«"),
    ("&raquo;", "»"),
    ("&times;", "×"),
    ("&deg;", "°"),
    ("&euro;", "€"),
    ("&pound;", "£"),
    ("&amp;", "&"),
]


def markdown_steps(dropped: tuple[str, ...] = DROPPED_ELEMENTS) -> list[tuple[str, str]]:
    """(pattern, replacement) in the order they apply; groups are written ``$n``.

    Order matters for malformed pages: scripts that hold literal tags go before any
    tag is read, block tags become line breaks before the remaining tags are dropped.
    An element is dropped up to its own closing tag; without one its content stays.
    """
    steps = [(rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", "") for name in dropped]
    steps.append((r"(?s)<!--.*?-->", ""))
    steps += [(rf"(?i)<h{n}\b[^>]*>", "\n\n" + "#" * n + " ") for n in range(1, 7)]
    steps += [
        (r"(?i)</h[1-6]\s*>", "\n\n"),
        (r'(?is)<img\b[^>]*\balt\s*=\s*"([^"]*)"[^>]*\bsrc\s*=\s*"([^"]*)"[^>]*>', "![$1]($2)"),
        (r'(?is)<img\b[^>]*\bsrc\s*=\s*"([^"]*)"[^>]*\balt\s*=\s*"([^"]*)"[^>]*>', "![$2]($1)"),
        (r'(?is)<img\b[^>]*\bsrc\s*=\s*"([^"]*)"[^>]*>', "![]($1)"),
        (r'(?is)<a\s[^>]*href\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', "[$2]($1)"),
        (r"(?is)<a\s[^>]*href\s*=\s*'([^']*)'[^>]*>(.*?)</a\s*>", "[$2]($1)"),
        (r"(?is)<pre\b[^>]*>\s*<code\b[^>]*>(.*?)</code\s*>\s*</pre\s*>", "\n\n```\n$1\n```\n\n"),
        (r"(?is)<pre\b[^>]*>(.*?)</pre\s*>", "\n\n```\n$1\n```\n\n"),
        (r"(?is)</?code\b[^>]*>", "`"),
        (r"(?is)</?(b|strong)\b[^>]*>", "**"),
        (r"(?is)</?(i|em)\b[^>]*>", "*"),
        (r"(?i)<li\b[^>]*>", "\n* "),
        (r"(?i)<hr\b[^>]*>", "\n\n---\n\n"),
        (r"(?i)<tr\b[^>]*>", "\n| "),
        (r"(?i)</t[dh]\s*>", " | "),
        (r"(?i)</?(p|div|article|section|header|footer|nav|main|title|ul|ol|br|table|blockquote)\b[^>]*>", "\n\n"),
        (r"(?s)<[^>]*>", ""),
    ]
    return steps


def _numeric_references(text: Column) -> Column:
    """``&#8211;`` and ``&#x2013;`` as their characters; what is no character stays as it is."""

    def decoded(part: Column) -> Column:
        number = F.regexp_extract(part, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        code = F.when(number.rlike("^[xX]"), F.substr(number, F.lit(2))).otherwise(F.hex(number.try_cast("long")))
        code = F.lpad(F.upper(code), 8, "0")
        valid = (number != "") & (code <= "0010FFFF") & ~code.between("0000D800", "0000DFFF") & (code != "00000000")
        char = F.decode(F.unhex(F.when(valid, code)), "UTF-32")
        return F.when(valid, F.concat(char, F.substr(part, F.length(number) + 2))).otherwise(F.concat(F.lit("&#"), part))

    parts = F.split(text, "&#")
    read = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), decoded), ""))
    return F.when(F.contains(text, F.lit("&#")), read).otherwise(text)


def html_to_markdown(html: Column | str, dropped: tuple[str, ...] = DROPPED_ELEMENTS) -> Column:
    """Markdown of an HTML page. ``dropped`` names elements left out with their content."""
    col = F.col(html) if isinstance(html, str) else html
    col = reduce(lambda c, s: F.regexp_replace(c, *s), markdown_steps(dropped), col)
    col = _numeric_references(col)
    col = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, col)
    lines = F.transform(F.split(col, "\n"), lambda line: F.btrim(line, F.lit(" \t")))
    return squeeze_blank_lines(F.array_join(lines, "\n"))

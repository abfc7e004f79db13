"""Text cleanup functions (B7-B14, B19-B20, B23, B30-B38) as Column expressions.

Regex notes: Java needs ``(?d)`` so that ``.`` stops only at ``\\n`` (as in
Python) and ``(?U)`` for Unicode ``\\s``/``\\d``/``\\w``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Catalyst does not share a sub-expression across the branches of a CASE,
    so an expensive value referenced three times is computed three times;
    binding it to a lambda variable computes it once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c) -> Column:
    """Python-style strip of Unicode whitespace (``trim`` strips spaces only)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def split_cell(c) -> Column:
    """B7: '100200/300400 (note) or see card' -> ['100200', '300400'].

    Parentheses are removed first, then everything from the word "or" (D7),
    then '/', ' ' and ',' all separate; blanks are dropped.  Null -> [].
    """
    v = F.regexp_replace(_c(c), r"(?d)\(.*?\)", "")
    v = F.regexp_replace(v, r"(?id)\bor\b.*", "")
    parts = F.split(v, r"[ ,/]+", -1)
    return F.coalesce(F.filter(F.transform(parts, lambda x: strip(x)), lambda x: x != ""),
                      F.array().cast("array<string>"))


# Characters that make a cell "symbols only" (D6 intended set).
SYMBOL_ONLY = r"^[#&\\:\-]+$"


def blank_symbols(c) -> Column:
    """A value made only of '#', '&', '\\', '-', ':' becomes ''."""
    col = _c(c)
    return F.when(col.rlike(SYMBOL_ONLY), F.lit("")).otherwise(col)


def zero_for_slashed_o(c) -> Column:
    """B9: 'Ø' -> '0'."""
    return F.translate(_c(c), "Ø", "0")


def clean_name(c) -> Column:
    """Lower, drop (...) groups, keep ASCII letters/digits/whitespace, squeeze, trim."""
    v = F.lower(_c(c))
    v = F.regexp_replace(v, r"(?d)\(.*?\)", "")
    v = F.regexp_replace(v, r"(?U)[^a-zA-Z0-9\s]", "")
    v = F.regexp_replace(v, r"(?U)\s+", " ")
    return strip(v)


def expand_abbreviations(c, mapping: Column) -> Column:
    """Replace each space-separated token found in ``mapping`` (a map column)."""
    toks = F.filter(F.split(_c(c), r"\s+", -1), lambda t: t != "")
    return F.array_join(F.transform(toks, lambda t: F.coalesce(F.try_element_at(mapping, t), t)), " ")


def strip_code_fences(c) -> Column:
    """Drop a leading ```json / ``` and a trailing ```, stripping around them."""
    v = strip(_c(c))
    v = strip(F.regexp_replace(v, r"^```json", ""))
    v = strip(F.regexp_replace(v, r"^```", ""))
    return strip(F.regexp_replace(v, r"```$", ""))


def outer_brackets(c) -> Column:
    """The outermost [...] span of noisy text, else the text itself."""
    return let(_c(c), lambda x: let(F.regexp_extract(x, r"(?s)\[.*\]", 0),
                                    lambda hit: F.when(hit != "", hit).otherwise(x)))


def url_type(c) -> Column:
    """B19: 'pdf' / 'excel' / null by the URL text."""
    u = F.lower(_c(c))
    return (F.when(u.contains(".pdf"), F.lit("pdf"))
            .when(u.contains(".xls"), F.lit("excel")))


def file_name_from_url(c, prefix: Column | None = None) -> Column:
    """Last path segment, query string and fragment cut; optional '<prefix>_' before it."""
    path = F.regexp_replace(_c(c), r"[?#].*$", "")
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return name if prefix is None else F.concat_ws("_", prefix, name)


def prefix_when(c, marker: str, prefix: str) -> Column:
    """Prefix a value that starts with ``marker``; other values unchanged."""
    col = _c(c)
    return F.when(col.startswith(marker), F.concat(F.lit(prefix), col)).otherwise(col)


# The four layouts that make a page look like a table (B30),
# matched multiline and case-insensitive.
TABLE_PATTERNS = (
    r"BIN.*PCN.*COMBINATIONS",
    r"BIN\s+Processor\s+Control\s+Number",
    r"^\s*BIN\s+.*\s+Note\s*$",
    r"^\s*\d{5,6}\s+[A-Z]{2,}\s*$",
)


def looks_like_table(c, patterns=TABLE_PATTERNS) -> Column:
    col = _c(c)
    out = F.lit(False)
    for p in patterns:
        out = out | F.coalesce(col.rlike("(?imd)" + p), F.lit(False))
    return out


def clean_bin(c) -> Column:
    """First run of 5-6 digits, else null."""
    return F.nullif(F.regexp_extract(_c(c), r"(\d{5,6})", 1), F.lit(""))


def clean_pcn(c, max_len: int = 15) -> Column:
    """Blank when longer than ``max_len`` or containing whitespace."""
    col = _c(c)
    return F.when((F.length(col) > max_len) | col.rlike(r"\s"), F.lit("")).otherwise(col)


def clean_grp(c, words_regex: str) -> Column:
    """Blank when the value holds descriptive words (case-insensitive)."""
    col = _c(c)
    return F.when(col.rlike("(?i)" + words_regex), F.lit("")).otherwise(col)


def labelled_value(c, label: str) -> Column:
    """Value after ``Label:`` on its own line, else null."""
    import re
    hit = F.regexp_extract(_c(c), r"(?m)^\s*" + re.escape(label) + r":\s*(.*?)\s*$", 1)
    return F.nullif(hit, F.lit(""))


def page_number_from_name(c) -> Column:
    """N of a split-page name ending in '_page_<N>.pdf'; -1 when absent."""
    hit = F.regexp_extract(_c(c), r"_page_(\d+)\.pdf$", 1)
    return F.coalesce(F.nullif(hit, F.lit("")).try_cast("int"), F.lit(-1))


def grid_text(grid) -> Column:
    """Cells joined by ' | ', rows by newline."""
    return F.array_join(F.transform(_c(grid), lambda r: F.array_join(r, " | ")), "\n")


def page_text(text, grid) -> Column:
    """The grid text when the grid has more than one row, else the page text."""
    return F.when(F.coalesce(F.size(_c(grid)), F.lit(0)) > 1, grid_text(grid)).otherwise(_c(text))


# Page parts that are not shown, tags that don't part words, and named character references.
HIDDEN_TAGS = ("script", "style", "head", "noscript", "template")
HIDDEN_PARTS = rf"(?is)<!--.*?(?:-->|$)|<({'|'.join(HIDDEN_TAGS)})\b[^>]*>.*?(?:</\1\s*>|$)"
UNICODE_SPACES = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
INLINE_TAGS = r"(?i)</?(?:a|abbr|b|code|em|font|i|mark|s|small|span|strong|sub|sup|u)\b[^>]*>"
REFERENCES = {"nbsp": " ", "copy": "©", "middot": "·", "reg": "®", "trade": "™", "ndash": "–", "mdash": "—",
              "hellip": "…", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "quot": '"', "apos": "'",
              "lt": "<", "gt": ">", "amp": "&"}


def visible_text(html) -> Column:
    """All text that a page shows, in order: no comments, head, scripts or styles; block tags part words, inline
    tags don't; paragraphs need no closing tag; white space is squeezed.  '' for an empty page, null for null."""
    v = F.regexp_replace(_c(html), HIDDEN_PARTS, " ")
    v = F.regexp_replace(F.regexp_replace(v, INLINE_TAGS, ""), r"(?s)</?[A-Za-z!][^>]*(?:>|$)", " ")
    # numeric references, decimal and hexadecimal: each piece behind a '&#' starts with one
    pieces = F.split(v, "&#", -1)

    def decoded(piece: Column) -> Column:
        code = F.coalesce(F.nullif(F.regexp_extract(piece, r"^(\d{1,7});", 1), F.lit("")).cast("int"),
                          F.conv(F.nullif(F.regexp_extract(piece, r"^[xX]([0-9A-Fa-f]{1,6});", 1), F.lit("")), 16, 10).cast("int"))
        ok = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        # the code point's four UTF-32 bytes
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(ok, F.concat(char, F.regexp_replace(piece, r"^[xX]?[0-9A-Fa-f]+;", ""))).otherwise(F.concat(F.lit("&#"), piece))

    v = let(pieces, lambda ps: F.concat(F.element_at(ps, 1), F.array_join(F.transform(F.slice(ps, 2, F.greatest(F.size(ps) - 1, F.lit(0))), decoded), "")))
    for name, char in REFERENCES.items():
        v = F.replace(v, F.lit(f"&{name};"), F.lit(char))
    return strip(F.regexp_replace(v, r"(?U)\s+", " "))

"""HTML character references, decoded as browsers do, by built-in functions alone."""

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from wortfund.functions.markup import bind_sql, let

# What is looked at: a number, or up to 32 characters that may start with a name.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_UNKNOWN = "\ufffd"


def _windows(byte: int) -> str:
    try:
        return bytes([byte]).decode("windows-1252")
    except UnicodeDecodeError:
        return chr(byte)


#: What numbers 0x80 to 0x9f stand for.
_WINDOWS = "".join(map(_windows, range(0x80, 0xA0)))
#: Names that need no semicolon, the longest first: what follows them is text.
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))


#: Names that nearly all references have: a look into this short list saves most looks into the long one.
_FREQUENT = ["amp;", "nbsp;", "lt;", "gt;", "quot;", "ndash;", "mdash;", "middot;", "copy;"]


def _names() -> Column:
    # constants, as the rules of markup.py
    frequent = F.from_json(F.lit(json.dumps({name: html5[name] for name in _FREQUENT})), "map<string, string>")
    names = F.from_json(F.lit(json.dumps(html5)), "map<string, string>")
    bare = F.from_json(F.lit(json.dumps(_BARE)), "array<string>")
    return F.struct(frequent.alias("frequent"), names.alias("names"), bare.alias("bare"))


#: SQL of the character of a number n; its UTF-32 form is the number itself.
_FROM_NUMBER = f"""CASE
  WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN '{_UNKNOWN}'
  WHEN n BETWEEN 128 AND 159 THEN substring('{_WINDOWS}', cast(n - 127 AS int), 1)
  WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n & 65534 = 65534 THEN ''
  ELSE decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32') END"""


def _numeric() -> str:
    """SQL: the character of a reference r that starts with "&#". More than ten digits are beyond any character."""
    value = let("cast(conv(right(digits, 10), IF(hexa, 16, 10), 10) AS bigint)", "n", _FROM_NUMBER)
    value = f"IF(length(digits) > 10, '{_UNKNOWN}', {value})"
    value = let("regexp_replace(rtrim(';', substring(r, IF(hexa, 4, 3))), '^0+(?=.)', '')", "digits", value)
    return let("lower(substring(r, 3, 1)) = 'x'", "hexa", value)


def _named() -> str:
    """SQL: reference r by its whole name; else by the longest name without semicolon that it starts with; else as it stands."""
    rest = let("get(filter(s.known.bare, b -> startswith(name, b)), 0)", "b", "concat(try_element_at(s.known.names, b), substring(name, length(b) + 1))")
    return let("substring(r, 2)", "name", f"coalesce(try_element_at(s.known.frequent, name), try_element_at(s.known.names, name), {rest}, r)")


def unescape_html(text: Column) -> Column:
    """The text with its character references decoded, once: what a decoded one forms with its neighbours stays.

    The distinct references of a text are decoded, and put in their places in one pass from left to right.
    """
    use = (
        f"array_join(transform(split(s.t, r'{_REFERENCE}', -1), (p, i) -> IF(i = 0, p, "
        "concat(get(decoded, cast(array_position(distinct_ones, get(found, i - 1)) AS int) - 1), p))), '')"
    )
    use = let(f"transform(distinct_ones, r -> IF(startswith(r, '&#'), {_numeric()}, {_named()}))", "decoded", use)
    use = let("array_distinct(found)", "distinct_ones", use)
    use = let(f"regexp_extract_all(s.t, r'{_REFERENCE}', 0)", "found", use)
    return bind_sql(F.struct(text.alias("t"), _names().alias("known")), "s", f"IF(contains(s.t, '&'), {use}, s.t)")

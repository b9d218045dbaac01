"""SQL texts that state the expected result of each query over the given tables."""

from wortfund.functions import rules as R
from wortfund.plans.fixtures import MARKUP, MARKUP_END, TITLE_PATTERN
from wortfund.sources.lists import default_stopword_list

# How deep markup nests in the given data at most.
DEPTH = 8


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def fold(column: str, rules) -> str:
    for _, pattern, replacement in rules:
        pattern = pattern.replace("(?md)", "(?m)")
        replacement = replacement.replace("$", "\\")
        column = f"regexp_replace({column}, {text(pattern)}, {text(replacement)}, 'g')"
    return column


ARTICLES = "SELECT doc_id AS docid, 'T' || doc_id AS title, text AS wikitext FROM documents"
PAGE_ARTICLES = (
    f"SELECT page_id AS docid, regexp_extract(html, {text(TITLE_PATTERN)}, 1) AS title, "
    "html AS wikitext FROM pages"
)


def _markup() -> str:
    column = "text"
    for found, put in MARKUP:
        column = f"replace({column}, {text(found)}, {text(put)})"
    return (
        f"SELECT doc_id AS docid, {column} || {text(MARKUP_END)} AS body FROM documents "
        "UNION ALL SELECT -1 - page_id, html FROM pages"
    )


MARKUP_SQL = _markup()


def _templates(column):
    return fold(column, [("", R.TEMPLATE_PATTERN, R.TEMPLATE_MARKER)] * DEPTH)


def _nested(column):
    # No look-ahead here: mark the tags of one name by control characters, so that "holds no tag
    # of that name" is a character class; then put back what found no partner.
    for tag in R.NESTED_TAGS:
        marks = [("", f"(<{tag}(>| [^>]*>))", "\x01$1\x03"), ("", f"</{tag}>", "\x02")]
        pairs = [("", "\x01[^\x01\x02\x03]*\x03([^\x01\x02]*)\x02", "$1")] * DEPTH
        rest = [("", "[\x01\x03]", ""), ("", "\x02", f"</{tag}>")]
        column = fold(column, marks + pairs + rest)
    return column


def _unescape(column):
    # The only entities of the given tables; the ampersand last. All four are old names, which
    # HTML decodes without their semicolon too (some given pages are cut there).
    names = [("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")]
    return fold(column, [("", f"&{name};?", char) for name, char in names])


def _line(kind):
    return lambda column: fold(f"rtrim({column}, '\n')", [R.LINE_RULES[kind]])


def _rules(rules):
    return lambda column: fold(column, rules)


STEPS = {
    "clean_templates": _templates,
    "clean_wiki_tables": _rules(R.WIKI_TABLE_RULES),
    "clean_drop_tags": _rules(R.COMMENT_RULES + R.DROP_ELEMENT_RULES + R.DROP_TAG_RULES),
    "clean_keep_tags": _rules(R.KEEP_ELEMENT_RULES),
    "clean_nested_tags": _nested,
    "clean_internal_links": _rules(R.INTERNAL_LINK_RULES),
    "clean_bold_italic": _rules(R.BOLD_ITALIC_RULES),
    "clean_line_breaks": _rules(R.LINE_BREAK_RULES),
    "clean_external_links": _rules(R.EXTERNAL_LINK_RULES),
    "clean_special_links": _rules(R.SPECIAL_LINK_RULES),
    "clean_unescape_html": _unescape,
    "clean_line_hr": _line("hr"),
    "clean_line_ul": _line("ul"),
    "clean_line_ol": _line("ol"),
    "clean_line_redirect": _line("redirect"),
    "clean_line_definition": _line("definition"),
    "clean_line_term": _line("term"),
    "clean_spaces": _rules(R.SPACE_RULES),
    "clean_newlines": _rules(R.NEWLINE_RULES),
}
HEADINGS = _line("heading")


def step(name: str) -> str:
    return f"SELECT docid, {STEPS[name]('body')} AS body FROM ({MARKUP_SQL})"


def cleaned(source: str = MARKUP_SQL) -> str:
    """All steps in order, one common table per step."""
    names = list(STEPS)
    parts = [f"s0 AS ({source})"] + [
        f"s{i + 1} AS MATERIALIZED (SELECT docid, {STEPS[name]('body')} AS body FROM s{i})"
        for i, name in enumerate(names)
    ]
    return f"WITH {', '.join(parts)} SELECT docid, body FROM s{len(names)}"


def plain(column: str) -> str:
    return f"regexp_extract_all({column}, {text(R.TOKEN_PATTERN)})"


def display(column: str) -> str:
    return plain(f"replace({HEADINGS(column)}, {text(R.TEMPLATE_MARKER)}, ' ')")


def keys(column: str) -> str:
    return f"list_transform({display(column)}, lambda x: lower(x))"


STOPWORDS = "(VALUES " + ", ".join(f"({text(w)})" for w in default_stopword_list()) + ") s(word)"


def positions(source: str, body: str, stop: bool = True) -> str:
    """(word, docid, occurence) of a query that yields docid and `body`."""
    where = f" WHERE word NOT IN (SELECT word FROM {STOPWORDS})" if stop else ""
    return (
        f"SELECT word, docid, CAST(occurence AS INTEGER) AS occurence FROM ("
        f"SELECT docid, unnest(l) AS word, generate_subscripts(l, 1) - 1 AS occurence "
        f"FROM (SELECT docid, {keys(body)} AS l FROM ({source}))){where}"
    )


POSITIONS = positions(ARTICLES, "wikitext")


def postings(source: str = POSITIONS) -> str:
    """(word, docid, occurences); the list as text."""
    return (
        "SELECT word, docid, string_agg(occurence, ',' ORDER BY occurence) AS occurences "
        f"FROM ({source}) GROUP BY word, docid"
    )


POSTINGS = postings()


def by_term(source: str = POSTINGS, docids: int = 200_000) -> str:
    return (
        f"SELECT word, CAST((docid - ((docid % {docids}) + {docids}) % {docids}) // {docids} AS BIGINT) AS chunk, "
        "string_agg(docid || ':' || occurences, ';' ORDER BY docid) AS inv_index "
        f"FROM ({source}) GROUP BY ALL"
    )


BY_TERM = by_term()


def counts(table: str, keys: str, column: str) -> str:
    """(key, n) for every key of a one-column query."""
    return (
        f"SELECT k.{column}, count(t.{column}) AS n "
        f"FROM (SELECT DISTINCT {column} FROM ({keys})) k "
        f"LEFT JOIN ({table}) t ON t.{column} = k.{column} GROUP BY k.{column}"
    )

"""Tag names and patterns of the markup that is removed, in the order they apply.

A rule is (literal, pattern, replacement). A text that does not hold the literal cannot match the
pattern, so the regular expression runs only on texts that do.
"""

TEMPLATE_MARKER = "|TEMPLATE|"

# Elements removed together with their content.
DROP_TAGS = [
    "table", "gallery", "math", "code", "syntaxhighlight", "score", "noinclude", "onlyinclude",
    "includeonly", "categorytree", "ce", "graph", "hiero", "imagemap", "indicator", "inputbox",
    "math chem", "ref", "references", "source", "timeline", "templatedata", "time", "var", "ruby",
    "rb", "dl", "ol", "ul",
]

# Elements whose tags go and whose content stays. `s` stands twice: the second run is only
# visible where it nests in itself.
KEEP_TAGS = [
    "h1", "h2", "h3", "h4", "h5", "h6", "small", "blockquote", "sup", "sub", "u", "del", "ins",
    "s", "p", "abbr", "b", "bdi", "bdo", "cite", "data", "dfn", "em", "i", "kbd", "mark", "q",
    "samp", "strong", "big", "center", "font", "s", "tt", "div", "poem", "pre",
]

# Elements that may hold themselves.
NESTED_TAGS = ["nowiki", "span", "div"]

# Content of these does not cross a line end.
ONE_LINE_TAGS = {"q"}
# An attribute holding a slash keeps these from matching.
NO_SLASH_TAGS = {"ref"}


def _open_tag(tag, stop=">"):
    # The attributes end at the first ">": a later one could only give the same match.
    return f"<{tag}(>| [^{stop}]*>)"


def _drop_rule(tag):
    stop = "/>" if tag in NO_SLASH_TAGS else ">"
    return f"</{tag}>", f"(?s){_open_tag(tag, stop)}.*?</{tag}>", ""


def _keep_rule(tag):
    if tag in ONE_LINE_TAGS:
        line_end = r"\n\r\x{85}\x{2028}\x{2029}"
        return f"</{tag}>", f"{_open_tag(tag, '>' + line_end)}([^{line_end}]*?)</{tag}>", "$2"
    return f"</{tag}>", f"(?s){_open_tag(tag)}(.*?)</{tag}>", "$2"


COMMENT_RULES = [("-->", r"(?s)<!--.*?-->", "")]

DROP_ELEMENT_RULES = [_drop_rule(tag) for tag in DROP_TAGS]

# Single tags, after the elements.
DROP_TAG_RULES = [
    ("<b/>", r"<b/>", ""),
    ("<ref", r"<ref(/>| [^<>]*?/>)", ""),
    ("<references", r"<references(/>| [^<>]*?/>)", ""),
    ("<hr>", r"<hr>", ""),
    ("<wbr>", r"<wbr>", ""),
    ("<nowiki />", r"<nowiki />", ""),
]

KEEP_ELEMENT_RULES = [_keep_rule(tag) for tag in KEEP_TAGS]

WIKI_TABLE_RULES = [("|}", r"(?s)\{\|.*?\|\}", " ")]

INTERNAL_LINK_RULES = [
    ("]]", r"\[\[[^\]:]*?\|(.*?)\]\]", "$1"),
    ("]]", r"\[\[(([^\]\[\|: ]*? [^\]\[\|]*?)|([^\]\[\|: ]*?))\]\]", "$1"),
]

BOLD_ITALIC_RULES = [("'''", r"'''", ""), ("''", r"''", "")]

LINE_BREAK_RULES = [("br", r"(<br(>| />|/>|.>))|(</br>)", " ")]

# A match takes one character on each side along, so a second run catches the links
# whose left neighbour went with the link before.
EXTERNAL_LINK_RULES = [
    ("]", r"(^|[^\[])\[[^\[\]]*? ([^\[\]]*?)\]([^\]]|$)", "$1$2$3"),
] * 2

SPECIAL_LINK_RULES = [("]]", r"\[\[[^\]\[ ]*:[^\]\[]*\]\]", "")]

SPACE_RULES = [("  ", r" {2,}", " ")]

NEWLINE_RULES = [("\n\n\n", r"\n{3,}", "\n\n")]

# Lines that are blanked. (?md): "^" and "$" stand at "\n" only.
_REST_OF_LINE = r"[^\n\r\x{85}\x{2028}\x{2029}]*[\r\x{85}\x{2028}\x{2029}]?$"
LINE_RULES = {
    "hr": ("----", r"(?md)^----[^A-Za-z0-9\n]*$", ""),
    "ul": ("*", r"(?md)^\*[^A-Za-z0-9\n]*$", ""),
    "ol": ("#", r"(?md)^#[^A-Za-z0-9\n]*$", ""),
    "redirect": ("#REDIRECT", r"(?md)^#REDIRECT" + _REST_OF_LINE, ""),
    "definition": (":", r"(?md)^:[^A-Za-z0-9\n]*$", ""),
    "term": (";", r"(?md)^;[^A-Za-z0-9\n]*$", ""),
    "heading": ("=", r"(?md)^=" + _REST_OF_LINE, ""),
}

TEMPLATE_PATTERN = r"\{\{[^{}]*\}\}"

TOKEN_PATTERN = r"\p{L}+|\p{N}+"

# A text of ASCII, of Latin letters that one other letter stands for in lower case, and of general punctuation. The quantifier takes
# no character back, so the text is gone through once.
LOWERED_WHOLE = r"\A[\x00-\u012f\u2000-\u206f]*+\z"

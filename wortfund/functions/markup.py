"""Cleaning steps as Column -> Column. Each runs in the JVM, over the whole text."""

import json
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from wortfund.functions import rules as R


def bind(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rule_table(rules) -> Column:
    # One constant; building it from 200 literal columns takes longer than small jobs run.
    fields = ("literal", "pattern", "replacement")
    rows = json.dumps([dict(zip(fields, rule)) for rule in rules])
    return F.from_json(
        F.lit(rows), "array<struct<literal: string, pattern: string, replacement: string>>"
    )


def _up_to_last(text: Column, literal: Column, use) -> Column:
    """`use` on the text up to its last `literal`, then the rest as it is.

    For what ends with the literal: no match begins behind the last one, and without the rest no
    opening there is followed to the end of the text in vain.
    """

    def split(t):
        tail = F.call_function("substring_index", t, literal, F.lit(-1))
        return F.struct(t.alias("text"), tail.alias("tail"))

    def joined(s):
        head = F.left(s["text"], F.length(s["text"]) - F.length(s["tail"]))
        return F.concat(use(head), s["tail"])

    return bind(bind(text, split), joined)


def apply_closed_rules(text: Column, rules) -> Column:
    """The rules one after another, for patterns that end with their literal."""
    return F.aggregate(
        _rule_table(rules),
        text,
        lambda done, rule: F.when(
            F.contains(done, rule["literal"]),
            _up_to_last(
                done,
                rule["literal"],
                lambda head: F.regexp_replace(head, rule["pattern"], rule["replacement"]),
            ),
        ).otherwise(done),
    )


def apply_rules(text: Column, rules) -> Column:
    """Run the rules one after another, each only on a text that holds its literal."""
    return F.aggregate(
        _rule_table(rules),
        text,
        lambda done, rule: F.when(
            F.contains(done, rule["literal"]),
            F.regexp_replace(done, rule["pattern"], rule["replacement"]),
        ).otherwise(done),
    )


def _with_closings(text: Column) -> Column:
    closings = F.array_distinct(F.regexp_extract_all(text, F.lit("</[a-z0-9 ]+>"), F.lit(0)))
    return F.struct(text.alias("text"), closings.alias("closings"), F.rlike(text, F.lit("<(/[a-z0-9 ]*)?<")).alias("joins"))


def _after_rule(done: Column, text: Column) -> Column:
    """The state after a rule has run. All that goes starts with "<", so pieces can only become a new closing tag where the beginning
    of one stands before a "<". A text without that never comes to have it, and needs no new list: what its list
    holds too much costs a rule that finds nothing."""
    same = F.struct(text.alias("text"), done["closings"].alias("closings"), F.lit(False).alias("joins"))
    return F.when(done["joins"], bind(text, _with_closings)).otherwise(same)


def apply_element_rules(text: Column, rules) -> Column:
    """The same for rules whose literal is a closing tag.

    The closing tags of the text are listed once, and again after a rule that ran only if pieces of the text could make
    new ones; most of the many rules then cost a look into a short list and no scan of the text.
    """
    return F.aggregate(
        _rule_table(rules),
        bind(text, _with_closings),
        lambda done, rule: F.when(
            F.array_contains(done["closings"], rule["literal"]),
            _after_rule(
                done,
                _up_to_last(
                    done["text"],
                    rule["literal"],
                    lambda head: F.regexp_replace(head, rule["pattern"], rule["replacement"]),
                ),
            ),
        ).otherwise(done),
        lambda done: done["text"],
    )


def _until_stable(text: Column, literal: str, used: str, replace) -> Column:
    """`replace` until a pass changes nothing, for texts that hold the literal.

    Each pass that changes something uses up two characters `used` and makes none, so their number
    bounds the passes. Once the text is stable, what is left of them costs a look at a flag.
    """

    def one_pass(state, _):
        return F.when(state["stable"], state).otherwise(
            bind(
                replace(state["text"]),
                lambda new: F.struct(new.alias("text"), (new == state["text"]).alias("stable")),
            )
        )

    def clean(t):
        passes = (F.length(t) - F.length(F.replace(t, F.lit(used), F.lit("")))) / 2 + 1
        return F.when(
            F.contains(t, F.lit(literal)),
            F.aggregate(
                F.sequence(F.lit(1), passes.cast("int")),
                F.struct(t.alias("text"), F.lit(False).alias("stable")),
                one_pass,
                lambda state: state["text"],
            ),
        ).otherwise(t)

    return bind(text, clean)


def clean_templates(text: Column) -> Column:
    """`{{...}}` -> marker, innermost first."""
    pattern, marker = F.lit(R.TEMPLATE_PATTERN), F.lit(R.TEMPLATE_MARKER)
    return _until_stable(text, "}}", "}", lambda t: F.regexp_replace(t, pattern, marker))


def clean_wiki_tables(text: Column) -> Column:
    return apply_closed_rules(text, R.WIKI_TABLE_RULES)


def clean_drop_tags(text: Column) -> Column:
    text = apply_closed_rules(text, R.COMMENT_RULES)
    text = apply_element_rules(text, R.DROP_ELEMENT_RULES)
    return apply_rules(text, R.DROP_TAG_RULES)


def clean_keep_tags(text: Column) -> Column:
    return apply_element_rules(text, R.KEEP_ELEMENT_RULES)


def let(value: str, name: str, use: str) -> str:
    """SQL: `use` with `value` under a name, computed once."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def bind_sql(value: Column, name: str, use: str) -> Column:
    """The same for a Column: `use` is SQL that refers to it by name. Long expressions are built faster that way."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {use}")), F.lit(0))


#: Tags after which the list of what was found is started anew, so that no long array is copied a tag at a time.
_TAGS_AT_ONCE = 32


def _have_partner(kinds: str) -> str:
    """SQL: for tags in order, 1 for one kind and -1 for the other, `closes`, whether each of the second kind closes one of the first
    before it, and `open`, how many of the first kind none closes.

    How many of the first kind are open is carried along; one of the second kind closes the last of them, if there is one.
    """
    pieces = f"transform(sequence(0, cast(size({kinds}) div {_TAGS_AT_ONCE} AS int)), i -> slice({kinds}, i * {_TAGS_AT_ONCE} + 1, {_TAGS_AT_ONCE}))"
    look = (
        "(s, x) -> named_struct('open', CASE WHEN x > 0 THEN s.open + 1 WHEN s.open > 0 THEN s.open - 1 ELSE 0 END, "
        "'closes', concat(s.closes, array(x < 0 AND s.open > 0)))"
    )
    some = f"aggregate(some, named_struct('open', st.open, 'closes', cast(array() AS array<boolean>)), {look})"
    after = let(some, "d", "named_struct('open', d.open, 'closes', concat(st.closes, array(d.closes)))")
    start = "named_struct('open', 0, 'closes', cast(array() AS array<array<boolean>>))"
    return f"aggregate({pieces}, {start}, (st, some) -> {after}, st -> named_struct('open', st.open, 'closes', flatten(st.closes)))"


def _without_partners(text: Column, tag: str) -> Column:
    """One pass: all opening and closing tags of a name that belong together go, however deep they nest; null if what is left
    holds a tag that stands in none of its pieces, which might have to come before those farther out.

    Only openings that a closing tag follows count, so the text before the last closing tag is cut at its tags. A closing tag
    belongs to the last opening before it that has no other. Every step is one scan. Pieces between tags hold none, so the tags that
    stay and those behind the last closing tag are all there may be.
    """
    closing = f"</{tag}>"
    # The attributes hold no opening tag, and are never given back (possessive).
    any_tag = f"r'<(?:{tag}(?:>| (?:[^<>]++|<(?!{tag}[> ]))*+>)|/{tag}>)'"
    tail = f"substring_index(t, '{closing}', -1)"
    body = f"left(t, length(t) - length({tail}) - {len(closing)})"
    pieces = f"concat(split({body}, {any_tag}, -1), array({tail}))"
    joined = f"array_join(transform({pieces}, (p, i) -> IF(i = 0, p, concat(get(stay, i - 1), p))), '')"
    left = f"concat(filter(stay, x -> x != ''), regexp_extract_all({tail}, {any_tag}, 0))"
    use = let(joined, "joined", f"IF(regexp_extract_all(joined, {any_tag}, 0) = {left}, joined, NULL)")
    goes = f"IF(x = '{closing}', get(gone.closes, i), gone.opens IS NULL OR get(gone.opens, i))"
    use = let(f"transform(tags, (x, i) -> IF({goes}, '', x))", "stay", use)
    # read from the end, with the kinds exchanged, an opening closes a closing tag; where none is left open, each does
    opens = f"IF(d.open = 0, NULL, reverse({_have_partner('k.back')}.closes))"
    gone = let(_have_partner("k.forth"), "d", f"named_struct('closes', d.closes, 'opens', {opens})")
    forth = f"transform(tags, x -> IF(x = '{closing}', -1, 1))"
    back = f"reverse(transform(tags, x -> IF(x = '{closing}', 1, -1)))"
    use = let(let(f"named_struct('forth', {forth}, 'back', {back})", "k", gone), "gone", use)
    use = let(f"concat(regexp_extract_all({body}, {any_tag}, 0), array('{closing}'))", "tags", use)
    return bind_sql(text, "t", f"IF(contains(t, '{closing}'), {use}, t)")


def _without_innermost(text: Column, tag: str) -> Column:
    """One pass: the elements of a name that hold none of their own lose their tags.

    Only openings that a closing tag follows count, so the text before the last closing tag is cut
    at its openings. A piece that holds a closing tag is the end of an innermost element: its
    opening and the first closing tag in it go. Every step is one scan.
    """
    closing = f"</{tag}>"
    # The attributes hold no opening tag, and are never given back (possessive).
    opening = F.lit(f"<{tag}(?:>| (?:[^<>]++|<(?!{tag}[> ]))*+>)")

    def cut(t):
        tail = F.substring_index(t, closing, -1)
        body = F.left(t, F.length(t) - F.length(tail) - len(closing))
        return bind(
            F.struct(body.alias("body"), tail.alias("tail")),
            lambda s: F.struct(
                F.split(s["body"], opening, -1).alias("pieces"),
                F.regexp_extract_all(s["body"], opening, F.lit(0)).alias("openings"),
                s["tail"].alias("tail"),
            ),
        )

    def closed(piece, at, openings):
        whole = F.concat(F.coalesce(F.get(openings, at - 1), F.lit("")), piece)
        inner = F.overlay(piece, F.lit(""), F.instr(piece, F.lit(closing)), F.lit(len(closing)))
        return F.when((at > 0) & F.contains(piece, F.lit(closing)), inner).otherwise(whole)

    def joined(s):
        last = F.size(s["openings"])
        pieces = F.transform(
            s["pieces"],
            lambda piece, at: bind(
                F.when(at == last, F.concat(piece, F.lit(closing))).otherwise(piece),
                lambda p: closed(p, at, s["openings"]),
            ),
        )
        return F.concat(F.array_join(pieces, ""), s["tail"])

    return F.when(F.contains(text, F.lit(closing)), bind(cut(text), joined)).otherwise(text)


def clean_nested_tags(text: Column) -> Column:
    """Self-nesting elements: tags go from the inside out, content stays.

    One pass takes all levels at once, unless that makes a new tag out of pieces; such a text takes a pass for each level.
    """

    def one_pass(tag, text):
        return F.coalesce(_without_partners(text, tag), _without_innermost(text, tag))

    for tag in R.NESTED_TAGS:
        text = _until_stable(text, f"</{tag}>", ">", partial(one_pass, tag))
    return text


def clean_internal_links(text: Column) -> Column:
    return apply_rules(text, R.INTERNAL_LINK_RULES)


def clean_bold_italic(text: Column) -> Column:
    return apply_rules(text, R.BOLD_ITALIC_RULES)


def clean_line_breaks(text: Column) -> Column:
    return apply_rules(text, R.LINE_BREAK_RULES)


def clean_external_links(text: Column) -> Column:
    return apply_rules(text, R.EXTERNAL_LINK_RULES)


def clean_special_links(text: Column) -> Column:
    return apply_rules(text, R.SPECIAL_LINK_RULES)


def _blank_lines(text: Column, kind: str) -> Column:
    # Line ends at the end of the text go first; those that blanking leaves there stay.
    return apply_rules(F.rtrim(text, F.lit("\n")), [R.LINE_RULES[kind]])


def clean_line_hr(text: Column) -> Column:
    return _blank_lines(text, "hr")


def clean_line_ul(text: Column) -> Column:
    return _blank_lines(text, "ul")


def clean_line_ol(text: Column) -> Column:
    return _blank_lines(text, "ol")


def clean_line_redirect(text: Column) -> Column:
    return _blank_lines(text, "redirect")


def clean_line_definition(text: Column) -> Column:
    return _blank_lines(text, "definition")


def clean_line_term(text: Column) -> Column:
    return _blank_lines(text, "term")


def drop_heading_lines(text: Column) -> Column:
    return _blank_lines(text, "heading")


def clean_spaces(text: Column) -> Column:
    return apply_rules(text, R.SPACE_RULES)


def clean_newlines(text: Column) -> Column:
    return apply_rules(text, R.NEWLINE_RULES)


# The steps before and after entity decoding (entities.py), in order.
BEFORE_ENTITIES = [
    clean_templates,
    clean_wiki_tables,
    clean_drop_tags,
    clean_keep_tags,
    clean_nested_tags,
    clean_internal_links,
    clean_bold_italic,
    clean_line_breaks,
    clean_external_links,
    clean_special_links,
]
AFTER_ENTITIES = [
    clean_line_hr,
    clean_line_ul,
    clean_line_ol,
    clean_line_redirect,
    clean_line_definition,
    clean_line_term,
    clean_spaces,
    clean_newlines,
]


def compose(text: Column, steps) -> Column:
    for step in steps:
        text = step(text)
    return text

"""Token expressions: text Column -> array<string> Column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wortfund.functions import rules as R
from wortfund.functions.markup import bind, drop_heading_lines


def drop_template_marker(text: Column) -> Column:
    return F.replace(text, F.lit(R.TEMPLATE_MARKER), F.lit(" "))


def tokenize_plain(text: Column) -> Column:
    """Runs of letters or runs of digits, in order, duplicates kept; NULL counts as empty."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(R.TOKEN_PATTERN), F.lit(0))


def tokenize_display(text: Column) -> Column:
    """Tokens of a cleaned article without its headings and template markers."""
    return tokenize_plain(drop_template_marker(drop_heading_lines(text)))


def normalize_tokens(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def build_index_keys(text: Column) -> Column:
    """The words of an article as they are indexed, stop words included.

    A text is put in lower case whole where that cuts the same words: in LOWERED_WHOLE every character becomes one of its kind,
    whatever stands beside it. Elsewhere each word is, since a sigma depends on its place.
    """

    def keys(cut):
        each = normalize_tokens(tokenize_plain(cut))
        ascii_only = F.octet_length(cut) == F.char_length(cut)
        whole = ascii_only | F.rlike(cut, F.lit(R.LOWERED_WHOLE))
        return F.when(whole, tokenize_plain(F.lower(cut))).otherwise(each)

    return bind(drop_template_marker(drop_heading_lines(text)), keys)


def distinct_terms(text: Column) -> Column:
    return F.array_distinct(build_index_keys(text))


def compound_keys(tokens: Column) -> Column:
    """Each pair of neighbours, in alphabetical order, joined to one key."""

    def pairs(t):
        return F.when(
            F.size(t) >= 2,
            F.transform(
                F.slice(t, F.lit(2), F.size(t)),
                lambda right, i: F.concat(
                    F.least(F.get(t, i), right), F.greatest(F.get(t, i), right)
                ),
            ),
        ).otherwise(F.array().cast("array<string>"))

    return bind(tokens, pairs)

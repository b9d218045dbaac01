"""Fixed schemas of every table the jobs read or write; nothing is inferred at read time."""

from pyspark.sql import types as T

# One <page> of a MediaWiki XML dump, reduced to the fields the jobs use.
XML_PAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ns", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField(
            "revision",
            T.StructType(
                [T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())]))]
            ),
        ),
    ]
)

ARTICLES = T.StructType(
    [
        T.StructField("docid", T.LongType(), False),
        T.StructField("title", T.StringType()),
        T.StructField("wikitext", T.StringType()),
    ]
)

# Titles of the articles, to find docids by.
TITLES = T.StructType([T.StructField("title", T.StringType()), T.StructField("docid", T.LongType(), False)])

# The term dictionary of an index: a word's documents and occurrences, in all and by chunk of docids.
DICTIONARY = T.StructType(
    [
        T.StructField("word", T.StringType(), False),
        T.StructField("documents", T.LongType(), False),
        T.StructField("occurrences", T.LongType(), False),
        T.StructField(
            "chunks",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("chunk", T.LongType(), False),
                        T.StructField("documents", T.LongType(), False),
                        T.StructField("occurrences", T.LongType(), False),
                    ]
                ),
                False,
            ),
            False,
        ),
    ]
)

# Index layout "postings": one row per word and document.
POSTINGS = T.StructType(
    [
        T.StructField("word", T.StringType(), False),
        T.StructField("docid", T.LongType(), False),
        T.StructField("occurences", T.ArrayType(T.IntegerType(), False), False),
    ]
)

# Index layout "positions": one row per occurrence.
POSITIONS = T.StructType(
    [
        T.StructField("word", T.StringType(), False),
        T.StructField("docid", T.LongType(), False),
        T.StructField("occurence", T.IntegerType(), False),
    ]
)

# Index layout "by term": one row per word and chunk of docids (chunk: docid / width, rounded down).
BY_TERM = T.StructType(
    [
        T.StructField("word", T.StringType(), False),
        T.StructField("chunk", T.LongType(), False),
        T.StructField(
            "inv_index",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("docid", T.LongType(), False),
                        T.StructField("occurences", T.ArrayType(T.IntegerType(), False), False),
                    ]
                ),
                False,
            ),
            False,
        ),
    ]
)

LAYOUTS = {"postings": POSTINGS, "positions": POSITIONS, "by_term": BY_TERM}

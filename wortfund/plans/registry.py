"""Every operator as a query over the given tables, with the SQL text of its result.

Lists are rendered as text here, so that both sides compare the same values.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wortfund import schemas
from wortfund.functions import markup as M
from wortfund.functions import tokens as K
from wortfund.operators import clean as C
from wortfund.operators import index as I
from wortfund.operators import keyed
from wortfund.operators import lookup as L
from wortfund.plans import fixtures as X
from wortfund.plans import jobs
from wortfund.plans import oracle as O
from wortfund.session import scratch_path
from wortfund.sources import lists
from wortfund.sources import tables as S
from wortfund.sources import xml_dump
from wortfund.sources.buckets import write_by_term

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def _text(values):
    return F.concat_ws(",", values.cast("array<string>"))


def show_postings(df: DataFrame) -> DataFrame:
    return df.select("word", "docid", _text(F.col("occurences")).alias("occurences"))


def show_by_term(df: DataFrame) -> DataFrame:
    entry = F.transform(
        "inv_index",
        lambda e: F.concat(e["docid"].cast("string"), F.lit(":"), _text(e["occurences"])),
    )
    return df.select("word", "chunk", F.concat_ws(";", entry).alias("inv_index"))


def show_tokens(df: DataFrame, tokens) -> DataFrame:
    return df.select("docid", F.concat_ws(" ", tokens).alias("tokens"), F.size(tokens).alias("n"))


def tokens_sql(tokens: str, source: str = O.MARKUP_SQL) -> str:
    return (
        "SELECT docid, array_to_string(l, ' ') AS tokens, CAST(len(l) AS INTEGER) AS n "
        f"FROM (SELECT docid, {tokens} AS l FROM ({source}))"
    )


def postings(spark, sf_dir) -> DataFrame:
    return I.index_postings(X.articles(spark, sf_dir), lists.default_stopwords(spark))


def positions(spark, sf_dir) -> DataFrame:
    return I.index_positions(X.articles(spark, sf_dir), lists.default_stopwords(spark))


# --- sources ---------------------------------------------------------------------------------

XML_SQL = (
    "SELECT doc_id AS id, doc_id % 3 AS ns, 'T' || doc_id AS title, text AS body FROM documents"
)


def _dump(spark, sf_dir) -> str:
    return X.stored(
        spark,
        sf_dir,
        "dump",
        lambda path: xml_dump.write_xml_pages(X.xml_pages(spark, sf_dir), path),
    )


@query("scan_xml_pages", XML_SQL)
def scan_xml_pages(spark, sf_dir):
    pages = xml_dump.scan_xml_pages(spark, _dump(spark, sf_dir))
    return pages.select("id", "ns", "title", F.col("revision.text._VALUE").alias("body"))


@query("scan_xml_pages_whole", XML_SQL)
def scan_xml_pages_whole(spark, sf_dir):
    pages = xml_dump.scan_xml_pages_whole(spark, _dump(spark, sf_dir))
    return pages.select("id", "ns", "title", F.col("revision.text._VALUE").alias("body"))


@query("scan_articles", O.ARTICLES)
def scan_articles(spark, sf_dir):
    path = X.stored(
        spark, sf_dir, "article-table", lambda p: S.append_articles(X.articles(spark, sf_dir), p)
    )
    return S.read_articles(spark, path)


@query(
    "scan_index",
    f"SELECT 'postings' AS layout, word, count(*) AS n FROM ({O.POSTINGS}) GROUP BY word "
    f"UNION ALL SELECT 'positions', word, count(*) FROM ({O.POSITIONS}) GROUP BY word "
    f"UNION ALL SELECT 'by_term', word, count(*) FROM ({O.BY_TERM}) GROUP BY word",
)
def scan_index(spark, sf_dir):
    parts = [
        X.stored_index(spark, sf_dir, layout)
        .groupBy(F.lit(layout).alias("layout"), "word")
        .agg(F.count("*").alias("n"))
        for layout in ("postings", "positions", "by_term")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "stopwords",
    f"SELECT s.word, count(p.word) AS n FROM {O.STOPWORDS} "
    f"LEFT JOIN ({O.positions(O.ARTICLES, 'wikitext', stop=False)}) p ON p.word = s.word "
    "GROUP BY s.word",
)
def stopwords(spark, sf_dir):
    """How often each stop word stands in the corpus; the list is loaded from its file."""
    path = X.stored(
        spark,
        sf_dir,
        "stopwords",
        lambda p: lists.default_stopwords(spark)
        .unionByName(lists.default_stopwords(spark))
        .write.text(p),
    )
    words = I.token_positions(X.articles(spark, sf_dir))
    return L.batch_lookup_word_docs(words, lists.load_stopwords(spark, path))


def _page_titles(spark, sf_dir):
    return X.page_articles(spark, sf_dir).select("title")


def _label_ids(spark, sf_dir):
    return X.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("docid"))


def _benchmark_words(spark, sf_dir):
    texts = X.table(spark, sf_dir, "benchmark")
    return texts.select(F.explode(K.build_index_keys(F.col("text"))).alias("word"))


def _search_keys(spark, sf_dir) -> dict:
    """The four key lists, written as text files with their duplicates and loaded back."""

    def path(name, df):
        return X.stored(
            spark,
            sf_dir,
            f"keys-{name}",
            lambda p: df(spark, sf_dir).select(F.col(df_column[name]).cast("string")).write.text(p),
        )

    df_column = {"titles": "title", "ids": "docid", "words": "word"}
    ids = path("ids", _label_ids)
    return lists.load_search_keys(
        spark, path("titles", _page_titles), ids, ids, path("words", _benchmark_words)
    )


TITLE_KEYS = f"SELECT title FROM ({O.PAGE_ARTICLES})"
ID_KEYS = "SELECT doc_id AS docid FROM labels"
WORD_KEYS = f"SELECT unnest({O.keys('text')}) AS word FROM benchmark"


@query(
    "search_keys",
    f"SELECT DISTINCT 'titles' AS list, title AS key FROM ({TITLE_KEYS}) "
    f"UNION ALL SELECT DISTINCT 'article_ids', CAST(docid AS VARCHAR) FROM ({ID_KEYS}) "
    f"UNION ALL SELECT DISTINCT 'index_ids', CAST(docid AS VARCHAR) FROM ({ID_KEYS}) "
    f"UNION ALL SELECT DISTINCT 'words', word FROM ({WORD_KEYS})",
)
def search_keys(spark, sf_dir):
    parts = [
        df.select(F.lit(name).alias("list"), F.col(df.columns[0]).cast("string").alias("key"))
        for name, df in _search_keys(spark, sf_dir).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --- sinks -----------------------------------------------------------------------------------


@query(
    "sink_articles_append",
    f"SELECT * FROM ({O.ARTICLES}) UNION ALL SELECT * FROM ({O.PAGE_ARTICLES})",
)
def sink_articles_append(spark, sf_dir):
    path = scratch_path(spark, "append-articles")
    S.append_articles(X.articles(spark, sf_dir), path)
    S.append_articles(X.page_articles(spark, sf_dir), path)
    return S.read_articles(spark, path)


@query("sink_index_postings", O.POSTINGS)
def sink_index_postings(spark, sf_dir):
    return show_postings(X.stored_index(spark, sf_dir, "postings"))


@query("sink_index_positions", O.POSITIONS)
def sink_index_positions(spark, sf_dir):
    return X.stored_index(spark, sf_dir, "positions").select("word", "docid", "occurence")


@query("sink_index_by_term", O.BY_TERM)
def sink_index_by_term(spark, sf_dir):
    return show_by_term(X.stored_index(spark, sf_dir, "by_term"))


@query("rename_columns", 'SELECT docid AS _id, title, wikitext FROM (' + O.ARTICLES + ")")
def rename_columns(spark, sf_dir):
    return S.rename_columns(X.articles(spark, sf_dir), S.ARTICLE_NAMES["mongodb"])


@query("sink_create_table", O.ARTICLES)
def sink_create_table(spark, sf_dir):
    path = scratch_path(spark, "create-articles")
    S.create_table(X.articles(spark, sf_dir), path)
    return S.read_table(spark, path)


_RELOADED = (
    f"SELECT * FROM ({O.PAGE_ARTICLES}) UNION ALL SELECT * FROM ({O.ARTICLES}) "
    "WHERE docid NOT IN (SELECT page_id FROM pages) AND docid % 10 <> 3"
)


@query("upsert_articles_job", f"SELECT docid, CASE WHEN docid IN (SELECT page_id FROM pages) THEN 'A' || title ELSE title END AS title, wikitext FROM ({_RELOADED})")
def upsert_articles_job(spark, sf_dir):
    """A second load of articles that holds each docid three times, the last version with the least title, and deletes some."""
    path = scratch_path(spark, "kept-articles")
    jobs.upsert_articles(spark, X.articles(spark, sf_dir), path, 16)
    versions = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(t).alias("t")) for n, t in ((2, "y"), (3, "A"), (1, "z"))]))
    pages = X.page_articles(spark, sf_dir).withColumn("v", versions)
    load = pages.select("docid", F.concat("v.t", "title").alias("title"), "wikitext", F.col("v.n").alias("n"))
    jobs.upsert_articles(spark, load, path, 16, ["n"], X.deleted_docids(spark, sf_dir))
    return S.read_articles(spark, path).select("docid", "title", "wikitext")


@query(
    "articles_upsert",
    f"SELECT * FROM ({O.PAGE_ARTICLES}) UNION ALL SELECT * FROM ({O.ARTICLES}) "
    "WHERE docid NOT IN (SELECT page_id FROM pages)",
)
def articles_upsert(spark, sf_dir):
    return keyed.articles_upsert(X.articles(spark, sf_dir), X.page_articles(spark, sf_dir))


# --- projections, filters --------------------------------------------------------------------


@query("filter_namespace", f"SELECT * FROM ({XML_SQL}) WHERE ns = 0")
def filter_namespace(spark, sf_dir):
    pages = C.filter_namespace(xml_dump.scan_xml_pages(spark, _dump(spark, sf_dir)))
    return pages.select("id", "ns", "title", F.col("revision.text._VALUE").alias("body"))


@query("project_article", O.ARTICLES)
def project_article(spark, sf_dir):
    return C.project_article(xml_dump.scan_xml_pages(spark, _dump(spark, sf_dir)))


@query("typed_columns", O.ARTICLES)
def typed_columns(spark, sf_dir):
    rows = X.articles(spark, sf_dir).withColumn("docid", F.col("docid").cast("string"))
    return S.typed_columns(rows, schemas.ARTICLES)


@query("lookup_equals", "SELECT * FROM documents WHERE lang = 'de'")
def lookup_equals(spark, sf_dir):
    return L.lookup_equals(X.table(spark, sf_dir, "documents"), "lang", "de")


@query(
    "lookup_title_bound",
    f"SELECT docid, 'O''' || docid AS title, wikitext FROM ({O.ARTICLES}) WHERE docid = 7",
)
def lookup_title_bound(spark, sf_dir):
    quoted = X.articles(spark, sf_dir).withColumn(
        "title", F.concat(F.lit("O'"), F.col("docid").cast("string"))
    )
    return L.lookup_title_bound(spark, quoted, "O'7")


@query("project_all", f"SELECT * FROM ({O.ARTICLES}) WHERE title = 'T7'")
def project_all(spark, sf_dir):
    return X.articles(spark, sf_dir).select("*").where(F.col("title") == "T7")


# --- cleaning --------------------------------------------------------------------------------


def _add_step(step):
    @query(step.__name__, O.step(step.__name__))
    def run(spark, sf_dir):
        return X.markup(spark, sf_dir).select("docid", step(F.col("body")).alias("body"))


for _step in M.BEFORE_ENTITIES + M.AFTER_ENTITIES:
    _add_step(_step)


def _add_elements(kind, clean):
    """All elements of a kind, against what is left of each: the SQL holds no pattern."""
    left = X.element_texts(X.without_tags("text"), kind)[1]

    @query(f"clean_elements_{kind}", f"SELECT doc_id AS docid, {left} AS body FROM documents")
    def run(spark, sf_dir):
        return X.elements(spark, sf_dir, kind).select("docid", clean(F.col("body")).alias("body"))


for _kind, _clean in (("drop", M.clean_drop_tags), ("keep", M.clean_keep_tags), ("single", M.clean_drop_tags)):
    _add_elements(_kind, _clean)


def _nested(spark, sf_dir):
    """Each document's text within as many elements as its docid tells, some closed twice, some not at all."""
    levels = (F.col("doc_id") % 300).cast("int")
    text = F.expr(X.without_tags("text"))
    body = F.concat(F.repeat(F.lit("<span a>"), levels), F.lit("<div>"), text, F.repeat(F.lit("</span>"), levels + 1), F.lit("<span>"))
    return X.in_files(spark, sf_dir, "documents", "doc_id", "text").select(F.col("doc_id").alias("docid"), body.alias("body"))


@query(
    "clean_nested_deep",
    f"SELECT doc_id AS docid, '<div>' || {X.without_tags('text')} || '</span><span>' AS body FROM documents",
)
def clean_nested_deep(spark, sf_dir):
    return _nested(spark, sf_dir).select("docid", M.clean_nested_tags(F.col("body")).alias("body"))


# What stands for a reference, and what it says; decoded once.
_REFERENCES = [
    ("&auml;", "ä"), ("&#228;", "ä"), ("&#xE4;", "ä"), ("&#XE4", "ä"), ("&amp;lt;", "&lt;"), ("&amp", "&"), ("&notit;", "¬it;"),
    ("&nope;", "&nope;"), ("&;", "&;"), ("&#128;", "€"), ("&#x1F600;", "\U0001f600"), ("&#0;", "\ufffd"), ("&#11;", ""),
    ("&NotEqualTilde;", "\u2242\u0338"), ("&hellip", "&hellip"), ("&copy2024", "©2024"),
]


def _referring(sayings: int) -> str:
    """SQL: a document's words without ampersands, with a reference (0) or what it says (1) before each end of a sentence."""
    plain = "replace(replace(coalesce(text, ''), '&', ' '), ';', ' ')"
    parts = "".join(saying[sayings] + " " for saying in _REFERENCES)
    return f"replace({plain}, '. ', ' {parts}. ') || ' {parts}'"


@query("clean_references", f"SELECT doc_id AS docid, {_referring(1)} AS body FROM documents")
def clean_references(spark, sf_dir):
    """Named, numeric, unterminated, unknown and twice escaped references in the documents' texts."""
    documents = X.in_files(spark, sf_dir, "documents", "doc_id", "text")
    return C.clean_unescape_html(documents.select(F.col("doc_id").alias("docid"), F.expr(_referring(0)).alias("body")), "body")


@query("clean_unescape_html", O.step("clean_unescape_html"))
def clean_unescape_html(spark, sf_dir):
    return C.clean_unescape_html(X.markup(spark, sf_dir), "body")


@query("clean_article", O.cleaned())
def clean_article(spark, sf_dir):
    return C.clean_article(X.markup(spark, sf_dir), "body")


# --- tokens ----------------------------------------------------------------------------------


@query("drop_heading_lines", f"SELECT docid, {O.HEADINGS('body')} AS body FROM ({O.MARKUP_SQL})")
def drop_heading_lines(spark, sf_dir):
    return X.markup(spark, sf_dir).select(
        "docid", M.drop_heading_lines(F.col("body")).alias("body")
    )


@query(
    "drop_template_marker",
    f"SELECT docid, replace(body, '|TEMPLATE|', ' ') AS body FROM ({O.MARKUP_SQL})",
)
def drop_template_marker(spark, sf_dir):
    return X.markup(spark, sf_dir).select(
        "docid", K.drop_template_marker(F.col("body")).alias("body")
    )


@query("tokenize_plain", tokens_sql(O.plain("body")))
def tokenize_plain(spark, sf_dir):
    return show_tokens(X.markup(spark, sf_dir), K.tokenize_plain(F.col("body")))


@query("tokenize_display", tokens_sql(O.display("body")))
def tokenize_display(spark, sf_dir):
    return show_tokens(X.markup(spark, sf_dir), K.tokenize_display(F.col("body")))


@query("normalize_tokens", tokens_sql(f"list_transform({O.plain('body')}, lambda x: lower(x))"))
def normalize_tokens(spark, sf_dir):
    tokens = K.normalize_tokens(K.tokenize_plain(F.col("body")))
    return show_tokens(X.markup(spark, sf_dir), tokens)


@query("build_index_keys", tokens_sql(O.keys("body")))
def build_index_keys(spark, sf_dir):
    return show_tokens(X.markup(spark, sf_dir), K.build_index_keys(F.col("body")))


@query("distinct_terms", tokens_sql(f"list_sort(list_distinct({O.keys('body')}))"))
def distinct_terms(spark, sf_dir):
    return show_tokens(X.markup(spark, sf_dir), F.sort_array(K.distinct_terms(F.col("body"))))


@query(
    "compound_keys",
    "SELECT docid, coalesce(array_to_string(l, ' '), '') AS tokens, "
    "CAST(len(l) AS INTEGER) AS n FROM (SELECT docid, list_transform(range(1, len(t)), "
    "lambda i: least(t[i], t[i + 1]) || greatest(t[i], t[i + 1])) AS l "
    f"FROM (SELECT docid, {O.keys('body')} AS t FROM ({O.MARKUP_SQL})))",
)
def compound_keys(spark, sf_dir):
    return show_tokens(
        X.markup(spark, sf_dir), K.compound_keys(K.build_index_keys(F.col("body")))
    )


# --- index -----------------------------------------------------------------------------------

ALL_POSITIONS = O.positions(O.ARTICLES, "wikitext", stop=False)


@query("token_positions", f"SELECT docid, occurence AS pos, word FROM ({ALL_POSITIONS})")
def token_positions(spark, sf_dir):
    return I.token_positions(X.articles(spark, sf_dir))


@query("stopword_filter", f"SELECT docid, occurence AS pos, word FROM ({O.POSITIONS})")
def stopword_filter(spark, sf_dir):
    rows = I.token_positions(X.articles(spark, sf_dir))
    return I.stopword_filter(rows, lists.default_stopwords(spark))


@query("flatten_entries", O.postings(ALL_POSITIONS))
def flatten_entries(spark, sf_dir):
    return show_postings(I.flatten_entries(X.articles(spark, sf_dir)))


@query("index_postings", O.POSTINGS)
def index_postings(spark, sf_dir):
    return show_postings(postings(spark, sf_dir))


@query("index_positions", O.POSITIONS)
def index_positions(spark, sf_dir):
    return positions(spark, sf_dir)


@query("index_by_term", O.BY_TERM)
def index_by_term(spark, sf_dir):
    return show_by_term(I.index_by_term(X.stored_index(spark, sf_dir, "postings")))


@query(
    "long_words",
    "SELECT word, CAST(ceil(count(*) / 100.0) AS INTEGER) AS chunks "
    f"FROM ({O.POSTINGS}) GROUP BY word HAVING count(*) > 100",
)
def long_words(spark, sf_dir):
    return I.long_words(X.stored_index(spark, sf_dir, "postings"), 100)


@query("index_by_term_in_chunks", O.POSTINGS)
def index_by_term_in_chunks(spark, sf_dir):
    """Rows of 50 postings at most; their postings are all there."""
    by_term = I.index_by_term(X.stored_index(spark, sf_dir, "postings"), 50)
    return show_postings(I.by_term_to_postings(by_term))


@query("index_by_term_ranges", O.by_term(docids=50))
def index_by_term_ranges(spark, sf_dir):
    """The rows themselves: a chunk holds 50 docids."""
    return show_by_term(I.index_by_term(X.stored_index(spark, sf_dir, "postings"), 50))


_SECOND_PART = f"SELECT -1 - docid AS docid, wikitext FROM ({O.PAGE_ARTICLES})"
_MERGED_POSTINGS = (
    f"{O.POSTINGS} UNION ALL {O.postings(O.positions(_SECOND_PART, 'wikitext'))}"
)


def _two_parts(spark, sf_dir) -> list[DataFrame]:
    pages = X.page_articles(spark, sf_dir).withColumn("docid", -1 - F.col("docid"))
    return [postings(spark, sf_dir), I.index_postings(pages, lists.default_stopwords(spark))]


@query("index_merge", O.by_term(_MERGED_POSTINGS))
def index_merge(spark, sf_dir):
    return show_by_term(I.index_merge(_two_parts(spark, sf_dir)))


@query("index_merge_by_term", O.by_term(_MERGED_POSTINGS))
def index_merge_by_term(spark, sf_dir):
    parts = [I.index_by_term(part) for part in _two_parts(spark, sf_dir)]
    return show_by_term(I.merge_by_term(parts))


@query("merge_index", O.by_term(_MERGED_POSTINGS, 50))
def merge_index(spark, sf_dir):
    """Two stored by-term indexes, with words and chunks in common, merged into a third."""
    paths = [scratch_path(spark, "by-term-part") for _ in range(2)]
    first, second = _two_parts(spark, sf_dir)
    # the first part is cut across its chunks, so that both parts hold rows of one word and chunk
    odd = F.col("docid") % 2 == 1
    write_by_term(first.where(odd), paths[0], 50, 16)
    write_by_term(second.unionByName(first.where(~odd)), paths[1], 50, 16)
    path = scratch_path(spark, "merged-index")
    jobs.merge_index(spark, paths, path, 16, 50)
    return show_by_term(S.read_layout(spark, path, "by_term"))


@query("merge_index_of_other_widths", O.by_term(_MERGED_POSTINGS, 50))
def merge_index_of_other_widths(spark, sf_dir):
    """Parts that are cut at 7 docids and at an unknown number come out cut at 50."""
    paths = [scratch_path(spark, "by-term-part") for _ in range(2)]
    first, second = _two_parts(spark, sf_dir)
    write_by_term(first, paths[0], 7, 4)
    I.index_by_term(second, 30).write.parquet(paths[1])
    path = scratch_path(spark, "merged-index")
    jobs.merge_index(spark, paths, path, 16, 50)
    return show_by_term(S.read_layout(spark, path, "by_term"))


_RELOADED_POSTINGS = O.postings(O.positions(_RELOADED, "wikitext"))


@query(
    "merge_replaced_documents",
    " UNION ALL ".join(f"SELECT '{name}' AS layout, * FROM ({_RELOADED_POSTINGS})" for name in schemas.LAYOUTS),
)
def merge_replaced_documents(spark, sf_dir):
    """Changed documents loaded again and others deleted: exactly the new postings are left, in every layout."""
    as_postings = {"postings": lambda df: df, "positions": I.positions_to_postings, "by_term": I.by_term_to_postings}
    parts = []
    for layout, convert in as_postings.items():
        index = S.read_layout(spark, X.reloaded_index(spark, sf_dir, layout, 50), layout)
        parts.append(show_postings(convert(index)).select(F.lit(layout).alias("layout"), "word", "docid", "occurences"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("merge_replaced_by_term", O.by_term(_RELOADED_POSTINGS, 50))
def merge_replaced_by_term(spark, sf_dir):
    """The by-term rows themselves: one for each word and chunk."""
    return show_by_term(S.read_layout(spark, X.reloaded_index(spark, sf_dir, "by_term", 50), "by_term"))


@query("index_merge_replaced", O.by_term(_RELOADED_POSTINGS, 50))
def index_merge_replaced(spark, sf_dir):
    """Partial indexes merged in one go, the later one with newer versions of documents of the first."""
    documents, pages = X.articles(spark, sf_dir), X.page_articles(spark, sf_dir)
    stop = lists.default_stopwords(spark)
    gone = pages.select("docid").unionByName(X.deleted_docids(spark, sf_dir))
    gone = jobs.listed_docids(spark, gone, scratch_path(spark, "replaced-docids"))
    parts = [I.index_postings(documents, stop), I.index_postings(pages, stop)]
    return show_by_term(I.index_merge(parts, 50, [documents.select("docid"), gone]))


def dictionary_sql(postings: str, docids: int) -> str:
    chunk = f"CAST((docid - ((docid % {docids}) + {docids}) % {docids}) // {docids} AS BIGINT)"
    places = "len(string_split(occurences, ','))"
    return (
        "SELECT word, CAST(sum(documents) AS BIGINT) AS documents, CAST(sum(occurrences) AS BIGINT) AS occurrences, "
        "string_agg(chunk || ':' || documents || ':' || occurrences, ';' ORDER BY chunk) AS chunks "
        f"FROM (SELECT word, {chunk} AS chunk, count(*) AS documents, CAST(sum({places}) AS BIGINT) AS occurrences "
        f"FROM ({postings}) GROUP BY ALL) GROUP BY word"
    )


def show_dictionary(df: DataFrame) -> DataFrame:
    chunk = F.transform("chunks", lambda c: F.concat_ws(":", c["chunk"], c["documents"], c["occurrences"]))
    return df.select("word", "documents", "occurrences", F.concat_ws(";", chunk).alias("chunks"))


@query(
    "term_dictionary",
    " UNION ALL ".join(f"SELECT '{name}' AS layout, * FROM ({dictionary_sql(O.POSTINGS, 50)})" for name in schemas.LAYOUTS),
)
def term_dictionary(spark, sf_dir):
    """Documents and occurrences of every word, from an index in each layout."""
    parts = []
    for layout in schemas.LAYOUTS:
        index = X.stored_index(spark, sf_dir, layout) if layout != "by_term" else I.index_by_term(X.stored_index(spark, sf_dir, "postings"), 50)
        parts.append(show_dictionary(I.term_dictionary(index, 50)).withColumn("layout", F.lit(layout)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "term_dictionary_kept",
    " UNION ALL ".join(f"SELECT '{name}' AS layout, * FROM ({dictionary_sql(_RELOADED_POSTINGS, 50)})" for name in schemas.LAYOUTS),
)
def term_dictionary_kept(spark, sf_dir):
    """The dictionary that loads and deletions have carried on."""
    parts = []
    for layout in schemas.LAYOUTS:
        kept = S.read_dictionary(spark, X.reloaded_index(spark, sf_dir, layout, 50))
        parts.append(show_dictionary(kept).withColumn("layout", F.lit(layout)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("layout_convert", O.POSTINGS)
def layout_convert(spark, sf_dir):
    """Positions -> postings -> by term -> postings."""
    by_term = I.positions_to_by_term(X.stored_index(spark, sf_dir, "positions"))
    return show_postings(I.by_term_to_postings(by_term))


@query("convert_postings_to_positions", O.POSITIONS)
def convert_postings_to_positions(spark, sf_dir):
    return I.postings_to_positions(X.stored_index(spark, sf_dir, "postings"))


@query("convert_positions_to_postings", O.POSTINGS)
def convert_positions_to_postings(spark, sf_dir):
    return show_postings(I.positions_to_postings(X.stored_index(spark, sf_dir, "positions")))


@query("convert_by_term_to_positions", O.POSITIONS)
def convert_by_term_to_positions(spark, sf_dir):
    return I.by_term_to_positions(X.stored_index(spark, sf_dir, "by_term"))


@query(
    "lookup_counts",
    f"SELECT (SELECT count(*) FROM ({O.ARTICLES}) WHERE title = 'T7') AS titles, "
    f"(SELECT count(*) FROM ({O.POSTINGS}) WHERE docid = 7) AS words, "
    f"(SELECT count(*) FROM ({O.POSTINGS}) WHERE word = 'the') AS documents",
)
def lookup_counts(spark, sf_dir):
    index = X.stored_index(spark, sf_dir, "postings")
    titles = L.lookup_counts(X.articles(spark, sf_dir), "title", "T7").toDF("titles")
    words = L.lookup_counts(index, "docid", 7).toDF("words")
    documents = L.lookup_counts(index, "word", "the").toDF("documents")
    return spark.sql(
        "SELECT (SELECT titles FROM {t}) AS titles, (SELECT words FROM {w}) AS words, "
        "(SELECT documents FROM {d}) AS documents",
        t=titles,
        w=words,
        d=documents,
    )


# --- lookups ---------------------------------------------------------------------------------


@query("lookup_title", f"SELECT * FROM ({O.ARTICLES}) WHERE title = 'T7'")
def lookup_title(spark, sf_dir):
    return L.lookup_title(X.articles(spark, sf_dir), "T7")


@query("lookup_title_indexed", f"SELECT * FROM ({O.ARTICLES}) WHERE title = 'T7'")
def lookup_title_indexed(spark, sf_dir):
    """By way of the table of titles: one folder of it, then those of the articles found."""
    articles, titles = X.kept_articles(spark, sf_dir)
    return L.lookup_title(articles, "T7", titles)


@query("lookup_docid", f"SELECT * FROM ({O.ARTICLES}) WHERE docid = 7")
def lookup_docid(spark, sf_dir):
    return L.lookup_docid(X.stored_articles(spark, sf_dir), 7)


@query("lookup_doc_words_postings", f"SELECT * FROM ({O.POSTINGS}) WHERE docid = 7")
def lookup_doc_words_postings(spark, sf_dir):
    index = X.stored_index(spark, sf_dir, "postings", "docid")
    return show_postings(L.lookup_doc_words(index, 7))


@query("lookup_doc_words_positions", f"SELECT * FROM ({O.POSITIONS}) WHERE docid = 7")
def lookup_doc_words_positions(spark, sf_dir):
    index = X.stored_index(spark, sf_dir, "positions", "docid")
    return L.lookup_doc_words(index, 7)


@query(
    "lookup_doc_words_by_term",
    f"SELECT * FROM ({O.BY_TERM}) WHERE chunk = 0 "
    f"AND word IN (SELECT word FROM ({O.POSTINGS}) WHERE docid = 7)",
)
def lookup_doc_words_by_term(spark, sf_dir):
    return show_by_term(
        L.lookup_doc_words_by_term(X.stored_index(spark, sf_dir, "by_term"), 7)
    )


@query("lookup_word_docs_postings", f"SELECT * FROM ({O.POSTINGS}) WHERE word = 'the'")
def lookup_word_docs_postings(spark, sf_dir):
    return show_postings(L.lookup_word_docs(X.stored_index(spark, sf_dir, "postings"), "the"))


@query("lookup_word_docs_positions", f"SELECT * FROM ({O.POSITIONS}) WHERE word = 'the'")
def lookup_word_docs_positions(spark, sf_dir):
    return L.lookup_word_docs(X.stored_index(spark, sf_dir, "positions"), "the")


@query("lookup_word_docs_by_term", f"SELECT * FROM ({O.BY_TERM}) WHERE word = 'the'")
def lookup_word_docs_by_term(spark, sf_dir):
    return show_by_term(L.lookup_word_docs(X.stored_index(spark, sf_dir, "by_term"), "the"))


@query("batch_lookup_title", O.counts(O.PAGE_ARTICLES, TITLE_KEYS, "title"))
def batch_lookup_title(spark, sf_dir):
    keys = _search_keys(spark, sf_dir)["titles"]
    return L.batch_lookup_title(X.page_articles(spark, sf_dir), keys)


@query("batch_lookup_title_indexed", O.counts(O.PAGE_ARTICLES, TITLE_KEYS, "title"))
def batch_lookup_title_indexed(spark, sf_dir):
    """From the table of titles alone."""
    titles = X.kept_articles(spark, sf_dir, X.page_articles)[1]
    return L.batch_lookup_title(titles, _search_keys(spark, sf_dir)["titles"])


_WORD_THE = f"SELECT * FROM ({_RELOADED_POSTINGS}) WHERE word = 'the'"


@query(
    "lookup_word_count",
    f"SELECT count(*) AS n, CAST(coalesce(sum(len(string_split(occurences, ','))), 0) AS BIGINT) AS occurrences FROM ({_WORD_THE})",
)
def lookup_word_count(spark, sf_dir):
    """How many documents hold a word, from its row of the dictionary, after documents were replaced."""
    return L.lookup_word_count(S.read_dictionary(spark, X.reloaded_index(spark, sf_dir, "postings", 50)), "the")


@query("batch_lookup_word_counts", O.counts(_RELOADED_POSTINGS, WORD_KEYS, "word"))
def batch_lookup_word_counts(spark, sf_dir):
    dictionary = S.read_dictionary(spark, X.reloaded_index(spark, sf_dir, "postings", 50))
    return L.batch_lookup_word_counts(dictionary, _search_keys(spark, sf_dir)["words"])


@query("batch_lookup_docid", O.counts(O.ARTICLES, ID_KEYS, "docid"))
def batch_lookup_docid(spark, sf_dir):
    keys = _search_keys(spark, sf_dir)["article_ids"]
    return L.batch_lookup_docid(X.stored_articles(spark, sf_dir), keys)


@query("batch_lookup_doc_words", O.counts(O.POSTINGS, ID_KEYS, "docid"))
def batch_lookup_doc_words(spark, sf_dir):
    keys = _search_keys(spark, sf_dir)["index_ids"]
    return L.batch_lookup_doc_words(X.stored_index(spark, sf_dir, "postings", "docid"), keys)


@query("batch_lookup_doc_words_by_term", O.counts(O.POSTINGS, ID_KEYS, "docid"))
def batch_lookup_doc_words_by_term(spark, sf_dir):
    keys = _search_keys(spark, sf_dir)["index_ids"]
    return L.batch_lookup_doc_words_by_term(X.stored_index(spark, sf_dir, "by_term"), keys)


@query("batch_lookup_word_docs", O.counts(O.POSTINGS, WORD_KEYS, "word"))
def batch_lookup_word_docs(spark, sf_dir):
    keys = _search_keys(spark, sf_dir)["words"]
    return L.batch_lookup_word_docs(X.stored_index(spark, sf_dir, "postings"), keys)


@query("batch_lookup_word_docs_positions", O.counts(O.POSITIONS, WORD_KEYS, "word"))
def batch_lookup_word_docs_positions(spark, sf_dir):
    keys = _search_keys(spark, sf_dir)["words"]
    return L.batch_lookup_word_docs(X.stored_index(spark, sf_dir, "positions"), keys)


@query(
    "run_lookups",
    "SELECT 'title' AS lookup, title AS key, n "
    f"FROM ({O.counts(O.ARTICLES, TITLE_KEYS, 'title')}) "
    "UNION ALL SELECT 'docid', CAST(docid AS VARCHAR), n "
    f"FROM ({O.counts(O.ARTICLES, ID_KEYS, 'docid')}) "
    "UNION ALL SELECT 'doc_words', CAST(docid AS VARCHAR), n "
    f"FROM ({O.counts(O.POSTINGS, ID_KEYS, 'docid')}) "
    "UNION ALL SELECT 'word_docs', word, n "
    f"FROM ({O.counts(O.POSTINGS, WORD_KEYS, 'word')})",
)
def run_lookups(spark, sf_dir):
    return jobs.run_lookups(
        X.stored_articles(spark, sf_dir),
        X.stored_index(spark, sf_dir, "postings"),
        _search_keys(spark, sf_dir),
        X.stored_index(spark, sf_dir, "postings", "docid"),
    )


# --- jobs end to end -------------------------------------------------------------------------

@query("ingest_dump", f"SELECT docid, 'T' || docid AS title, body AS wikitext FROM ({O.cleaned()})")
def ingest_dump(spark, sf_dir):
    """Markup texts written as a dump, then ingested: split, filtered, cleaned, appended."""

    def write(path):
        body = F.struct(F.struct(F.col("body").alias("_VALUE")).alias("text"))
        pages = X.markup(spark, sf_dir).select(
            F.col("docid").alias("id"),
            F.lit(0).cast("long").alias("ns"),
            F.concat(F.lit("T"), F.col("docid").cast("string")).alias("title"),
            body.alias("revision"),
        )
        xml_dump.write_xml_pages(pages, path)

    target = scratch_path(spark, "ingested")
    jobs.ingest(spark, X.stored(spark, sf_dir, "markup-dump", write), target)
    return S.read_articles(spark, target).select("docid", "title", "wikitext")


_GOOD = "SELECT doc_id AS docid, coalesce(text, '') AS body FROM documents WHERE doc_id % 5 NOT IN (1, 2, 3)"
_ESCAPED = "coalesce(text, '')"
for _char, _entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
    _ESCAPED = f"replace({_ESCAPED}, '{_char}', '{_entity}')"
_ESCAPED = f"replace({_ESCAPED}, chr(13), '&#13;')"
_BAD = (
    "SELECT '<page><title>T' || doc_id || '</title><ns>0</ns><id>' || CASE doc_id % 5 WHEN 1 THEN 'x' ELSE '' END || doc_id "
    "|| '</id><revision><text>' || CASE doc_id % 5 WHEN 2 THEN '&nope;' ELSE '' END "
    f"|| {_ESCAPED} || CASE doc_id % 5 WHEN 3 THEN '' ELSE '</text>' END || '</revision></page>' AS page "
    "FROM documents WHERE doc_id % 5 IN (1, 2, 3)"
)


@query(
    "ingest_dump_rejects",
    f"SELECT 'article' AS kind, docid AS n, 'T' || docid AS title, body FROM ({O.cleaned(_GOOD)}) "
    f"UNION ALL SELECT 'page', 0, '', page FROM ({_BAD}) "
    "UNION ALL SELECT 'pages', count(*), '', '' FROM documents "
    f"UNION ALL SELECT 'rejected', count(*), '', '' FROM ({_BAD})",
)
def ingest_dump_rejects(spark, sf_dir):
    """A dump with malformed pages: the good ones as articles, the bad ones as they stand in the dump, and how many there were."""
    dump = X.stored(spark, sf_dir, "damaged-dump", lambda path: X.damaged_dump(spark, sf_dir).write.text(path))
    target, rejected = scratch_path(spark, "ingested"), scratch_path(spark, "rejected")
    counts = jobs.ingest(spark, dump, target, rejected=rejected, buckets=16)
    columns = "kind string, n long, title string, body string"
    articles = S.read_articles(spark, target).select(F.lit("article").alias("kind"), F.col("docid").alias("n"), "title", F.col("wikitext").alias("body"))
    bad = spark.read.parquet(rejected)
    pages = bad.select(F.lit("page").alias("kind"), F.lit(0).cast("long").alias("n"), F.lit("").alias("title"), F.col("page").alias("body"))
    totals = spark.createDataFrame([(kind, n, "", "") for kind, n in counts.items()], columns)
    return articles.unionByName(pages).unionByName(totals)

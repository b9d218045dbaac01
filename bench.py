"""Time the headline jobs on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Every job writes its whole result to Spark's noop sink (or to a table, where that is the job), so
that no column is left out. Each is timed once, after a warm-up of all of them on small data.
"""

import json
import os
import time

from pyspark.sql import functions as F

from wortfund.functions import markup as M
from wortfund.operators import clean as C
from wortfund.operators import index as I
from wortfund.operators import lookup as L
from wortfund.plans import fixtures as X
from wortfund.plans import jobs
from wortfund.plans import registry as R
from wortfund.session import local_session, scratch_path
from wortfund.sources import lists, xml_dump

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def tag_rules(spark, sf_dir):
    steps = [
        M.clean_drop_tags, M.clean_keep_tags, M.clean_bold_italic, M.clean_line_breaks,
        M.clean_spaces, M.clean_newlines,
    ]
    pages = X.page_articles(spark, sf_dir)
    return pages.select("docid", M.compose(F.col("wikitext"), steps).alias("wikitext"))


def single_lookups(spark, sf_dir):
    """The four lookups, one key and one job each."""
    articles = X.stored_articles(spark, sf_dir)
    by_word = X.stored_index(spark, sf_dir, "postings")
    by_docid = X.stored_index(spark, sf_dir, "postings", "docid")
    consume(L.lookup_title(articles, "T7"))
    consume(L.lookup_docid(articles, 7))
    consume(L.lookup_doc_words(by_docid, 7))
    consume(L.lookup_word_docs(by_word, "the"))


def index_from_postings(spark, sf_dir):
    return I.postings_to_by_term(X.stored_index(spark, sf_dir, "postings"))


def write_index(spark, sf_dir, layout):
    jobs.write_index(
        X.articles(spark, sf_dir),
        lists.default_stopwords(spark),
        layout,
        scratch_path(spark, f"bench-{layout}"),
        "word",
        buckets=64,
    )


def prepare(spark, sf_dir):
    """Tables that timed jobs read; not timed."""
    R.scan_xml_pages(spark, sf_dir)
    R._search_keys(spark, sf_dir)
    X.stored_articles(spark, sf_dir)
    for column in ("word", "docid"):
        X.stored_index(spark, sf_dir, "postings", column)


def timed_jobs():
    def frame(build):
        return lambda spark, sf_dir: consume(build(spark, sf_dir))

    return {
        "index_positions": frame(R.positions),
        "index_postings": frame(R.postings),
        "by_term_from_stored_postings": frame(index_from_postings),
        "write_postings": lambda s, d: write_index(s, d, "postings"),
        "write_positions": lambda s, d: write_index(s, d, "positions"),
        "write_by_term": lambda s, d: write_index(s, d, "by_term"),
        "clean_tag_rules_pages": frame(tag_rules),
        "clean_article_pages": frame(lambda s, d: C.clean_article(X.page_articles(s, d))),
        "clean_article_markup": frame(lambda s, d: C.clean_article(X.markup(s, d), "body")),
        "scan_xml_pages": frame(
            lambda s, d: xml_dump.scan_xml_pages(s, R._dump(s, d)).select("id", "ns", "revision")
        ),
        "single_lookups": single_lookups,
        "batch_lookups": frame(R.run_lookups),
    }


def main():
    spark = local_session(CPUS, app="bench")
    seconds = {}
    for sf_dir in (WARM_UP_DIR, SF_DIR):
        if not os.path.isdir(sf_dir):
            continue
        prepare(spark, sf_dir)
        for name, run in timed_jobs().items():
            start = time.time()
            run(spark, sf_dir)
            seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

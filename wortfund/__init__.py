"""Wortfund: positional inverted indexes over wiki-style text corpora, as Spark DataFrame jobs."""

"""Readers and writers: XML dumps, tables, key lists, bucketed index files."""

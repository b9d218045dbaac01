"""Rows that lie in order, gathered in runs of equal keys, in Arrow batches.

A list of a run is the rows' own column with other offsets: nothing is copied value by value, and no more is held than a few
hundred thousand rows and the run that goes beyond. Null is a key like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows, and bytes of them, that are gathered at a time, besides the run that goes beyond.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1 << 18, 64 << 20


def _column(table: pa.Table, name: str) -> pa.Array:
    return table[name].chunk(0) if table[name].num_chunks else pa.array([], table.schema.field(name).type)


def _new(column: pa.Array) -> np.ndarray:
    """Whether each row but the first has another value than the one before it."""
    a, b = column[1:], column[:-1]
    other = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(other, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def first_rows(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The places where runs of equal keys begin."""
    new = np.zeros(max(0, len(table) - 1), dtype=bool)
    for key in keys:
        new |= _new(_column(table, key))
    return np.concatenate([np.zeros(min(1, len(table)), dtype=np.int64), np.flatnonzero(new) + 1])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in larger tables."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= ROWS_AT_ONCE or sum(b.nbytes for b in held) >= BYTES_AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if sum(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks()


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows, which lie together by `keys`, in tables that cut no run, and the places where their runs begin."""
    rest, enough = [], 0
    for table in gathered(batches):
        rest.append(table)
        # a run that goes on and on is put together once it has doubled
        if sum(map(len, rest)) < enough:
            continue
        table = pa.concat_tables(rest).combine_chunks()
        first = first_rows(table, keys)
        if len(first) > 1:
            yield table.slice(0, first[-1]), first[:-1]
        rest = [table.slice(first[-1])]
        enough = 2 * len(rest[0])
    if rest:
        table = pa.concat_tables(rest).combine_chunks()
        yield table, first_rows(table, keys)


def _lists(first: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(first, n).astype(np.int32)), values)


def _taken(table: pa.Table, keys: list[str], first: np.ndarray) -> list[pa.Array]:
    return [_column(table, key).take(pa.array(first)) for key in keys]


def _offsets(lists: pa.Array) -> np.ndarray:
    """Where the values of each list begin in flatten(), and their number; null is a list without values."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(size, dtype=np.int64)])


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values, 0 for null, and which are there: a pair that sorts as Spark does, null first."""
    there = pc.is_valid(column).to_numpy(zero_copy_only=False)
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False), there


def entries_to_lists(keys: list[str]):
    """Rows (keys, docid, occurences), sorted by all of these -> (keys, inv_index)."""

    def run(batches):
        for table, first in whole_runs(batches, keys):
            entries = pa.StructArray.from_arrays([_column(table, c) for c in ("docid", "occurences")], ["docid", "occurences"])
            yield pa.record_batch([*_taken(table, keys, first), _lists(first, len(table), entries)], names=[*keys, "inv_index"])

    return run


def _in_order(run: np.ndarray, entries: pa.StructArray) -> pa.Array | None:
    """The order of entries by run, docid and occurences; none if they lie so."""
    docid, there = _numbers(entries.field("docid"))
    same_run = run[1:] == run[:-1]
    if not len(run) or np.all(~same_run | (there[1:] & (~there[:-1] | (docid[1:] > docid[:-1])))):
        return None
    order = np.lexsort((docid, there, run))
    a, b = order[1:], order[:-1]
    alike = (run[a] == run[b]) & (there[a] == there[b]) & (docid[a] == docid[b])
    if alike.any():
        # a docid that stands in a list more than once: by its places
        edge = np.flatnonzero(np.diff(np.concatenate([[False], alike, [False]]).astype(np.int8)))
        for a, b in zip(edge[::2], edge[1::2] + 1):
            places = entries.field("occurences").take(pa.array(order[a:b])).to_pylist()
            key = [(p is not None, [(x is not None, x or 0) for x in p or []]) for p in places]
            order[a:b] = order[a:b][sorted(range(b - a), key=key.__getitem__)]
    return pa.array(order)


def lists_to_lists(keys: list[str]):
    """Rows (keys, inv_index), sorted by keys -> the same with one row for each, its entries by docid."""

    def run(batches):
        for table, first in whole_runs(batches, keys):
            lists = _column(table, "inv_index")
            begin, entries = _offsets(lists), lists.flatten()
            ends = np.append(begin[first], len(entries))
            order = _in_order(np.repeat(np.arange(len(first)), np.diff(ends)), entries)
            entries = entries if order is None else entries.take(order)
            yield pa.record_batch([*_taken(table, keys, first), _lists(ends[:-1], len(entries), entries)], names=[*keys, "inv_index"])

    return run


def places_to_lists(batches):
    """Rows (word, docid, occurence) -> (word, docid, occurences), a row for each run, in the order the rows come in."""
    for table in gathered(batches):
        first, place = first_rows(table, ["word", "docid"]), _column(table, "occurence")
        there = pc.is_valid(place).to_numpy(zero_copy_only=False)
        begin = np.concatenate([[0], np.cumsum(there)])
        lists = _lists(begin[first], begin[-1], place.drop_null())
        yield pa.record_batch([*_taken(table, ["word", "docid"], first), lists], names=["word", "docid", "occurences"])


def lists_of_places(batches):
    """Rows (word, docid, occurences), sorted by word and docid -> one row for each, its places ascending."""
    for table, first in whole_runs(batches, ["word", "docid"]):
        lists = _column(table, "occurences")
        begin, places = _offsets(lists), lists.flatten()
        ends = np.append(begin[first], len(places))
        own, value = np.repeat(np.arange(len(first)), np.diff(ends)), places.to_numpy(zero_copy_only=False)
        if np.any((own[1:] == own[:-1]) & (value[1:] < value[:-1])):
            places = places.take(pa.array(np.lexsort((value, own))))
        lists = _lists(ends[:-1], len(places), places)
        yield pa.record_batch([*_taken(table, ["word", "docid"], first), lists], names=["word", "docid", "occurences"])


_COUNTS = ("chunk", "documents", "occurrences")


def _summed(own: np.ndarray, part: np.ndarray, there: np.ndarray, counts: list[np.ndarray], once: bool):
    """(own, part, there, counts), by own and part, one of each; `once`: a part is one document however often it comes."""
    more, same = own[1:] > own[:-1], own[1:] == own[:-1]
    if not np.all(more | (same & (there[1:] & (~there[:-1] | (part[1:] >= part[:-1]))))):
        order = np.lexsort((part, there, own))
        own, part, there, counts = own[order], part[order], there[order], [c[order] for c in counts]
        same = own[1:] == own[:-1]
    new = ~same | (part[1:] != part[:-1]) | (there[1:] != there[:-1])
    if not np.all(new):
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(own)), dtype=bool), new]))
        own, part, there, counts = own[first], part[first], there[first], [np.add.reduceat(c, first) for c in counts]
    return own, part, there, [np.ones_like(counts[0]), *counts[1:]] if once else counts


def _parts(own: np.ndarray, n: int, part: np.ndarray, there: np.ndarray, counts: list[np.ndarray]) -> pa.ListArray:
    """A list of (chunk, documents, occurrences) for each of `n` words."""
    values = pa.StructArray.from_arrays([pa.array(part, mask=~there), *map(pa.array, counts)], list(_COUNTS))
    return _lists(np.searchsorted(own, np.arange(n)), len(values), values)


def counts_to_lists(once: bool):
    """Rows (word, chunk, documents, occurrences) -> (word, chunks), a row for each word of some hundred thousand rows. With `once` a
    docid stands in the place of the chunk."""

    def run(batches):
        for table in gathered(batches):
            word = _column(table, "word").dictionary_encode(null_encoding="encode")
            part, there = _numbers(_column(table, "chunk"))
            counts = [_column(table, c).to_numpy(zero_copy_only=False) for c in _COUNTS[1:]]
            own, *rest = _summed(word.indices.to_numpy().astype(np.int64), part, there, counts, once)
            yield pa.record_batch([word.dictionary, _parts(own, len(word.dictionary), *rest)], names=["word", "chunks"])

    return run


def lists_of_counts(width: int | None):
    """Rows (word, chunks), sorted by word -> the dictionary's (word, documents, occurrences, chunks). With `width` docids stand in the
    place of chunks, each of them one document, and are put together in chunks."""

    def run(batches):
        for table, first in whole_runs(batches, ["word"]):
            lists = _column(table, "chunks")
            begin, values = _offsets(lists), lists.flatten()
            own = np.repeat(np.arange(len(first)), np.diff(np.append(begin[first], len(values))))
            part, there = _numbers(values.field("chunk"))
            counts = [values.field(c).to_numpy(zero_copy_only=False) for c in _COUNTS[1:]]
            own, part, there, counts = _summed(own, part, there, counts, width is not None)
            if width is not None:
                own, part, there, counts = _summed(own, np.where(there, part // width, 0), there, counts, False)
            kept = counts[0] > 0
            own, part, there, counts = own[kept], part[kept], there[kept], [c[kept] for c in counts]
            words, own = np.unique(own, return_inverse=True)
            if not len(words):
                continue
            at = np.searchsorted(own, np.arange(len(words)))
            totals = [pa.array(np.add.reduceat(c, at)) for c in counts]
            lists = _parts(own, len(words), part, there, counts)
            yield pa.record_batch([*_taken(table, ["word"], first[words]), *totals, lists], names=["word", "documents", "occurrences", "chunks"])

    return run

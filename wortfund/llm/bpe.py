"""Byte-pair encoding and decoding by a distinct-word table.

Spark splits the documents; each task splits its texts into the tokenizer's words (its pre-tokenizer's pieces, special
tokens apart) and keeps a table of the distinct ones, each encoded once; the ids are joined to the words by position.
Merges never cross words, so the ids are those of encoding the whole text. The table holds its ids in one array and starts anew
when it has TABLE_BYTES; texts are put out TEXT_BYTES at a time, and a task hands its memory back at its end. Decoding joins each id with its
piece, the vocabulary's bytes, and puts the pieces together in order. There is no shuffle.

One table for the whole input was built first: blocks of documents sent their distinct words to it by hash and got
the ids back. It gave the same ids, but moved the texts: see the README for its figures.

The vocabulary file's path is a parameter; its content (1 to 2 MB) goes to the tasks with the functions.

A null text is empty: no ids, decoded to ''. Texts are encoded whole, whatever their length. Repeated rows are
encoded alike. An empty table gives an empty result. A column of the input named like a new one is replaced.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wortfund.llm.common import hand_back_memory, packed, quoted, unpacked


def vocabulary(path: str) -> str:
    """The content of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class Splitter:
    """Splits texts into words, as the tokenizer does before it merges."""

    def __init__(self, content: str):
        import regex

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(content)
        kind = spec["pre_tokenizer"]["type"]
        if kind != "ByteLevel" or spec["normalizer"] or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level vocabularies without a normaliser are split here")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # fixed value: the pattern of byte-level pre-tokenizers
        self.words_in = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""").findall

    def words(self, text: str | None) -> list[str]:
        """The words of a text, in order; a special token is a word of its own."""
        if not text:
            return []
        if self.at_special is None or not any(s in text for s in self.special):
            return self.words_in(text)
        out = []
        for part in self.at_special.split(text):
            out += [part] if part in self.special else self.words_in(part)
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        """The ids of words, each by itself."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def piece_bytes(content: str) -> list[bytes]:
    """The bytes of each id. The vocabulary writes a byte as a printable character: itself if it is printable, else
    the next free one from 256 on."""
    spec = json.loads(content)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocab, special = spec["model"]["vocab"], {t["id"]: t["content"] for t in spec["added_tokens"]}
    out = [b""] * (1 + max([*vocab.values(), *special]))
    for piece, i in vocab.items():
        out[i] = special[i].encode() if i in special else bytes(byte[c] for c in piece)
    for i, text in special.items():
        out[i] = text.encode()
    return out


#: Bytes of a task's table, about, and of the texts that are put out together; a longer text is put out alone.
TABLE_BYTES, TEXT_BYTES = 48 << 20, 4 << 20
#: Characters of texts that are looked up together, and ids that are put together to texts: many short texts cost a few calls.
_TOGETHER = 128 << 10
#: Bytes of a word in the table besides its characters: the string, its entry and number, and where its ids are.
_ENTRY_BYTES = 180


class _Numbers(dict):
    """Words and their numbers; a word that is looked up for the first time gets the next one."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class _Table:
    """The distinct words of a task, numbered, and their ids one after another."""

    def __init__(self, splitter: Splitter):
        self.splitter = splitter
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.ids, self.end, self.bytes = np.empty(1 << 16, dtype=np.int32), np.zeros(1 << 14, dtype=np.int64), 0

    def _add(self, words: list[str]) -> None:
        """The ids of words that have just been numbered."""
        found = self.splitter.encode(words)
        n = len(self.number) - len(words)
        at = int(self.end[n])
        ends = at + np.cumsum([len(f) for f in found])
        while len(self.end) <= n + len(words):
            self.end = np.concatenate([self.end, np.zeros_like(self.end)])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.end[n + 1 : n + 1 + len(words)] = ends
        self.ids[at : ends[-1]] = np.fromiter(chain.from_iterable(found), dtype=np.int32)
        self.bytes += int(ends[-1] - at) * 4 + sum(map(len, words)) + _ENTRY_BYTES * len(words)

    def encode(self, words: list[str]) -> np.ndarray:
        """The ids of words, one after another."""
        return self.encode_sized(words)[0]

    def encode_sized(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same, and how many ids each word has."""
        if self.bytes > TABLE_BYTES:
            self.clear()
        own = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        if self.number.new:
            self._add(self.number.new)
            self.number.new = []
        start, size = self.end[own], self.end[own + 1] - self.end[own]
        return self.ids[_places(start, size)], size


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the sizes, one after another."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _at_once(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Borders of runs of neighbours that hold `most` in all or are one."""
    out, start, held = [], 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            out.append((start, i))
            start, held = i, 0
        held += size
    return [*out, (start, len(sizes))] if sizes else out


def _some_rows(batch: pa.RecordBatch, sizes: np.ndarray):
    """Slices of a batch with about TEXT_BYTES each."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > TEXT_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


def _text_sizes(texts) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def _encoded(content: str, text_col: str):
    def run(batches):
        # Spark's tasks share out the cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        splitter = Splitter(content)
        table = _Table(splitter)
        for batch in batches:
            for some in _some_rows(batch, _text_sizes(batch["row"].field(text_col))):
                texts = [text or "" for text in some["row"].field(text_col).to_pylist()]
                ids, counts = [np.empty(0, dtype=np.int32)], [np.zeros(1, dtype=np.int64)]
                for a, b in _at_once([len(text) for text in texts], _TOGETHER):
                    words = [splitter.words(text) for text in texts[a:b]]
                    found, size = table.encode_sized(list(chain.from_iterable(words)))
                    ends = np.cumsum([len(w) for w in words])
                    total = np.concatenate([[0], np.cumsum(size)])[ends]
                    ids.append(found)
                    counts.append(np.diff(total, prepend=0))
                offsets = pa.array(np.cumsum(np.concatenate(counts)), pa.int32())
                yield pa.record_batch([some["row"], pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))], names=["row", "ids"])
        del splitter, table
        hand_back_memory()

    return run


def encode(df: DataFrame, content: str, text_col="text", ids_col="ids") -> DataFrame:
    """df with `ids`, the token ids of the text, special tokens' strings as their ids. content: vocabulary(path)."""
    rows = df.select(packed(df))
    out = rows.mapInArrow(_encoded(content, text_col), T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.select(*unpacked(out, ids_col), F.col("ids").alias(ids_col))


def _texts_of(pieces: list[bytes]):
    """A function from a column of ids to their texts."""
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    flat, start = np.frombuffer(b"".join(pieces), dtype=np.uint8), np.cumsum(size) - size

    def texts(ids: pa.ListArray) -> list[str]:
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        # null lists have no values here
        values, at = ids.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(counts)])
        out = []
        for a, b in _at_once(counts.tolist(), _TOGETHER):
            own = values[at[a] : at[b]]
            n = size[own]
            some = flat[_places(start[own], n)].tobytes()
            ends = np.concatenate([[0], np.cumsum(n)])[at[a : b + 1] - at[a]].tolist()
            # bytes that make no character become the replacement character
            out += [some[c:d].decode("utf-8", "replace") for c, d in zip(ends, ends[1:])]
        return out

    return texts


def _pieces(pieces: list[bytes]):
    def run(batches):
        texts = _texts_of(pieces)
        for batch in batches:
            sizes = 4 * pc.fill_null(pc.list_value_length(batch["ids"]), 0).to_numpy(zero_copy_only=False)
            for some in _some_rows(batch, sizes):
                yield pa.record_batch([some["row"], pa.array(texts(some["ids"]), pa.string())], names=["row", "decoded"])
        hand_back_memory()

    return run


def encode_and_decode(df: DataFrame, content: str, then, schema: str, text_col="text") -> DataFrame:
    """then(batches of (row, ids, decoded)), with the row of df as a struct: encoding, decoding and what follows in one Python worker
    for each core, where a chain of encode() and decode() holds one for each of them."""
    pieces = piece_bytes(content)

    def run(batches):
        texts = _texts_of(pieces)
        coded = (
            pa.record_batch([b["row"], b["ids"], pa.array(texts(b["ids"]), pa.string())], names=["row", "ids", "decoded"])
            for b in _encoded(content, text_col)(batches)
        )
        yield from then(coded)

    return df.select(packed(df)).mapInArrow(run, schema)


def decode(df: DataFrame, content: str, ids_col="ids", text_col="decoded") -> DataFrame:
    """df with `decoded`, the text of its ids: each id is joined with its piece, a table as large as the vocabulary."""
    rows = df.select(packed(df), quoted(ids_col).alias("ids"))
    out = rows.mapInArrow(_pieces(piece_bytes(content)), T.StructType([rows.schema["row"], T.StructField("decoded", T.StringType())]))
    fields = [f.name for f in out.schema["row"].dataType.fields if f.name.lower() != text_col.lower()]
    return out.select(*[F.col("row")[f].alias(f) for f in fields], F.col("decoded").alias(text_col))

"""Secrets in texts: strong patterns, and weak parts that are linked to their complements.

Strong spans (assign, access, hex) are reported wherever they stand. Weak parts are an identifier
(`user = ...`), a secret (a mixed token of 20 or more characters, or a short password assignment) or an
endpoint (a URL or a host with a port); alone each is ordinary text. They are linked by an interval join within
scopes: a scope is a paragraph (text between blank lines), and two parts meet if they are at most REACH code
points apart in one scope. A weak identifier or secret is reported if it meets its complement, strong or weak;
an endpoint, if it meets both an identifier and a secret.

The join runs over each document's few parts, sorted by place, inside the row's own task: the text never
moves, there is no shuffle, and the cost is that of the scan. Positions are code points, ends exclusive.

A null text is empty. Texts of any length are scanned whole. Repeated rows are scanned alike. An empty table
gives an empty result. A column of the input named like a new one is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wortfund.llm.common import packed, quoted, unpacked

#: Code points between the ends of two linked parts, at most.
REACH = 200
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
SPANS = "array<struct<kind:string,start:int,end:int>>"

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are as long as they can be, so this is every run of 24 or more

#: An assign span needs one of these in the text in lower case.
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

WEAK_ID = re.compile(r"""(?ai:\b(?:user(?:name)?|login|account|client_?id|access_?key_?id|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]{3,})""")
WEAK_SECRET = re.compile(r"""(?ai:\b(?:pwd|pass|credential|auth|private_?key))["']?\x20*[:=]\x20*["']?([^\s"']{6,})""")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"""(?ai:\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+|\b(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::\d+)?)""")
_PARAGRAPH = re.compile(r"\n[\x20\t\r]*\n")

Span = tuple[int, int, str]


def strong_spans(text: str) -> list[Span]:
    """Spans of the three strong kinds, without order."""
    found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    return found


def _mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


def weak_spans(text: str, strong: list[Span]) -> list[Span]:
    """Weak parts that do not overlap a strong span."""
    found = [(m.start(), m.end(), "weak_id") for m in WEAK_ID.finditer(text)]
    found += [(m.start(), m.end(), "weak_secret") for m in WEAK_SECRET.finditer(text)]
    found += [(m.start(), m.end(), "weak_secret") for m in TOKEN.finditer(text) if _mixed(m[0])]
    found += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    taken, out, last = sorted(strong), [], {}
    starts = [s[0] for s in taken]
    longest = max((s[1] - s[0] for s in taken), default=0)
    for start, end, kind in sorted(found):
        if start < last.get(kind, 0):
            continue
        near = taken[bisect_left(starts, start - longest) : bisect_left(starts, end)]
        if not any(s < end and start < e for s, e, _ in near):
            out.append((start, end, kind))
            last[kind] = end
    return out


def linked(text: str, strong: list[Span], weak: list[Span]) -> list[Span]:
    """The weak parts that meet their complements: an interval join within scopes."""
    breaks = [m.start() for m in _PARAGRAPH.finditer(text)]
    role = {"access": "id", "weak_id": "id", "assign": "secret", "hex": "secret", "weak_secret": "secret", "endpoint": "endpoint"}
    parts = sorted((s, e, role[k], bisect_left(breaks, s)) for s, e, k in [*strong, *weak])
    # by role and scope: starts, and the largest end so far, both ascending
    index: dict[tuple[str, int], tuple[list[int], list[int]]] = {}
    for start, end, what, scope in parts:
        starts, ends = index.setdefault((what, scope), ([], []))
        starts.append(start)
        ends.append(max(end, ends[-1] if ends else 0))

    def meets(start, end, scope, what) -> bool:
        starts, ends = index.get((what, scope), ([], []))
        after = bisect_left(starts, end + REACH + 1)  # these begin in reach or before
        return after > 0 and ends[after - 1] >= start - REACH

    out = []
    for start, end, kind in weak:
        scope = bisect_left(breaks, start)
        id_, secret, endpoint = (meets(start, end, scope, w) for w in ("id", "secret", "endpoint"))
        if (kind == "weak_id" and secret) or (kind == "weak_secret" and id_) or (kind == "endpoint" and id_ and secret):
            out.append((start, end, kind))
        elif kind == "weak_secret" and endpoint and id_:
            out.append((start, end, kind))
    return out


def find(text: str | None) -> list[Span]:
    """All spans of a text, by start, then kind."""
    if not text:
        return []
    strong = strong_spans(text)
    weak = weak_spans(text, strong)
    # a weak part needs another part besides
    if weak and len(strong) + len(weak) > 1:
        weak = linked(text, strong, weak)
    else:
        weak = []
    return sorted([*strong, *weak], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redacted(text: str | None, spans: list[Span], mark: str = "<{}>") -> str | None:
    """The text with each span replaced by its kind; overlapping spans become one, named after the first."""
    if not spans:
        return text
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], mark.format(kind.upper())]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _found(redact: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts = batch["text"].to_pylist()
            spans = [find(t) for t in texts]
            columns = [batch["row"], pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in s] for s in spans], kind)]
            if redact:
                columns.append(pa.array([redacted(t, s) for t, s in zip(texts, spans)], pa.string()))
            yield pa.record_batch(columns, names=["row", "spans", "redacted"][: len(columns)])

    return run


def scan(df: DataFrame, text_col="text", redact: bool = False) -> DataFrame:
    """df with `secrets`, the spans (kind, start, end), and with `redacted_text` if redact."""
    rows = df.select(packed(df), quoted(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("spans", T._parse_datatype_string(SPANS))])
    if redact:
        schema.add("redacted", T.StringType())
    out = rows.mapInArrow(_found(redact), schema)
    new = [F.col("spans").alias("secrets")] + [F.col("redacted").alias("redacted_text")] * redact
    return out.select(*unpacked(out, "secrets", *["redacted_text"] * redact), *new)


def redact(df: DataFrame, text_col="text", length_col="n_chars") -> DataFrame:
    """df with every secret in the text replaced by its kind, and the length, if there is one, put right."""
    found = scan(df.select(packed(df), quoted(text_col).alias("text")), redact=True)
    changed, text = F.size("secrets") > 0, F.col("redacted_text")
    new = {text_col: text}
    if length_col in df.columns:
        own = F.col("row")[length_col]
        new[length_col] = F.when(changed, F.length(text).cast(df.schema[length_col].dataType)).otherwise(own)
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in df.columns])

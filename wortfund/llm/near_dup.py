"""Near-duplicate documents by Order MinHash, verified by banded alignment.

1. Documents with one sequence of words are one node: the digest of the words. All later work is on nodes.
2. Order MinHash: the k-mers of K words of a node are labelled with their occurrence number; for each of
   SKETCHES hash functions the PICKS smallest are taken and, in text order, make one sketch. Texts with a
   small edit distance agree in many sketches; a moved passage changes their order.
3. Nodes with a sketch in common are a group. Groups with the same members count once. A pair passes on if
   counts of its words in BINS bins leave a similarity of `similarity` possible: an exact bound, nothing is lost by it.
4. Verification: 1 - (edit distance in words) / (words of the longer text) >= similarity, by an alignment in
   a band that widens up to the distance allowed.
5. Verified pairs are joined into classes by alternating large and small stars.

Large groups: the members are first linked in chunks, each only to the centres of its chunk, which
joins a group of copies at one link a member; only the groups of FIRST_SKETCHES are linked so. What then still
lies in different classes is compared in blocks: first each member with the closest one of its smallest group, then, across every
whole group, every pair that the bound leaves, taken over FINE_BINS bins, in the least of the groups that both are in; first in
the groups of ROUND_SKETCHES, then in all others. So no group is held in one task, no pairs are emitted for a group that hangs together, a pair
comes up once, and no link between classes is lost that shares a sketch.

Long texts: the band starts narrow, so near copies of any length take time and memory in proportion to their words and changes. A
pair that all bounds leave open though it is not similar takes words x 0.2 words steps (400 million at 45,000 words, a few seconds),
and memory for one row of the band only.

A null text is compared with nothing. Texts without words are copies if they are equal. Ties are broken
by id. Repeated rows are copies. Rows without an id take part; a class of such rows only has no id. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wortfund.llm.common import dropped, hand_back_memory, packed, quoted, stored, words

#: Words in a k-mer, and the similarity from which texts are near-duplicates.
K, SIMILARITY = 5, 0.8
#: Sketches of a text, and k-mers in each: enough that texts at the edge of SIMILARITY share one, see the README.
SKETCHES, PICKS = 100, 2
#: Sketches whose groups are linked first; the others only link what these leave in different classes.
FIRST_SKETCHES = 3
#: Sketches whose groups are compared next; the groups of the others are only compared where these leave different classes.
ROUND_SKETCHES = 20
#: Bins of the word counts, and of those that are taken before every pair that is left is compared.
BINS, FINE_BINS = 128, 2048
#: Nodes to verify that are sent to every task: 100 bytes each.
BROADCAST_ROWS = 200_000
#: Words that a task sketches at a time, besides those of the text that goes beyond.
WORDS_AT_ONCE = 1 << 18
#: Members that one task compares with one another, or with up to twice as many outside the largest class. A member is sent to a task
#: for every block of those in its group.
CHUNK = 1024

# Multipliers of the hash functions that pick k-mers. 32 bits do: a tie between k-mers of a text only makes a sketch less telling.
_ODD = np.random.default_rng(17).integers(1, 2**31, SKETCHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_LAST = np.uint32(2**32 - 1)
#: The last bits of a sketch tell which of the SKETCHES it is.
_PLACES = (1 << (SKETCHES - 1).bit_length()) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _occurrences(doc: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each value, how many equal ones stand before it in its document."""
    out = np.zeros(len(x), dtype=np.uint64)
    # most stand once: only what a quick sort finds repeated is sorted by document, value and place
    key = _mixed(x + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(x), dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    places = np.flatnonzero(again)
    if len(places):
        order = places[np.lexsort((x[places], doc[places]))]  # stable
        s, d, at = x[order], doc[order], np.arange(len(order))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
        out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out


def sketches(word: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The sketches (a row each) of texts of so many words, one or more each, from the hashes of their words."""
    end, doc = np.cumsum(size), np.repeat(np.arange(len(size)), size)
    kmer = np.zeros(len(word), dtype=np.uint64)
    for k in range(K):
        # words past the end of a short text count as zero
        own = np.zeros(len(word), dtype=np.uint64)
        rest = max(0, len(word) - k)
        own[:rest] = np.where(doc[k:] == doc[:rest], word[k:], np.uint64(0))
        kmer = _mixed(kmer + own)
    count = np.maximum(1, size - K + 1)
    start = end - size
    valid = np.arange(len(word)) - start[doc] < count[doc]
    label = _mixed(kmer[valid] + _occurrences(doc[valid], kmer[valid]) * np.uint64(0x9E3779B97F4A7C15))
    short = (label >> np.uint64(32)).astype(np.uint32)
    begin = np.cumsum(count) - count
    at = np.empty((len(size), SKETCHES, PICKS), dtype=np.int64)
    every = np.arange(SKETCHES)
    room = np.empty(max(1 << 20, SKETCHES * int(min(count.max(initial=1), 1 << 14))), dtype=np.uint32)
    for d, (a, n) in enumerate(zip(begin, count)):
        step = max(1, 2**20 // n)  # sketches at a time, so that a very long text takes little memory
        for j in range(0, SKETCHES, step):
            odd = _ODD[j : j + step, None]
            h = room[: len(odd) * n].reshape(len(odd), n) if len(odd) * n <= len(room) else np.empty((len(odd), n), dtype=np.uint32)
            np.multiply(short[None, a : a + n], odd, out=h)
            for k in range(PICKS):
                least = h.argmin(axis=1)
                at[d, j : j + step, k] = a + least
                h[every[: len(h)], least] = _LAST
    # a text with fewer k-mers than picks gives the same one again
    at.sort(axis=2)
    out = np.broadcast_to(every.astype(np.uint64), at.shape[:2])
    for k in range(PICKS):
        out = _mixed(out * np.uint64(31) + label[at[:, :, k]])
    out = (out & ~np.uint64(_PLACES)) | every.astype(np.uint64)
    return out.view(np.int64)


def _slices(batches, most: int):
    """The rows of batches in order, so many at a time that their lists `words` hold `most` words and those of a last row."""
    for batch in batches:
        last = np.cumsum(np.diff(batch["words"].offsets.to_numpy()))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(np.maximum(last - 1, 0) // most)) + 1, [len(batch)]])
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def _signed(batches):
    for batch in _slices(batches, WORDS_AT_ONCE):
        flat = batch["words"]
        value = flat.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        size = np.diff(flat.offsets.to_numpy())
        full = size > 0
        every = sketches(value, size[full])
        ends = np.cumsum(size)
        bins = (value % np.uint64(BINS)).astype(np.int64)
        # a byte each: a full bin counts no further
        bags = [np.minimum(np.bincount(bins[e - n : e], minlength=BINS), 255).astype(np.uint8).tobytes() if n else None for e, n in zip(ends, size)]
        begin = np.concatenate([[0], np.cumsum(full * SKETCHES)]).astype(np.int32)
        yield pa.record_batch(
            [
                batch["id"],
                batch["key"],
                batch["node"],
                pa.array(size.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(begin), pa.array(every.reshape(-1)), mask=pa.array(~full)),
                pa.array(bags, pa.binary()),
            ],
            names=["id", "key", "node", "n", "sketches", "bag"],
        )
    hand_back_memory()


def _with_nodes(df: DataFrame) -> DataFrame:
    """df with `w`, the words of its column `text`, and `node`: the digest of the word sequence, or of the text
    itself where it has no word. Null for null."""
    sequence = F.when(F.size("w") == 0, F.concat(F.lit(" "), F.col("text"))).otherwise(F.array_join("w", " "))
    return df.withColumn("w", words(F.col("text"))).withColumn("node", F.unhex(F.when(F.col("text").isNotNull(), F.md5(sequence))))


def _key(text: str):
    """A narrow key of a text."""
    return F.xxhash64(text).alias("key")


def signatures(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, key of the text, node, n words, sketches, bag) of every row."""
    rows = _with_nodes(df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")))
    rows = rows.select("id", _key("text"), "node", F.transform("w", lambda w: F.xxhash64(w)).alias("words"))
    return rows.mapInArrow(_signed, "id long, key long, node binary, n long, sketches array<long>, bag binary")


def edit_distances(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Edit distances of pairs of int sequences as far as they are `band` or less; band + 1 for the rest.

    The pairs are aligned side by side; row i of the band holds the columns i - band to i + band.
    """
    n, m = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    out = np.full(len(pairs), band + 1, dtype=np.int64)
    big, width = 1 << 28, 2 * band + 1
    left = np.full((len(pairs), n.max(initial=0)), -1, dtype=np.int32)
    right = np.full((len(pairs), n.max(initial=0) + width), -2, dtype=np.int32)
    for p, (a, b) in enumerate(pairs):
        left[p, : len(a)] = a
        fits = b[: right.shape[1] - band]
        right[p, band : band + len(fits)] = fits
    step = np.arange(width, dtype=np.int32)
    row = np.where(step >= band, step - band, big).astype(np.int32)[None, :].repeat(len(pairs), axis=0)
    end = m - n + band
    inside = (end >= 0) & (end < width)
    for i in range(n.max(initial=0) + 1):
        if i:
            below = row[:, 1:] + 1
            row = row + (left[:, i - 1 : i] != right[:, i - 1 : i - 1 + width])
            np.minimum(row[:, :-1], below, out=row[:, :-1])
            row -= step
            np.minimum.accumulate(row, axis=1, out=row)
            row += step
        ended = np.flatnonzero((n == i) & inside)
        out[ended] = np.minimum(row[ended, end[ended]], band + 1)
        if i % 64 == 63 and (row.min(axis=1) > band)[n > i].all():
            break
    return out


def _numbered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sequences as small numbers, without their common beginning and end."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = differ[0] if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = differ[0] if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    number = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
    return number[: len(a)], number[len(a) :]


def _may_align(x: np.ndarray, y: np.ndarray, allowed: int) -> bool | None:
    """What bounds say of the edit distance of two texts as small numbers, None if they leave it open.

    It is no more than the words of the longer one, or than the places in which equally long ones differ; it
    is no less than the words of the longer one that have no partner in the other, wherever it stands.
    """
    longer = max(len(x), len(y))
    if longer <= allowed or (len(x) == len(y) and np.count_nonzero(x != y) <= allowed):
        return True
    kinds = 1 + max(x.max(initial=0), y.max(initial=0))
    common = np.minimum(np.bincount(x, minlength=kinds), np.bincount(y, minlength=kinds)).sum()
    return None if longer - common <= allowed else False


def alike(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float) -> list[bool]:
    """Whether each pair is within 1 - similarity of the longer one's words."""
    allowed = [int((1 - similarity) * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    verdict, parts, open_ = [False] * len(pairs), {}, []
    for p, (a, b) in enumerate(pairs):
        if abs(len(a) - len(b)) <= allowed[p]:
            x, y = _numbered(a, b)
            bound = _may_align(x, y, allowed[p])
            verdict[p] = bool(bound)
            if bound is None:
                parts[p] = x, y
                open_.append(p)
    band = 16
    while open_:
        open_.sort(key=lambda p: len(parts[p][0]))
        later = []
        many, at = max(1, 4096 // (2 * band + 1)), 0
        while at < len(open_):
            # pairs of about one length, side by side
            top = 1.3 * len(parts[open_[at]][0]) + 32
            some = [p for p in open_[at : at + many] if len(parts[p][0]) <= top]
            at += len(some)
            own = min(band, max(allowed[p] for p in some))
            for p, d in zip(some, edit_distances([parts[p] for p in some], own)):
                if d <= min(own, allowed[p]):
                    verdict[p] = True
                elif d > own and own < allowed[p]:
                    later.append(p)
        open_, band = later, band * 4
    return verdict


def _verify(similarity: float):
    def run(batches):
        for batch in batches:
            columns = []
            for name in ("wa", "wb"):
                flat = batch[name]
                value, offset = flat.flatten().to_numpy(zero_copy_only=False), flat.offsets.to_numpy() - flat.offsets[0].as_py()
                columns.append([value[a:b] for a, b in zip(offset, offset[1:])])
            yield pa.record_batch([batch["a"], batch["b"], pa.array(alike(list(zip(*columns)), similarity), pa.bool_())], names=["a", "b", "ok"])

    return run


def _possible(one: np.ndarray, rows: np.ndarray, n_one, n_rows, similarity: float, spare=None) -> np.ndarray:
    """Which rows may be similar to one: equal words are no more than the bins have in common, and the `spare`
    words that both have beyond full bins."""
    longer = np.maximum(n_one, n_rows)
    can = np.minimum(n_one, n_rows) >= similarity * longer - 1e-9
    hits = np.flatnonzero(can)
    common = np.minimum(one[None, :], rows[hits]).sum(axis=1, dtype=np.int64)
    if spare is not None:
        common += spare[hits]
    can[hits] = common >= similarity * longer[hits] - 1e-9
    return can


def _fine(batches):
    """(node, bag): the words of a node in FINE_BINS bins. Of a text with few words the bins themselves, two bytes a word; else a byte
    for each bin, and a full bin counts no further. _counts reads both."""
    for batch in batches:
        bags = []
        for words in batch["words"]:
            bins = (words.values.to_numpy().view(np.uint64) % np.uint64(FINE_BINS)).astype(np.uint16)
            if 2 * len(bins) < FINE_BINS:
                bags.append(np.sort(bins).tobytes())
            else:
                bags.append(np.minimum(np.bincount(bins, minlength=FINE_BINS), 255).astype(np.uint8).tobytes())
        yield pa.record_batch([batch["node"], pa.array(bags, pa.binary())], names=["node", "bag"])


def _counts(bags: list[bytes], bins: int) -> np.ndarray:
    """The word counts in so many bins, a row for each bag: a byte for each bin, or the bins of fewer words."""
    out = np.zeros((len(bags), bins), dtype=np.uint8)
    for row, bag in zip(out, bags):
        if len(bag) == bins:
            row[:] = np.frombuffer(bag, dtype=np.uint8)
        else:
            own, count = np.unique(np.frombuffer(bag, dtype=np.uint16), return_counts=True)
            row[own] = np.minimum(count, 255)
    return out


_PAIRS = "a binary, b binary"


def _in_groups(keys: list[str], pairs_of, bins: int):
    """pairs_of(columns of a group) for each run of equal keys in sorted rows. Many small groups share a batch;
    what is held besides is the last group, as far as it has come."""

    def pairs_in(table: pa.Table, cuts: np.ndarray):
        node, n = table["node"].to_pylist(), table["n"].to_numpy()
        bag = _counts(table["bag"].to_pylist(), bins)
        more = [table[c].to_numpy(zero_copy_only=False) for c in table.column_names if c not in (*keys, "node", "n", "bag")]
        found = []
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                found += pairs_of(node[a:b], n[a:b], bag[a:b], *[c[a:b] for c in more])
        ends = list(zip(*found)) or [(), ()]
        return pa.record_batch([pa.array(x, pa.binary()) for x in ends], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if not len(table):
                continue
            key = np.stack([table[k].to_numpy() for k in keys])
            cuts = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1])
            held = table.slice(int(cuts[-1]))
            yield pairs_in(table.slice(0, int(cuts[-1])), cuts)
        if held is not None:
            yield pairs_in(held, np.array([0, len(held)]))

    return run


def _paired(rows: DataFrame, keys: list[str], pairs_of, bins: int = BINS) -> DataFrame:
    """(a, b) of all groups; a group's rows come by n and node."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, "n", "node").mapInArrow(_in_groups(keys, pairs_of, bins), _PAIRS)


def _centres(similarity: float):
    """In a chunk, every member is paired with the first centre it may be similar to, or is a new centre."""

    def pairs_of(node, n, bag):
        free, pairs, spare = np.arange(len(node)), [], n - bag.sum(axis=1, dtype=np.int64)
        while len(free):
            rest = free[1:]
            can = _possible(bag[free[0]], bag[rest], n[free[0]], n[rest], similarity, np.minimum(spare[free[0]], spare[rest]))
            pairs += [(node[free[0]], node[i]) for i in rest[can]]
            free = rest[~can]
        return pairs

    return pairs_of


def _across(similarity: float, closest: bool):
    """In a cell, pairs of different classes: each minor member with its closest in the largest class, if it may be similar to
    one there, else with its closest in any; or all pairs, but those that have a lesser group in common (`less`: the groups
    of a member that are less than this one)."""

    def pairs_of(node, n, bag, label, major, minor, less):
        members, pairs = np.flatnonzero(~minor), []
        theirs, spare = bag[members], n - bag.sum(axis=1, dtype=np.int64)
        for i in np.flatnonzero(minor):
            hits = members[_possible(bag[i], theirs, n[i], n[members], similarity, np.minimum(spare[i], spare[members]))]
            hits = hits[label[hits] != label[i]]
            if closest and len(hits):
                common = np.minimum(bag[i][None, :], bag[hits]).sum(axis=1)
                hits = hits[np.lexsort((-common, ~major[hits]))[:1]]
            if len(less[i]):
                known = set(less[i].tolist())
                hits = [j for j in hits if known.isdisjoint(less[j].tolist())]
            pairs += [(min(node[i], node[j]), max(node[i], node[j])) for j in hits]
        return pairs

    return pairs_of


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the least node of the component, for edges (a, b).

    Alternating large and small stars; every round is stored, and only a count and a checksum are
    brought to the driver. The result lies in the last round's table, `stored_at`.
    """
    mark = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    state = last = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        edges = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = edges.where("a != b").distinct()
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a != b").distinct(), "stars")
        if last is not None:
            dropped(last)
        last, now = edges, mark(edges)
        if now == state:
            break
        state = now
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
    out.stored_at = edges.stored_at
    return out


class _Graph:
    """The nodes' texts, the pairs tested so far, and the classes they make."""

    def __init__(self, df: DataFrame, nodes: DataFrame, id_col, text_col, similarity):
        self.texts = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")).select("*", _key("text"))
        self.nodes, self.similarity, self.tested, self.labels = nodes, similarity, None, None

    def words(self, nodes: DataFrame) -> DataFrame:
        """(node, words) of distinct nodes, the words as hashes."""
        wanted = nodes.join(self.nodes.select("node", "rep", "rep_key"), "node")
        wanted = stored(wanted.select("rep", "rep_key", F.col("node").alias("wanted")), "wanted")
        # few nodes go to the documents; beyond that, documents and nodes meet by id and text: an id, or null, may
        # stand on many rows with other texts
        small = wanted.count() <= BROADCAST_ROWS
        same = (F.col("key") == F.col("rep_key")) & F.col("id").eqNullSafe(F.col("rep"))
        text = stored(self.texts.join(F.broadcast(wanted) if small else wanted, same), "found")
        # one row of each node; rows may be repeated, and the key is a hash. Stored before, so that the digests of
        # all documents do not become a key of that join
        found = text
        text = _with_nodes(text).where("node = wanted").select("node", F.transform("w", lambda x: F.xxhash64(x)).alias("words"))
        text = stored(text.dropDuplicates(["node"]), "texts")
        dropped(wanted, found)
        return text

    def test(self, pairs: DataFrame, *made_from: DataFrame) -> None:
        """Verify pairs not tested before, and join what they link. made_from: stored tables that only the pairs need."""
        new = pairs.distinct()
        if self.tested is not None:
            new = new.join(self.tested, ["a", "b"], "left_anti")
        new = stored(new, "pairs")
        dropped(*made_from)
        if new.isEmpty():
            dropped(new)
            return
        text = self.words(new.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        both = new.join(text.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a").join(
            text.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b"
        )
        found = both.select("a", "b", "wa", "wb").mapInArrow(_verify(self.similarity), "a binary, b binary, ok boolean")
        done = stored(found, "verified")
        dropped(new, text)
        self.tested = done if self.tested is None else self.tested.unionByName(done)
        edges, old = done.where("ok").select("a", "b"), self.labels
        if old is not None:  # what hangs together so far goes in as stars
            edges = edges.unionByName(old.select(F.col("label").alias("a"), F.col("node").alias("b")))
        self.labels = components(edges)
        if old is not None:
            dropped(old)


def near_duplicates(df: DataFrame, id_col="doc_id", text_col="text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (id, node) for every row of df; classes (node, class_id, class_rep):
    class_id is the least id of the class, class_rep the (id, node) that stands for it."""
    signed = stored(signatures(df, id_col, text_col), "signatures")
    info = signed.where("node IS NOT NULL").groupBy("node")
    # id and text of one and the same row: the least id, null only where there is no other
    rep = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("of")
    info = info.agg(rep, F.first("n").alias("n"), F.first("bag").alias("bag"), F.first("sketches").alias("sketches"))
    # a number for each node, which takes less room than its digest; it is written down, so that it stays
    number = F.monotonically_increasing_id().alias("no")
    full = stored(info.select(number, "node", F.col("of.id").alias("rep"), F.col("of.key").alias("rep_key"), "n", "bag", "sketches"), "nodes")
    rows = stored(signed.select("id", "node"), "rows")
    dropped(signed)
    members = _members(full)
    nodes = stored(full.select("node", "rep", "rep_key"), "nodes")
    dropped(full)
    graph = _Graph(df, nodes, id_col, text_col, similarity)
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / CHUNK)).alias("chunk")
    first = members.where(_place("s") < FIRST_SKETCHES).select("s", chunk, "node", "n", "bag")
    centred = _paired(first, ["s", "chunk"], _centres(similarity))
    graph.test(centred.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    for of_round in (_place("s") < ROUND_SKETCHES, _place("s") >= ROUND_SKETCHES):
        for closest in (True, False):
            graph.test(*_open_pairs(members.where(of_round), graph, similarity, closest))
    dropped(members)
    own = nodes.select("node", "rep")
    labelled = own.withColumn("label", F.col("node")) if graph.labels is None else own.join(graph.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("id"), F.col("node").alias("node")))
    by_label = labelled.groupBy("label").agg(least.alias("class_rep"))
    classes = labelled.join(by_label, "label").select("node", F.col("class_rep.id").alias("class_id"), "class_rep")
    return rows.select("id", "node"), classes


def _place(sketch: str):
    """Which of the SKETCHES a sketch is: its last bits."""
    return F.col(sketch).bitwiseAND(F.lit(_PLACES))


def _members(nodes: DataFrame) -> DataFrame:
    """(s, size, node, n, bag) of the nodes in each group, the nodes with sketch s; of groups with the same nodes the first.

    What every sketch of every node moves is a count by sketch, and the node's number to the sketches that are shared.
    """
    keyed = nodes.where("n > 0").select("no", F.explode("sketches").alias("s"))
    shared = keyed.groupBy("s").agg(F.count("*").alias("size")).where("size > 1").select("s")
    linked = stored(keyed.join(shared, "s"), "linked")
    groups = linked.groupBy("s").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("no")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "no")).alias("y")
    )
    first = F.min(F.struct(_place("s").alias("place"), "s")).alias("first")
    groups = groups.groupBy("size", "x", "y").agg(first).select(F.col("first.s").alias("s"), "size")
    of_groups = linked.join(groups, "s").join(nodes.select("no", "node", "n", "bag"), "no")
    members = stored(of_groups.select("s", "size", "node", "n", "bag"), "members")
    dropped(linked)
    return members


def _open_pairs(members: DataFrame, graph: _Graph, similarity: float, closest: bool) -> tuple[DataFrame, ...]:
    """Pairs that may be similar, of members of a group that lie in different classes so far; and the stored tables that they need.

    The class with most members of a group is only compared with the others. These lie in blocks,
    all members in chunks; each block meets each chunk in a cell of its own. For its closest one, a member is compared in its smallest
    group only. Where every pair is wanted, their words are read again for finer bins: these leave far fewer pairs of long texts.
    """
    labels = graph.labels
    known = members.withColumn("label", F.col("node")) if labels is None else members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    by_class = known.groupBy("s", "label").agg(F.count("*").alias("k"))
    apart = by_class.groupBy("s").agg(F.count("*").alias("classes"), F.max(F.struct("k", "label")).alias("most")).where("classes > 1")
    shape = apart.select("s", F.col("most.label").alias("major"))
    open_ = stored(known.join(shape, "s"), "open")
    minors, tables = open_.where("label != major"), [open_]
    if closest:
        smallest = minors.groupBy("node").agg(F.min(F.struct("size", "s")).alias("least")).select("node", F.col("least.s").alias("s"))
        minors = minors.join(smallest, ["node", "s"], "left_semi")
        alls, bins = open_.withColumn("less", F.array().cast("array<bigint>")), BINS
        minors = minors.withColumn("less", F.array().cast("array<bigint>"))
    else:
        text = graph.words(open_.select("node").distinct())
        fine = stored(text.mapInArrow(_fine, "node binary, bag binary"), "fine")
        dropped(text)
        # the groups of a node, so that a pair comes up in the least that both are in. The bins meet a node once, before its groups
        # are told apart, and these are told apart once, for both sides of the cells
        groups = F.collect_list(F.struct("s", "size", "major")).alias("groups")
        of_node = open_.groupBy("node").agg(F.first("n").alias("n"), F.first("label").alias("label"), groups).join(fine, "node")
        alls, bins = of_node.select("*", F.inline("groups")), FINE_BINS
        alls = stored(alls.withColumn("less", F.filter("groups.s", lambda g: g < F.col("s"))).drop("groups"), "apart")
        dropped(fine)
        minors = alls.where("label != major")
        tables.append(alls)
    blocks = minors.groupBy("s").agg(F.ceil(F.count("*") / (2 * CHUNK)).alias("blocks"))
    part = lambda n: F.pmod(F.xxhash64("node"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    chunks = F.ceil(F.col("size") / CHUNK)
    columns = ["s", "node", "n", "bag", "label", (F.col("label") == F.col("major")).alias("largest"), "less"]
    minors = minors.join(blocks, "s").select(*columns, F.lit(True).alias("minor"), part(F.col("blocks")).alias("block"), every(chunks).alias("chunk"))
    alls = alls.join(blocks, "s").select(*columns, F.lit(False).alias("minor"), part(chunks).alias("chunk"), every(F.col("blocks")).alias("block"))
    cells = minors.unionByName(alls).select("s", "block", "chunk", "node", "n", "bag", "label", "largest", "minor", "less")
    return _paired(cells, ["s", "block", "chunk"], _across(similarity, closest), bins), *tables


def classify(df: DataFrame, id_col="doc_id", text_col="text", similarity: float = SIMILARITY) -> DataFrame:
    """(id, class_id) for every row of df; class_id is the least id of its near-duplicates."""
    rows, classes = near_duplicates(df, id_col, text_col, similarity)
    return rows.join(classes.select("node", "class_id"), "node", "left").select(
        "id", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id")
    )


def keep_one(df: DataFrame, id_col="doc_id", text_col="text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of df, as they are, that stand for their class: the least id; one row of repeated ones.
    Rows without a text all stay."""
    _, classes = near_duplicates(df, id_col, text_col, similarity)
    stay = classes.where("node = class_rep.node").select("node", F.col("class_rep.id").alias("id"))
    rows = _with_nodes(df.select(packed(df), quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")))
    # the partition number, which the window reads, keeps filters from being pushed below the digests and repeating them
    rows = rows.select("row", "id", "node", F.spark_partition_id().alias("at"))
    kept = rows.alias("r").join(stay.alias("s"), (F.col("r.node") == F.col("s.node")) & F.col("r.id").eqNullSafe(F.col("s.id")), "left_semi")
    first = Window.partitionBy("node", "id").orderBy("at")
    kept = kept.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
    return kept.unionByName(df.where(quoted(text_col).isNull()))

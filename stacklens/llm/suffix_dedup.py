"""Removal of passages that occur twice, by sorting suffixes deep and shallow.

A suffix array of every byte would shuffle the corpus many times over. Only suffixes that can
have a twin are sorted: each window of ``LENGTH`` bytes is represented by its anchor, the piece of
``GRAM`` bytes with the least hash in it, so equal windows have equal anchors at equal offsets. Anchors
whose hash occurs once, nearly all, are dropped; the windows of the others meet by hash and are sorted.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import join_checked, whole, whole_groups, written

LENGTH = 200
GRAM = 64
#: Windows of a long text that are worked on at once.
SEGMENT = 1 << 20
#: Anchors of one hash that one task sorts; the windows of more are dealt out by content.
HOT = 20_000
#: Contexts that one sort takes.
SORT_ROWS = 10_000
#: Bytes of the digest that stands for a window of a hot hash.
DIGEST = 16
#: Parts over which further anchors of one hash from one batch are spread.
SPREAD = 1024
#: Depth in bytes, a multiple of 8, from which tied suffixes go to blind tries.
SHALLOW = 32

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = SEGMENT + 2 * LENGTH
    def powers(b):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, b, dtype=np.uint64))])
    return powers(np.uint64(BASE)), powers(np.uint64(pow(BASE, -1, 1 << 64)))


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes that start at each place, from prefix sums modulo 2^64; never 0."""
    up, down = _powers()
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    h = sums[gram:] - sums[:-gram]
    h *= down[:len(h)]
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    return h | np.uint64(1)


def _sliding(x: np.ndarray, w: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` of each ``w`` neighbours: of the end of one block of ``w`` and the start of the next."""
    n = len(x)
    padded = np.full(-(-n // w) * w, fill, dtype=x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    heads = best.accumulate(blocks, axis=1).reshape(-1)
    tails = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(tails[:n - w + 1], heads[w - 1:n])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(hash, place, first, last) of each anchor: the windows that start at first … last have it.

    The anchor of a window is its leftmost piece of least hash. Each window has one.
    """
    w, found = length - gram + 1, []
    n_windows = len(data) - length + 1
    for at in range(0, n_windows, SEGMENT):
        n = min(SEGMENT, n_windows - at)
        h = gram_hashes(data[at:at + n + length - 1], gram)
        least = _sliding(h, w, np.minimum, np.iinfo(np.uint64).max)
        around = np.concatenate([np.zeros(w - 1, dtype=np.uint64), least, np.zeros(w - 1, dtype=np.uint64)])
        place = np.flatnonzero(_sliding(around, w, np.maximum, 0) == h)
        value = h[place]
        # An anchor takes over when it comes into sight, being less, or when the one before is passed.
        first = np.zeros(len(place) + 1, dtype=np.int64)
        first[1:-1] = np.where(value[1:] < value[:-1], place[1:] - w + 1, place[:-1] + 1)
        first[-1] = n
        first = np.minimum.accumulate(first[::-1])[::-1]
        real = first[:-1] < first[1:]
        found.append((value[real], place[real] + at, first[:-1][real] + at, first[1:][real] + at - 1))
    if not found:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found))


# --- sorting -----------------------------------------------------------------------------

class BlindTrie:
    """Strings of one length: inner nodes know only the place at which their strings part.

    A string descends by the bytes at those places alone, is compared with the leaf it
    reaches, and is inserted where they differ first.
    """

    def __init__(self):
        self.root: list | None = None

    def insert(self, text: bytes, key: int) -> None:
        if self.root is None:
            self.root = [None, text, [key]]
            return
        node = self.root
        while node[0] is not None:
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        other = node[1]
        if other == text:
            node[2].append(key)
            return
        differ = int.from_bytes(text, "big") ^ int.from_bytes(other, "big")
        common = len(text) - (differ.bit_length() + 7) // 8
        parent, node = None, self.root
        while node[0] is not None and node[0] < common:
            parent, node = node, node[1][text[node[0]]]
        leaf = [None, text, [key]]
        if node[0] == common:
            node[1][text[common]] = leaf
            return
        inner = [common, {other[common]: node, text[common]: leaf}]
        if parent is None:
            self.root = inner
        else:
            parent[1][text[parent[0]]] = inner

    def ordered(self) -> Iterator[list[int]]:
        """Keys of equal strings together, in the order of the strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]


def repeated_suffixes(buffer: bytes, starts: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> np.ndarray:
    """Whether the ``length`` bytes from each start occur from another one too.

    Multikey quicksort to depth ``shallow``: the suffixes are parted by eight bytes at a time, and
    only those that tie go on to the next eight. What still ties shares a long prefix and
    is ordered by a blind trie for each such group.
    """
    repeated = np.zeros(len(starts), dtype=bool)
    data = np.frombuffer(buffer + b"\0" * 8, dtype=np.uint8)
    active = np.arange(len(starts))
    group = np.zeros(len(starts), dtype=np.int64)
    for depth in range(0, min(shallow, length // 8 * 8), 8):
        at = starts[active] + depth
        word = np.zeros(len(active), dtype=np.uint64)
        for k in range(8):
            word = word << np.uint64(8) | data[at + k]
        order = np.lexsort((word, group))
        active, word, group = active[order], word[order], group[order]
        new = np.ones(len(active) + 1, dtype=bool)
        new[1:-1] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
        tied = ~(new[:-1] & new[1:])
        group = np.cumsum(new[:-1])[tied]
        active = active[tied]
    ends = np.flatnonzero(np.diff(group)) + 1
    for members in np.split(active, ends) if len(active) else []:
        trie = BlindTrie()
        for key, s in zip(members.tolist(), starts[members].tolist()):
            trie.insert(buffer[s + shallow:s + length], key)
        for keys in trie.ordered():
            if len(keys) > 1:
                repeated[keys] = True
    return repeated


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def repeated_spans(groups: list, contexts: list[bytes], lefts: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each context, the spans of it that are covered by windows with a twin.

    A context has the text of the windows of one anchor, ``left`` bytes of it before the anchor;
    ``groups`` tells which contexts have anchors of equal hash. Equal contexts are sorted as one.
    A context shorter than ``length`` is the digest of one window; an empty one is known to
    repeat whole, and ``left`` is its length.
    """
    owners: defaultdict[tuple, list[int]] = defaultdict(list)
    spans: list[list[tuple[int, int]]] = [[] for _ in contexts]
    for i, key in enumerate(zip(groups, lefts, contexts)):
        if key[2]:
            owners[key].append(i)
        else:
            spans[i] = [(0, key[1])]
    kinds: defaultdict[object, list[tuple]] = defaultdict(list)
    for key in owners:
        if len(key[2]) >= length:
            kinds[key[0]].append(key)
    alone: list[tuple] = []
    for key, who in owners.items():
        if len(who) > 1:
            for i in who:
                spans[i] = [(0, max(length, len(key[2])))]
    for keys in kinds.values():
        if len(keys) > 1 and any(len(owners[k]) == 1 for k in keys):
            alone += keys
    if alone:
        n_windows = [len(k[2]) - length + 1 for k in alone]
        at = np.cumsum([0, *[len(k[2]) for k in alone]])
        starts = np.concatenate([np.arange(a, a + n) for a, n in zip(at.tolist(), n_windows)])
        flags = np.split(repeated_suffixes(b"".join(k[2] for k in alone), starts, length), np.cumsum(n_windows)[:-1])
        for key, flag in zip(alone, flags):
            who = owners[key]
            if len(who) == 1:
                spans[who[0]] = [(a, b + length - 1) for a, b in _runs(flag)]
    return spans


# --- on Spark ----------------------------------------------------------------------------

KEY = ("th", "size")


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors as rows. Of those with one hash in a batch one meets other batches; the rest are sure of
    a twin already and are spread, so a hash that is everywhere sends one row per batch to one task."""
    for batch in batches:
        parts, n = [], 0
        for i, text in enumerate(batch["text"]):
            h, place, first, last = anchors(np.frombuffer(text.as_buffer(), dtype=np.uint8))
            if len(h):
                code = place << 16 | (place - first) << 8 | (last - first)
                parts.append((h.view(np.int64), np.full(len(h), i), code))
                n += len(h)
            if n > 200_000 or parts and i + 1 == len(batch):
                h, who, code = (np.concatenate(c) for c in zip(*parts))
                order = np.argsort(h, kind="stable")
                h, who, code = h[order], who[order], code[order]
                new = np.ones(len(h) + 1, dtype=bool)
                new[1:-1] = h[1:] != h[:-1]
                salt = np.where(new[:-1], 0, 1 + np.arange(len(h)) % SPREAD).astype(np.int32)
                keys = [batch[c].take(pa.array(who)) for c in KEY]
                sure = pa.array(~(new[:-1] & new[1:]))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(salt), sure, *keys, pa.array(code)], ["h", "salt", "sure", *KEY, "code"])
                parts, n = [], 0


def _with_twin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by h and salt, that are sure of a twin or stand next to one; one row is held back at a time."""
    held, has_twin = None, False
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        table = (pa.concat_tables([held, table]) if held else table).combine_chunks()
        h, salt = table["h"].to_numpy(), table["salt"].to_numpy()
        same = (h[1:] == h[:-1]) & (salt[1:] == salt[:-1])
        keep = table["sure"].to_numpy().copy()
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= has_twin
        out = table.select(["h", *KEY, "code"])
        yield from out.slice(0, len(h) - 1).filter(pa.array(keep[:-1])).to_batches()
        held, has_twin = table.slice(len(h) - 1), bool(keep[-1])
    if held and has_twin:
        yield from held.select(["h", *KEY, "code"]).to_batches()


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of anchors as rows.

    For a hot hash the rows are windows, each by its digest, dealt by it, so equal ones still meet.
    Contexts that are equal within a batch are known to repeat whole: one gives its windows
    for others to meet, and each has one row without a text, of its length.
    """
    names = ["h", "salt", "left", "first", *KEY, "context"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        rows: list[tuple] = []
        hot: defaultdict[tuple, list[tuple]] = defaultdict(list)
        for i in range(len(batch)):
            text, th, size = batch["text"][i].as_py(), batch["th"][i].as_py(), batch["size"][i].as_py()
            list_of = batch["list"][i].values
            for h, code, is_hot in zip(*[list_of.field(k).to_pylist() for k in range(3)]):
                left = code >> 8 & 255
                first = (code >> 16) - left
                context = text[first:first + (code & 255) + LENGTH]
                if is_hot:
                    hot[h, left, context].append((first, th, size))
                else:
                    rows.append((h, 0, left, first, th, size, context))
            if i + 1 == len(batch):
                for (h, left, context), where in hot.items():
                    if len(where) > 1:
                        rows += [(h, th, len(context), first, th, size, b"") for first, th, size in where]
                    first, th, size = where[0]
                    for k in range(len(context) - LENGTH + 1):
                        digest = hashlib.blake2b(context[k:k + LENGTH], digest_size=DIGEST).digest()
                        rows.append((h, int.from_bytes(digest[:8], "little", signed=True), left - k, first + k, th, size, digest))
                        if len(rows) > 20_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows = []
            if len(rows) > 20_000 or rows and i + 1 == len(batch):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows = []


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, ("h", "salt"), SORT_ROWS):
        groups = list(zip(table["h"].to_pylist(), table["salt"].to_pylist()))
        found = repeated_spans(groups, table["context"].to_pylist(), table["left"].to_pylist())
        who = np.repeat(np.arange(len(found)), [len(s) for s in found])
        if len(who):
            take = table.take(pa.array(who)).combine_chunks()
            first = take["first"].to_numpy()
            a, b = (np.array([s[k] for spans in found for s in spans], dtype=np.int64) for k in (0, 1))
            arrays = [*[take[c].chunk(0) for c in KEY], pa.array(first + a), pa.array(first + b)]
            yield pa.RecordBatch.from_arrays(arrays, [*KEY, "start", "end"])


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of spans given as rows (start, end) in any order; touching spans join."""
    out: list[list[int]] = []
    for a, b in spans[np.lexsort((spans[:, 1], spans[:, 0]))].tolist():
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _with_found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, found): the text in bytes and the spans to remove, unordered, overlapping, null if none."""
    text = whole(text_col)
    # Identifies a row; rows that agree in it have the same id and text, and the same spans.
    texts = docs.select(F.xxhash64(F.col(id_col), text).alias("th"), F.octet_length(text).cast("long").alias("size"),
                        F.col(id_col).alias("id"), text.cast("binary").alias("text"))
    rows = texts.where(F.col("size") >= LENGTH).select(*KEY, "text").mapInArrow(_anchor_rows, "h bigint, salt int, sure boolean, th bigint, size bigint, code bigint")
    twins = written(rows.repartition("h", "salt").sortWithinPartitions("h", "salt").mapInArrow(
        _with_twin, "h bigint, th bigint, size bigint, code bigint"), "anchors")
    counts = twins.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT)
    hot = written(counts.select(F.col("h").alias("hh"), F.lit(True).alias("hot")), "hot")
    marked = join_checked(twins, hot, F.col("h") == F.col("hh"), "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    lists = marked.groupBy(*KEY).agg(F.collect_set(F.struct("h", "code", "hot")).alias("list"))
    contexts = texts.join(lists, list(KEY)).mapInArrow(
        _context_rows, "h bigint, salt bigint, left int, first bigint, th bigint, size bigint, context binary")
    dealt = contexts.repartition("h", "salt").sortWithinPartitions("h", "salt")
    spans = dealt.mapInArrow(_span_rows, "th bigint, size bigint, start bigint, end bigint")
    removed = spans.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("found"))
    return texts.join(removed, list(KEY), "left").select("id", "text", "found")


def _pairs(found: pa.ListScalar) -> list[tuple[int, int]]:
    return merged(np.column_stack([found.values.field(k).to_numpy() for k in (0, 1)])) if found.is_valid else []


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text (binary), spans (array of (start, end) to remove, in bytes, ordered).

    A byte goes when a string of ``LENGTH`` bytes that covers it starts anywhere else too, in the same
    document or another; overlapping starts count, and strings never cross documents. Null
    texts are empty; texts under ``LENGTH`` bytes lose nothing. Repeated rows are documents of
    their own, so they are copies of each other. An empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = pa.array([[{"start": a, "end": b} for a, b in _pairs(x)] for x in batch["found"]], kind)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["text"], spans], ["id", "text", "spans"])

    found = _with_found(docs, id_col, text_col)
    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"id {kind}, text binary, spans array<struct<start:bigint,end:bigint>>").withColumnRenamed("id", id_col)


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def passage_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes that stay; otherwise as ``repeated_passages``."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(batch["text"], batch["found"]):
                text, pairs = text.as_py(), _pairs(found)
                rows.append((len(text), sum(b - a for a, b in pairs), len(pairs), hashlib.sha256(kept_bytes(text, pairs)).hexdigest()))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch["id"], *[pa.array(c, t) for c, t in zip(columns, types)]],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = _with_found(docs, id_col, text_col)
    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string").withColumnRenamed("id", id_col)

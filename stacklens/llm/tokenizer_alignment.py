"""Two tokenizers side by side: groups between common cuts, and how often their tokens meet.

Token bytes of both follow the same text, so the tokens of a whole batch are two partitions of
one line of bytes. Where one token of A covers exactly one of B and a precomputed array says the same,
the pair is counted in a vector as long as A's vocabulary; only other pairs are counted by a shuffle.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import whole, written

#: Distinct pairs of ids that a counting task holds before it hands on their counts.
PAIRS_HELD = 2_000_000
#: Pair counts that are broadcast; more are joined by a shuffle.
BROADCAST_PAIRS = 4_000_000
#: Code points of texts that are tokenised at a time.
TEXT_AT_ONCE = 500_000
#: Parts of texts whose ids a Python worker remembers, twice at most, and code points of those too long for it.
PARTS_REMEMBERED, LONG_PART = 200_000, 64


# --- the two tokenizers ------------------------------------------------------------------

def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write a byte as its Latin-1 character where visible, else as the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a sentence piece: U+2581 is a space, <0xHH> one byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("\u2581", " ").encode()


# A byte-level tokenizer always cuts before a single space between two characters that are none.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r" (?=\s)|(?<=\s) ")


def _parts(text: str) -> list[str]:
    """``text`` cut at such spaces; where all of its spaces are such, simply at spaces."""
    if text[:1] == " " or text[-1:] == " " or _OTHER_SPACE.search(text):
        return _BETWEEN.split(text)
    return text.split(" ")


class _Remembered:
    """A's ids, as bytes, of a space and what follows up to the next such space; each is encoded once while remembered."""

    def __init__(self, tokenizer, length: np.ndarray):
        self.tokenizer, self.length = tokenizer, length
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def _learn(self, parts: list[str]) -> None:
        """Encodes many parts as one text and cuts its ids by their bytes. Parts that begin with white space go alone."""
        joined = [p for p in parts if p and not p[0].isspace()]
        alone = [p for p in parts if not p or p[0].isspace()]
        for part, ids in zip(alone, self._library(alone)):
            self.now[part] = ids.tobytes()
        if not joined:
            return
        ids = self._library([" ".join(joined)])[0]
        stops = np.searchsorted(np.cumsum(self.length[ids]), np.cumsum([len(p.encode()) + 1 for p in joined]), side="right")
        raw, at = ids.tobytes(), 0
        for part, stop in zip(joined, (4 * stops).tolist()):
            self.now[part] = raw[at:stop]
            at = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of a space and each text."""
        if len(self.now) > PARTS_REMEMBERED:
            self.now, self.before = {}, self.now
        cut = [_parts(t) for t in texts]
        unseen = set(itertools.chain.from_iterable(cut)).difference(self.now)
        known = [p for p in unseen if p in self.before]
        self.now.update((p, self.before[p]) for p in known)
        self._learn(list(unseen.difference(known)))
        made = [b"".join(map(self.now.__getitem__, parts)) for parts in cut]
        for p in unseen:
            if len(p) > LONG_PART:
                del self.now[p]
        return made


class TokenizerPair:
    """A: a byte-level file of the tokenizers library. B: a sentencepiece model that adds the space in front."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(path_a)
        a.encode_special_tokens = True
        a.no_truncation()
        a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        symbols = _byte_of_symbol()
        special = {t["content"] for t in json.loads(a.to_str())["added_tokens"]}
        vocab = a.get_vocab()
        bytes_a = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            if token not in special:
                bytes_a[i] = bytes(symbols[c] for c in token)
        bytes_b = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.bytes_a, self.bytes_b = pa.array(bytes_a, pa.binary()), pa.array(bytes_b, pa.binary())
        self.length_a, self.length_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (bytes_a, bytes_b))
        self.a = _Remembered(a, self.length_a)
        # The B id with the same bytes; single-byte pieces give way to ordinary ones, control ids stay out.
        same: dict[bytes, int] = {}
        for i, value in enumerate(bytes_b):
            if self.b.is_byte(i):
                same.setdefault(value, i)
            elif not (self.b.is_control(i) or self.b.is_unknown(i)):
                same[value] = i
        self.same = np.array([same.get(x, -1) if x else -1 for x in bytes_a], dtype=np.int64)
        self.size_b = len(bytes_b)
        # The text of the digests: each id behind the sign that parts it from the token before.
        numbers = [str(i).encode() for i in range(max(len(bytes_a), self.size_b))]
        self.signs = pa.array([sign + x for sign in (b",", b";", b"|") for x in numbers], pa.binary())
        self.numbers = len(numbers)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both, empty where the bytes of either differ from a space and the text."""
        found_a = [np.frombuffer(x, dtype="<u4") for x in self.a.encode(texts)]
        found_b = [np.array(x, dtype="<u4") for x in self.b.encode(texts, num_threads=1)]
        right = [bool(t) for t in texts]
        raw = [b" " + t.encode() for t in texts]
        for found, table in ((found_a, self.bytes_a), (found_b, self.bytes_b)):
            sizes = [len(x) for x in found]
            for i, got in enumerate(_joined_runs(table, np.concatenate(found), sizes)):
                right[i] = right[i] and got == raw[i]
        none = np.zeros(0, dtype=np.uint32)
        return [(a, b) if r else (none, none) for a, b, r in zip(found_a, found_b, right)]


def _joined_runs(table: pa.Array, ids: np.ndarray, sizes: list[int]) -> list[memoryview]:
    """The strings of ``table`` at ``ids``, joined run by run."""
    if not len(ids):
        return [memoryview(b"")] * len(sizes)
    taken = table.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], dtype=np.int32)
    ends = offsets[np.concatenate(([0], np.cumsum(sizes)))].tolist()
    data = memoryview(taken.buffers()[2]).cast("B")
    return [data[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def tokenizer_pair(path_a: str, path_b: str) -> TokenizerPair:
    return TokenizerPair(path_a, path_b)


# --- alignment ---------------------------------------------------------------------------

def align(pair: TokenizerPair, ids: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, regular, irregular) of each text.

    Every stretch between neighbouring cuts of either side is one link, since two overlapping tokens
    overlap in one stretch. ``groups`` is the digest of all groups; ``regular`` has the A ids of one-to-one groups
    with the precomputed partner, ``irregular`` the codes (A id times vocabulary of B, plus B id) of all other links.
    """
    sizes_a, sizes_b = (np.array([len(p[k]) for p in ids], dtype=np.int64) for k in (0, 1))
    a, b = (np.concatenate([p[k] for p in ids]) if ids else np.zeros(0, np.uint32) for k in (0, 1))
    ends_a, ends_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    is_end = [np.zeros(1 + (int(ends_a[-1]) if len(a) else 0), dtype=bool) for _ in (0, 1)]
    is_end[0][ends_a] = True
    is_end[1][ends_b] = True
    cuts = np.flatnonzero(is_end[0] | is_end[1])
    cut_a, cut_b = is_end[0][cuts], is_end[1][cuts]
    # The token that ends at a cut or covers it is the one after all that ended before.
    link_a, link_b = a[np.cumsum(cut_a, dtype=np.int32) - cut_a], b[np.cumsum(cut_b, dtype=np.int32) - cut_b]
    common = cut_a & cut_b
    opens = np.concatenate((np.ones(min(1, len(cuts)), dtype=bool), common[:-1]))
    regular = opens & common & (pair.same[link_a] == link_b)
    codes = link_a.astype(np.int64) * pair.size_b + link_b

    group_of_cut = np.cumsum(opens, dtype=np.int32) - 1
    group_a, group_b = group_of_cut[cut_a], group_of_cut[cut_b]
    n_groups = int(common.sum())
    before_a, before_b = (np.concatenate(([0], np.cumsum(np.bincount(g, minlength=n_groups)))) for g in (group_a, group_b))
    signs = np.empty(len(a) + len(b), dtype=np.int32)
    first_a, first_b = (np.concatenate((np.ones(min(1, len(g)), dtype=bool), g[1:] != g[:-1])) for g in (group_a, group_b))
    signs[np.arange(len(a)) + before_b[group_a]] = a + np.where(first_a, pair.numbers, 0)
    signs[np.arange(len(b)) + before_a[group_b + 1]] = b + np.where(first_b, 2 * pair.numbers, 0)
    texts = _joined_runs(pair.signs, signs, (sizes_a + sizes_b).tolist())

    doc_ends = np.concatenate(([0], ends_a))[np.cumsum(sizes_a)]
    last_cut = np.searchsorted(cuts, doc_ends, side="right")
    groups_before = np.concatenate(([0], np.cumsum(common)))
    n_regular, n_irregular = (np.concatenate(([0], np.cumsum(x)))[last_cut] for x in (regular, ~regular))
    all_regular, all_irregular = link_a[regular].astype("<u4"), codes[~regular].astype("<i8")
    made, cut, at, other = [], 0, 0, 0
    for n_a, n_b, stop, end, last, text in zip(sizes_a.tolist(), sizes_b.tolist(), last_cut.tolist(), n_regular.tolist(),
                                               n_irregular.tolist(), texts):
        made.append((n_a, n_b, int(groups_before[stop] - groups_before[cut]), stop - cut, hashlib.sha256(text[1:]).hexdigest() if n_a else "",
                     all_regular[at:end], all_irregular[other:last]))
        cut, at, other = stop, end, last
    return made


_ALIGNED = ["id", "rid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "regular", "irregular"]
ALIGNED = ("id {id}, rid bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "regular binary, irregular binary")


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts, the digest of its groups and the links it has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(path_a, path_b)
        for batch in batches:
            texts = batch["text"].to_pylist()
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) <= TEXT_AT_ONCE):
                    size += len(texts[stop])
                    stop += 1
                made = align(pair, pair.encode(texts[at:stop]))
                columns = list(zip(*made))
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(at, stop - at), batch["rid"].slice(at, stop - at), *[pa.array(c, pa.int64()) for c in columns[:4]],
                     pa.array(columns[4], pa.string()), *[pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[5:]]], _ALIGNED)
                at = stop

    df = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"), whole(text_col).alias("text"))
    return df.mapInArrow(run, ALIGNED.format(id=df.schema["id"].dataType.simpleString()))


# --- counts ------------------------------------------------------------------------------

def pair_counts(rows: DataFrame, same: np.ndarray, size_b: int) -> DataFrame:
    """(code, b, n, regular): how many links of all documents each pair of ids has.

    A task adds the regular links up in one vector over A's ids and hands on one row per id and per
    irregular pair; ``regular`` tells the pairs of the precomputed array.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(same), dtype=np.int64)
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out(codes, counts):
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

        for batch in batches:
            vector += np.bincount(np.frombuffer(b"".join(batch["regular"].to_pylist()), dtype="<u4"), minlength=len(same))
            new, times = np.unique(np.frombuffer(b"".join(batch["irregular"].to_pylist()), dtype="<i8"), return_counts=True)
            codes, place = np.unique(np.concatenate((codes, new)), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate((counts, times)), minlength=len(codes)).astype(np.int64)
            if len(codes) > PAIRS_HELD:
                yield out(codes, counts)
                codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = np.flatnonzero(vector)
        yield out(seen * size_b + same[seen], vector[seen])
        yield out(codes, counts)

    found = rows.select("regular", "irregular").mapInArrow(run, "code bigint, n bigint")
    return found.groupBy("code").agg(F.sum("n").alias("n"))


def _highest(pairs: DataFrame, size_b: int) -> np.ndarray:
    """The highest count of each B id; at most its vocabulary reaches the driver."""
    best = np.zeros(size_b, dtype=np.int64)
    for r in pairs.groupBy((F.col("code") % size_b).alias("b")).agg(F.max("n").alias("n")).collect():
        best[r["b"]] = r["n"]
    return best


def _regular_counts(pairs: DataFrame, same: np.ndarray, size_b: int) -> np.ndarray:
    """All links of A id and precomputed partner, by A id; at most A's vocabulary reaches the driver."""
    spark = pairs.sparkSession
    known = np.flatnonzero(same >= 0)
    wanted = spark.createDataFrame([(int(i), int(i * size_b + same[i])) for i in known], "a bigint, code bigint")
    counts = np.zeros(len(same), dtype=np.int64)
    for r in pairs.join(F.broadcast(wanted), "code").select("a", "n").collect():
        counts[r["a"]] = r["n"]
    return counts


_SCORES = "rid bigint, id {id}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _scored(rows: DataFrame, kind: str, same: np.ndarray, best: np.ndarray, regular: np.ndarray, codes, counts) -> DataFrame:
    """Rows of documents with n_best and count_sum over their regular links and those irregular ones whose counts are given."""
    spark = rows.sparkSession
    context = spark.sparkContext
    is_best = (regular > 0) & (regular == best[same])
    size_b = len(best)
    shared = context.broadcast((regular, is_best, best, codes, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regular, is_best, best, codes, counts = shared.value
        for batch in batches:
            totals, bests = [], []
            for a, links in zip(batch["regular"], batch["irregular"]):
                ids = np.frombuffer(a.as_py(), dtype="<u4")
                total, n = int(regular[ids].sum()), int(is_best[ids].sum())
                if codes is not None:
                    pairs = np.frombuffer(links.as_py(), dtype="<i8")
                    found = counts[np.searchsorted(codes, pairs)]
                    total, n = total + int(found.sum()), n + int((found == best[pairs % size_b]).sum())
                totals.append(total)
                bests.append(n)
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in ("rid", "id", "n_a", "n_b", "n_groups", "n_links")], pa.array(bests, pa.int64()),
                 pa.array(totals, pa.int64()), batch["groups_sha256"]],
                ["rid", "id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return rows.mapInArrow(run, _SCORES.format(id=kind))


def _irregular_links(rows: DataFrame) -> DataFrame:
    """(rid, code, k): how often a document has an irregular link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, links in zip(batch["rid"].to_pylist(), batch["irregular"]):
                codes, times = np.unique(np.frombuffer(links.as_py(), dtype="<i8"), return_counts=True)
                if len(codes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(codes), rid)), pa.array(codes), pa.array(times.astype(np.int64))], ["rid", "code", "k"])

    return rows.select("rid", "irregular").mapInArrow(run, "rid bigint, code bigint, k bigint")


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
              broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and those whose bytes a tokenizer does not give back, have zeros and no
    digest, and count nowhere. Repeated rows count each; a null id is an id; an empty table gives
    no rows; other columns are ignored. Texts are tokenised once, into a written table. Up to
    ``broadcast_pairs`` counted irregular pairs go to all tasks as two arrays; with more, the links of the documents
    meet the counts in a shuffle.
    """
    pair = tokenizer_pair(path_a, path_b)
    same, size_b = pair.same, pair.size_b
    rows = written(aligned(docs, path_a, path_b, id_col, text_col), "aligned")
    pairs = written(pair_counts(rows, same, size_b), "pairs")
    best, regular = _highest(pairs, size_b), _regular_counts(pairs, same, size_b)
    kind = rows.schema["id"].dataType.simpleString()
    if pairs.count() <= broadcast_pairs:
        table = pairs.toArrow()
        order = np.argsort(table["code"].to_numpy())
        scored = _scored(rows, kind, same, best, regular, table["code"].to_numpy()[order], table["n"].to_numpy()[order])
    else:
        fewer = _scored(rows, kind, same, best, regular, None, None)
        highest = rows.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(best) if n], "b bigint, best bigint")
        known = pairs.join(F.broadcast(highest), F.col("code") % size_b == F.col("b")).select("code", "n", (F.col("n") == F.col("best")).alias("top"))
        more = _irregular_links(rows).join(known, "code").groupBy("rid").agg(
            F.sum(F.col("k") * F.col("n")).alias("more"), F.sum(F.when(F.col("top"), F.col("k")).otherwise(0)).alias("tops"))
        scored = fewer.join(more, "rid", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("tops", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0))})
    return scored.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

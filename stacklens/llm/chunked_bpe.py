"""BPE encoding that meets repeated text once: content-defined chunks, repaired where they join.

A rolling hash cuts the texts into chunks, so a passage that several documents share gives the
same chunks in all of them. A Python worker encodes a chunk once and remembers its tokens. A cut may fall
into a word; therefore the words around each join are encoded again as one window, and the
result must agree with the tokens of the chunks on both sides. No text and no id is shuffled.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import whole

#: Bytes that the rolling hash sees; a power of two.
WINDOW = 32
#: One of 2 ** CUT_BITS places is a cut.
CUT_BITS = 9
#: Bytes of a chunk, at least and at most; the last of a text may be shorter.
SHORTEST, LONGEST = 64, 4096
#: Bytes hashed at once, which bounds the memory of a very long text.
SLICE = 1 << 20
#: Bytes of ids and context of the chunks that a Python worker remembers, twice at most: those met lately and those before.
CHUNK_BYTES = 48 << 20
#: Words that it remembers likewise, and characters of those too long for it.
WORDS, LONG_WORD = 150_000, 64
#: Bytes of texts that are encoded at a time.
TEXT_AT_ONCE = 1 << 20

# Fixed values of the rolling hash: one number per byte value, by a rule, and an odd factor.
_BYTE = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], dtype=np.uint32)
_FACTOR = 0x9E3779B1


# --- chunks ------------------------------------------------------------------------------

def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each place: sum of byte numbers times powers, modulo 2 ** 32.

    Hashes of 1, 2, 4, … bytes are put together from two of half the length.
    """
    hashes, width, power = _BYTE[data], 1, _FACTOR
    while width < WINDOW:
        doubled = hashes.copy()
        doubled[width:] += hashes[:-width] * np.uint32(power)
        hashes, width, power = doubled, 2 * width, power * power & 0xFFFFFFFF
    return hashes


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of ``text`` end; the places depend on the bytes just before them only.

    Cuts stand before the first byte of a code point. An empty text is one empty chunk.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    ends: list[int] = []
    at = 0

    def close(end: int) -> int:
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        ends.append(end)
        return end

    for start in range(0, len(data), SLICE):
        before = min(start, WINDOW - 1)
        hashes = rolling(data[start - before:start + SLICE])[before:]
        for end in (np.flatnonzero(hashes >> np.uint32(32 - CUT_BITS) == 0) + start + 1).tolist():
            while end - at > LONGEST:
                at = close(at + LONGEST)
            if end - at >= SHORTEST and end < len(data):
                at = close(end)
    while len(data) - at > LONGEST:
        at = close(at + LONGEST)
    if at < len(data) or not ends:
        ends.append(len(data))
    return ends


# --- encoding ----------------------------------------------------------------------------

# Fixed value: Unicode white space, at which words are told apart.
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

_CONTROLS = re.compile("[\x1c-\x1f]")


class Encoder:
    """A tokenizer file of the tokenizers library, without truncation, padding and added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.words: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}
        self.chunks: dict[bytes, tuple] = {}
        self.chunks_before: dict[bytes, tuple] = {}
        self.chunk_bytes = 0
        self.joined = None
        if self.tokenizer.decoder is None:
            size = 1 + max(self.tokenizer.get_vocab().values())
            self.joined = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]

    def library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in found]

    def _learn(self, words: list[str]) -> None:
        """Encodes many words as one text and cuts its ids by the places of their tokens."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        starts = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
        cuts = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in words])).tolist()
        raw, width, at = np.array(found.ids, dtype=self.kind).tobytes(), np.dtype(self.kind).itemsize, 0
        for word, cut in zip(words, cuts):
            self.words[word] = raw[at:width * cut]
            at = width * cut

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, word by word; only for a tokenizer that keeps words apart."""
        if len(self.words) > WORDS:
            self.words, self.words_before = {}, self.words
        cut = [_words(t) for t in texts]
        unseen = set(itertools.chain.from_iterable(cut)).difference(self.words)
        known = [w for w in unseen if w in self.words_before]
        self.words.update((w, self.words_before[w]) for w in known)
        new = list(unseen.difference(known))
        if new:
            self._learn(new)
        made = [np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype=self.kind) for words in cut]
        for w in unseen:
            if len(w) > LONG_WORD:
                del self.words[w]
        return made

    def keeps_words_apart(self) -> bool:
        """Whether white space ends every token, so that words encode alike alone and side by side."""
        one, two = "ab", "cd'ef"
        alone = self.library([one, two, f"{one} {two}", f"{one}\n\t {two}", f" {one}\n"])
        both = np.concatenate(alone[:2])
        return all(np.array_equal(x, y) for x, y in ((both, alone[2]), (both, alone[3]), (alone[0], alone[4])))

    def decode(self, ids: np.ndarray) -> bytes:
        """What the library's decode gives with special tokens kept; without a decoder in the file it joins tokens by spaces."""
        if self.joined is None:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()
        return b" ".join(map(self.joined.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _words(text: str) -> list[str]:
    """``text`` cut at white space. Python's own split takes four control characters for white space too."""
    return [w for w in _SPACES.split(text) if w] if _CONTROLS.search(text) else text.split()


def _contexts(text: str, words: int) -> tuple[str, str] | None:
    """First and last part of ``text``: what may belong to a word cut in two, and ``words`` whole words. None: too short."""
    first = list(itertools.islice(_SPACES.finditer(text), words + 1))
    if len(first) <= words:
        return None
    back = 32 * (words + 1)
    while True:
        start = max(0, len(text) - back)
        # White space at the very start of a later part may begin before it.
        last = [m for m in _SPACES.finditer(text, start) if m.start() > start or not start]
        if len(last) > words:
            break
        if not start:
            return None
        back *= 4
    if last[-words - 1].start() < first[words].start():
        return None
    return text[:first[words].start()], text[last[-words - 1].end():]


def encode_chunks(coder: Encoder, texts: list[str]) -> list[tuple[str, np.ndarray | None, str, int, int]]:
    """(head, ids, tail, id before, id after) of each chunk.

    ``ids`` are the chunk's tokens between head and tail, whose own encodings begin and end the chunk's;
    ``id before`` is the head's last and ``id after`` the tail's first. Head and tail grow by words until they
    agree; a chunk too short for that is all head, and its ids are None.
    """
    made: list = [None] * len(texts)
    open_ = list(range(len(texts)))
    full = coder.encode(texts)
    words = 1
    while open_:
        parts = [_contexts(texts[i], words) for i in open_]
        found = iter(coder.encode([x for p in parts if p for x in p]))
        left = []
        for i, part in zip(open_, parts):
            if part is None:
                made[i] = (texts[i], None, "", -1, -1)
                continue
            head, tail, ids = next(found), next(found), full[i]
            inner = len(ids) - len(tail)
            if len(head) and len(tail) and len(head) <= inner and np.array_equal(ids[:len(head)], head) and np.array_equal(ids[inner:], tail):
                # A copy, so that what is remembered does not hold the whole.
                made[i] = (part[0], ids[len(head):inner].copy(), part[1], int(head[-1]), int(tail[0]))
            else:
                left.append(i)
        open_, words = left, 2 * words
    return made


def remembered_chunks(coder: Encoder, texts: list[list[str]]) -> list[list[tuple]]:
    """The encodings of the chunks of each text; a chunk is encoded when it is met for the first time."""
    if coder.chunk_bytes > CHUNK_BYTES:
        coder.chunks, coder.chunks_before, coder.chunk_bytes = {}, coder.chunks, 0
    known, before = coder.chunks, coder.chunks_before
    keys = [[xxhash.xxh3_128_digest(c) for c in chunks] for chunks in texts]
    new: dict[bytes, str] = {}
    for key, chunk in zip(itertools.chain.from_iterable(keys), itertools.chain.from_iterable(texts)):
        if key not in known and key not in new:
            if key in before:
                known[key] = before[key]
            else:
                new[key] = chunk
    for key, made in zip(new, encode_chunks(coder, list(new.values()))):
        known[key] = made
        coder.chunk_bytes += 400 + len(made[0]) + len(made[2]) + (0 if made[1] is None else made[1].nbytes)
    return [[known[key] for key in row] for row in keys]


def join_chunks(coder: Encoder, texts: list[list[tuple]]) -> list[np.ndarray]:
    """Ids of texts from the encodings of their chunks: windows over the joins, and what lies between them."""
    windows: list[str] = []
    plan: list[list] = []  # per text: numbers of windows and ids of chunks in turn
    sides: list[tuple[int, int]] = []  # ids that a window has to begin and end with, -1: any
    for chunks in texts:
        parts, text, begin = [], "", -1
        for head, ids, tail, before, after in chunks:
            text += head
            if ids is not None:
                parts += [len(windows), ids]
                windows.append(text)
                sides.append((begin, before))
                text, begin = tail, after
        parts.append(len(windows))
        windows.append(text)
        sides.append((begin, -1))
        plan.append(parts)
    found = coder.encode(windows)
    for ids, (first, last) in zip(found, sides):
        if (first >= 0 and (not len(ids) or ids[0] != first)) or (last >= 0 and (not len(ids) or ids[-1] != last)):
            raise ValueError("a join of chunks encodes unlike the chunks on its sides")
    return [np.concatenate([found[x] if isinstance(x, int) else x for x in parts]) for parts in plan]


def encode_texts(coder: Encoder, texts: list[bytes]) -> list[np.ndarray]:
    """Ids of texts by their chunks."""
    cut = [[t[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise([0, *chunk_ends(t)])] for t in texts]
    return join_chunks(coder, remembered_chunks(coder, cut))


RESULT = "id {id}, n_tokens bigint, ids binary"


def _result(ids: list[np.ndarray], keys: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [keys, pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
        ["id", "n_tokens", "ids"])


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens and ids as little-endian unsigned 32-bit integers.

    ``tokenizer`` is a file of the tokenizers library; ids are those of its encode without added
    special tokens. Chunks are reused where the tokenizer keeps words apart; other tokenizers
    encode every text as a whole. Null and empty texts have no ids. Repeated rows and null ids give rows of
    their own; an empty table gives none; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        apart = coder.keeps_words_apart()
        for batch in batches:
            texts = [t.as_py() for t in batch["text"]]
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) <= TEXT_AT_ONCE):
                    size += len(texts[stop])
                    stop += 1
                part = texts[at:stop]
                ids = encode_texts(coder, part) if apart else coder.library([t.decode("utf-8", "replace") for t in part])
                yield _result(ids, batch["id"].slice(at, stop - at))
                at = stop

    df = docs.select(F.col(id_col).alias("id"), whole(text_col).cast("binary").alias("text"))
    found = df.mapInArrow(run, RESULT.format(id=df.schema["id"].dataType.simpleString()))
    return found.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` with the column ``decoded``, bytes of UTF-8: what the library's decode gives with special tokens kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            texts = [coder.decode(np.frombuffer(x.as_py(), dtype="<u4")) for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, decoded binary")


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and the digests of ids and decoded text."""
    return decoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

"""Token ids in a compact binary form: frequency-ranked, byte-aligned, with control bytes apart."""

from __future__ import annotations

import itertools
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklens.llm.common import whole, written

#: Ids of one block; a block ends with the document that reaches it.
BLOCK_IDS = 1 << 16
#: Rows of one output file, on average.
SHARD_ROWS = 50_000
#: Word pieces remembered by a Python worker, twice at most: those seen lately and those before.
CACHE_PIECES = 150_000
#: Texts whose normal form stays below this code point are split here, others by the library.
LATIN_END = 0x250

# --- encoding of numbers -----------------------------------------------------------------

#: Lengths of the four values that a control byte describes, and their sum.
LENGTHS = (np.arange(256, dtype=np.uint8)[:, None] >> np.array([0, 2, 4, 6], dtype=np.uint8) & 3) + 1


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values.

    Two bits of a control byte tell the length, 1 to 4 bytes, of each of four values; the data
    has their low bytes, least first. A last, partial byte counts absent values as length 1.
    """
    values = np.ascontiguousarray(values, dtype="<u4")
    size = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[:len(values)] = size
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1).astype(np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= size[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, sizes: np.ndarray) -> np.ndarray:
    """The values again, of runs of ``sizes`` values that were encoded one by one and joined.

    Lengths come from a table of the 256 control bytes; the slots that fill up the last control
    byte of a run are left out.
    """
    table = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)
    slots = -(-sizes // 4) * 4
    ends = np.cumsum(slots)
    if len(table) != (ends[-1] if len(ends) else 0):
        raise ValueError(f"{len(control)} control bytes for {int(sizes.sum())} values")
    real = np.ones(len(table), dtype=bool)
    for k in (1, 2, 3):
        real[ends[slots - sizes >= k] - k] = False
    lengths = table[real].astype(np.int64)
    if int(lengths.sum()) != len(data):
        raise ValueError(f"{len(data)} data bytes where the control bytes tell {int(lengths.sum())}")
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data, dtype=np.uint8)
    values = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        values[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


# --- tokens ------------------------------------------------------------------------------

def _class(kind: str) -> str:
    chars = (chr(c) for c in range(LATIN_END))
    keep = (lambda c: c.isspace() and c not in "\x1c\x1d\x1e\x1f") if kind == "Z" else (lambda c: unicodedata.category(c)[0] == kind)
    return "".join(re.escape(c) for c in chars if keep(c))


def _byte_symbols() -> dict[int, str]:
    """What byte-level vocabularies write for a byte that is no visible Latin-1 character: the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in visible)}


class WordPieces(dict):
    """Ids, as little-endian bytes, of the pieces between which a tokenizer never merges."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.symbols = _byte_symbols()
        self.before: dict[str, bytes] = {}
        self.beyond = re.compile(f"[^\x00-{chr(LATIN_END - 1)}]")
        letter, number, space = (_class(k) for k in "LNZ")
        # Fixed value: the word pattern of the tokenizer file, for these code points.
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(piece)
        if ids is None:
            symbols = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.symbols)
            ids = b"".join([t.id.to_bytes(self.width, "little") for t in self.tokenize(symbols)])
        self[piece] = ids
        return ids

    def _is_plain(self, text: str) -> bool:
        """Latin text that normalising leaves as it is."""
        return not self.beyond.search(text) and unicodedata.is_normalized("NFC", text)

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` without special tokens added, exactly as the library gives them."""
        normal = text.lower() if "<|" not in text and (text.isascii() or self._is_plain(text)) else None
        if normal is not None and (normal.isascii() or not self.beyond.search(normal)):
            return b"".join([self[piece] for piece in self.pieces.findall(normal)])
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=f"<u{self.width}").tobytes()


@lru_cache(maxsize=2)
def word_pieces(path: str) -> WordPieces:
    return WordPieces(path)


def tokenized(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, ids): ids as little-endian bytes of the tokenizer's width, the end id last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = word_pieces(path)
        end = end_id.to_bytes(pieces.width, "little")
        for batch in batches:
            ids = pa.array([pieces.encode(x.as_py()) + end for x in batch["text"]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])
        pa.default_memory_pool().release_unused()

    df = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    return df.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, ids binary")


def by_frequency(tokens: DataFrame, kind: str) -> np.ndarray:
    """The ids that occur, most frequent first (ties: smaller id): the id of each rank.

    Counted per task and summed; only one row per id of the vocabulary reaches the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(x.as_py() for x in batch["ids"]), dtype=kind), minlength=len(counts))
            found[:len(counts)] += counts
            counts = found
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], dtype="<u4")


BLOCKS = "block bigint, first bigint, doc_ids array<bigint>, sizes array<bigint>, control binary, data binary"


def write_files(tokens: DataFrame, path: str, shards: int, kind: str) -> None:
    """Writes the ids in ascending order of doc_id.

    Format: ``ids`` has the id of each rank. ``blocks`` has one folder per shard, in order of the
    ids; each row of its file is a block of whole documents: their ids, their token counts, and
    the ranks of their tokens as control and data bytes, document after document. ``first``
    counts the tokens before the block in its shard. The file's frame is Parquet without
    compression, so that Spark commits it whole and reads it from any store.
    """
    spark = tokens.sparkSession
    ids = by_frequency(tokens, kind)
    ranks = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.uint32)
    ranks[ids] = np.arange(len(ids), dtype=np.uint32)
    spark.createDataFrame(list(enumerate(ids.tolist())), "rank bigint, id bigint").coalesce(1).write.parquet(f"{path}/ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = first = n = 0
        rows: list[tuple] = []

        def out():
            docs, sizes, pairs = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([first]), pa.array([docs], longs), pa.array([sizes], longs),
                 *[pa.array([b"".join(p[k] for p in pairs)], pa.binary()) for k in (0, 1)]],
                ["block", "first", "doc_ids", "sizes", "control", "data"])

        for batch in batches:
            for doc, found in zip(batch["doc_id"], batch["ids"]):
                values = ranks[np.frombuffer(found.as_py(), dtype=kind)]
                rows.append((doc.as_py(), len(values), encode(values)))
                n += len(values)
                if n >= BLOCK_IDS:
                    yield out()
                    block, first, n, rows = block + 1, first + n, 0, []
        if rows:
            yield out()

    longs = pa.list_(pa.int64())
    # Ranges are sampled from the written ids, so nothing in Python runs twice.
    ordered = tokens.repartitionByRange(shards, F.col("doc_id")).sortWithinPartitions("doc_id", F.octet_length("ids"), "ids")
    blocks = ordered.mapInArrow(run, BLOCKS).withColumn("shard", F.spark_partition_id())
    blocks.write.option("compression", "none").partitionBy("shard").parquet(f"{path}/blocks")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ids as unsigned 32-bit little-endian bytes.

    The starts of the shards are summed on the driver from one number per shard.
    """
    by_rank = np.array([r["id"] for r in spark.read.parquet(f"{path}/ids").orderBy("rank").collect()], dtype="<u4")
    blocks = spark.read.schema(f"{BLOCKS}, shard int").parquet(f"{path}/blocks")
    n = F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)
    sums = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.sum(n).alias("n")).collect()}
    before = dict(zip(sorted(sums), itertools.accumulate([0, *[sums[k] for k in sorted(sums)]])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                b = batch.slice(row, 1).to_pylist()[0]
                sizes = np.array(b["sizes"], dtype=np.int64)
                ids = by_rank[decode(b["control"], b["data"], sizes)].tobytes()
                ends = np.cumsum(sizes)
                starts = ends - sizes
                parts = [ids[4 * a:4 * z] for a, z in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b["doc_ids"], pa.int64()), pa.array(starts + b["first"] + before[b["shard"]]), pa.array(sizes),
                     pa.array(parts, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Tokenises ``docs``, writes the files below ``path`` and returns what they hold, read again.

    ``end_id`` closes each document, so an empty or null text has one id. Ids of documents are
    integers and ascend, null first; of equal ids the shorter row comes first, then by its
    bytes. An empty table gives no rows. ``tokenizer`` is a file of the tokenizers library.
    """
    tokens = written(tokenized(docs, tokenizer, end_id, id_col, text_col), "tokens")
    kind = f"<u{word_pieces(tokenizer).width}"
    write_files(tokens, path, max(1, -(-tokens.count() // shard_rows)), kind)
    return read_files(docs.sparkSession, path)


def digests(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids' bytes."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


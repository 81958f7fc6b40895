"""Best items per query by dot product or cosine, block against block.

Queries are packed into chunks and items into blocks, one row each, by a hash. A chunk meets
all blocks in one Arrow task that keeps the k best items per query as it goes, so neither pairs nor
lists per block are shuffled and what is written grows with the rows, not with chunks times blocks.
Products are screened in single precision against the k-th best score so far, with a margin
for its rounding; whatever passes is scored in double precision. Items to leave out travel with
the chunk of their query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.session import cut_lineage, shuffle_partitions

QUERIES_PER_CHUNK = 8192
ITEMS_PER_BLOCK = 32_768
MIN_QUERIES_PER_CHUNK = 128
GROUPS_PER_TASK = 3
#: Queries and items of a tile, candidates per query from which it is selected in double precision, and items multiplied at once in single
#: precision: their products stay in the cache of a core while they are looked through.
TILE_QUERIES, TILE_ITEMS, CROWDED, STRIP_ITEMS = 512, 4096, 32, 1024

VECTORS = "ids array<string>, lengths binary, positions binary, weights binary"
BANNED = "ban_rows binary, ban_starts binary, ban_items array<string>"
EXTRA = "extra binary"


def _slot(column: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(slots)).cast("int")


def _vector_columns(df: DataFrame) -> list[Column]:
    """(positions, weights) of sparse vectors, or a dense ``vector`` with NULL positions."""
    if "positions" in df.columns:
        return [F.col("positions").cast("array<int>").alias("positions"), F.col("weights").cast("array<double>").alias("weights")]
    return [F.lit(None).cast("array<int>").alias("positions"), F.col("vector").cast("array<double>").alias("weights")]


def _binary(values: np.ndarray, kind: type) -> pa.Array:
    return pa.array([np.ascontiguousarray(values, dtype=kind).tobytes()], pa.binary())


def _strings(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.string()))


def _packed_vectors(rows: pa.Table) -> list[pa.Array]:
    """One row of ``VECTORS`` from rows in order of id: ids, lengths and numbers of their vectors; dense vectors have no positions."""
    ids, positions, weights = (rows[c].combine_chunks() for c in ("id", "positions", "weights"))
    dense = positions.null_count == len(positions)
    lengths = weights.value_lengths().to_numpy(zero_copy_only=False)
    flat = lambda lists: lists.flatten().to_numpy(zero_copy_only=False)
    if weights.null_count or dense and len(np.unique(lengths)) > 1:
        raise ValueError("vectors have to be given and, where dense, of one length")
    return [_strings(ids), _binary(lengths, np.int32), pa.array([None], pa.binary()) if dense else _binary(flat(positions), np.int32),
            _binary(flat(weights), np.float64)]


def _matches(wanted: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``wanted``, place in ``ids``) of all equal pairs."""
    names = ids.dictionary_encode(null_encoding="encode")
    at = pc.index_in(wanted, value_set=names.dictionary).fill_null(-1).to_numpy(zero_copy_only=False)
    codes = names.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    first = np.searchsorted(codes[order], at, "left")
    count = np.where(at >= 0, np.searchsorted(codes[order], at, "right") - first, 0)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(np.arange(len(at)), count), order[np.repeat(first, count) + inside]


def _pack_chunk(blocks: int):
    """A chunk as one row: its queries, the items left out (query's place, item) block by block, and how many more each query wants."""

    def pack(queries: pa.Table, banned: pa.Table) -> pa.Table:
        schema = ["chunk", "ids", "lengths", "positions", "weights", "ban_rows", "ban_starts", "ban_items", "extra"]
        if not queries.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int32()), pa.array([], pa.list_(pa.string())), *[pa.array([], pa.binary())] * 5,
                                         pa.array([], pa.list_(pa.string())), pa.array([], pa.binary())], schema)
        queries = queries.sort_by("id").combine_chunks()
        vectors = _packed_vectors(queries)
        place, row = _matches(banned["id"].combine_chunks(), vectors[0].flatten())
        slots = banned["block"].to_numpy()[place]
        order = np.lexsort((row, slots))
        starts = np.searchsorted(slots[order], np.arange(blocks + 1))
        return pa.Table.from_arrays([
            queries["chunk"].combine_chunks().slice(0, 1), *vectors, _binary(row[order], np.int32), _binary(starts, np.int64),
            _strings(banned["item"].combine_chunks().take(pa.array(place[order]))), _binary(queries["extra"].to_numpy(), np.int32)], schema)

    return pack


def _pack_block(items: pa.Table) -> pa.Table:
    items = items.sort_by("id").combine_chunks()
    return pa.Table.from_arrays([items["block"].combine_chunks().slice(0, 1), *_packed_vectors(items)], ["block", "ids", "lengths", "positions", "weights"])


class _Vectors:
    """Vectors of a chunk or block: ids and the numbers as given, dense rows made on request."""

    def __init__(self, row: dict, cosine: bool) -> None:
        self.ids = row["ids"]
        self.lengths = np.frombuffer(row["lengths"], np.int32)
        self.positions = None if row["positions"] is None else np.frombuffer(row["positions"], np.int32)
        weights = np.frombuffer(row["weights"])
        self.starts = np.concatenate(([0], np.cumsum(self.lengths, dtype=np.int64)))
        self.size = len(self.ids)
        if self.positions is None:
            self.width, self.weights = (int(self.lengths[0]) if self.size else 0), weights.reshape(self.size, -1)
            self.norms = np.linalg.norm(self.weights, axis=1)
        else:
            self.width, self.weights = int(self.positions.max(initial=-1)) + 1, weights
            owner = np.repeat(np.arange(self.size), self.lengths)
            self.norms = np.sqrt(np.bincount(owner, weights * weights, self.size))
        if cosine:
            scale = np.divide(1.0, self.norms, out=np.zeros(self.size), where=self.norms > 0)
            self.weights = self.weights * (scale[:, None] if self.positions is None else np.repeat(scale, self.lengths))
            self.norms = (self.norms > 0).astype(np.float64)

    def dense(self, start: int, stop: int, width: int, kind: type) -> np.ndarray:
        stop = min(stop, self.size)
        if self.positions is None:
            return self.weights[start:stop].astype(kind)
        rows = np.zeros((stop - start, width), dtype=kind)
        lo, hi = self.starts[start], self.starts[stop]
        rows[np.repeat(np.arange(stop - start), self.lengths[start:stop]), self.positions[lo:hi]] = self.weights[lo:hi]
        return rows


    def picked(self, places: np.ndarray, width: int) -> np.ndarray:
        """Dense rows of some of the vectors."""
        if self.positions is None:
            return self.weights[places]
        rows, lengths = np.zeros((len(places), width)), self.lengths[places]
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.repeat(self.starts[places], lengths) + inside
        rows[np.repeat(np.arange(len(places)), lengths), self.positions[at]] = self.weights[at]
        return rows


class _Best:
    """The best items so far of every query of a chunk, and what is to be merged into them.

    A query keeps ``wanted`` of them; ``k`` is the largest of these numbers.
    """

    def __init__(self, row: dict, k: int, cosine: bool) -> None:
        self.wanted = k + np.frombuffer(row["extra"], np.int32).astype(np.int64)
        self.k, self.cosine = int(self.wanted.max(initial=k)), cosine
        self.queries = _Vectors(row, cosine)
        self.ban_rows, self.ban_items = np.frombuffer(row["ban_rows"], np.int32), row["ban_items"]
        self.ban_starts = np.frombuffer(row["ban_starts"], np.int64)
        self.rows, self.scores, self.items = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, object)
        self.limits = np.full(self.queries.size, -np.inf)
        self.products = np.empty((TILE_QUERIES, STRIP_ITEMS), np.float32)
        self.pending, self.n_pending = [], 0

    def meet(self, row: dict) -> None:
        """Look at the items of one block."""
        items, queries = _Vectors(row, self.cosine), self.queries
        if not items.size:
            return
        lo, hi = self.ban_starts[row["block"]:row["block"] + 2]
        place, ban_cols = _matches(self.ban_items.slice(lo, hi - lo), items.ids)
        ban_rows = self.ban_rows[lo:hi][place]
        width = max(items.width, queries.width, 1)
        margins = 2.4e-7 * (width + 8) * queries.norms * items.norms.max() + 2e-9
        ratio = lambda limits, who: np.divide(limits - margins[who], queries.norms[who], out=np.full(len(who), -np.inf), where=queries.norms[who] > 0)
        names, singles = None, items.dense(0, items.size, width, np.float32)
        falling, turn = np.arange(items.size), np.arange(queries.size)
        if queries.positions is None and items.positions is None and items.norms.min() < items.norms.max():
            # No product is larger than that of the lengths: long items come first, and queries that ask for equally long ones stand together.
            falling = np.argsort(-items.norms, kind="stable")
            singles, turn = singles[falling], np.argsort(ratio(self.limits, turn), kind="stable")
        lengths, column, at_turn = -items.norms[falling], np.argsort(falling), np.argsort(turn)
        order = np.lexsort((column[ban_cols], at_turn[ban_rows]))
        ban_at, ban_cols = at_turn[ban_rows][order], ban_cols[order]
        for start in range(0, queries.size, TILE_QUERIES):
            who = turn[start:start + TILE_QUERIES]
            exact = queries.dense(start, start + TILE_QUERIES, width, np.float64) if queries.positions is not None else queries.weights[who]
            single, limits = exact.astype(np.float32), self.limits[who]
            first, last = np.searchsorted(ban_at, (start, start + len(exact)))
            out_rows, out_cols = ban_at[first:last] - start, ban_cols[first:last]
            by_column = np.argsort(column[out_cols], kind="stable")
            banned = out_rows[by_column], column[out_cols][by_column]
            if not np.isfinite(limits).all():
                np.maximum(limits, self._floor(single, singles.T, margins[who], *banned), out=limits)
            reach = np.searchsorted(lengths, -ratio(limits, who).min(), "right")
            for found in self._found(exact, single, singles[:reach].T, falling, items, width, limits, margins[who], banned, out_rows, out_cols):
                if len(found[0]):
                    names = items.ids.to_numpy(zero_copy_only=False) if names is None else names
                    self.pending.append((who[found[0]], found[2], names[found[1]]))
                    self.n_pending += len(found[0])
        if 2 * self.n_pending > len(self.rows):
            self._merge()

    def _floor(self, single, columns, margins, out_rows, out_cols) -> np.ndarray:
        """What the k best items of the block reach at least: the k-th best of the largest products of small groups of items, each of which is an item's."""
        group, tops = max(1, min(64, columns.shape[1] // (8 * self.k))), []
        for at in range(0, columns.shape[1], STRIP_ITEMS):
            strip = columns[:, at:at + STRIP_ITEMS]
            size = strip.shape[1]
            scores = np.matmul(single, strip, out=self.products[:len(single), :size])
            lo, hi = np.searchsorted(out_cols, (at, at + size))
            scores[out_rows[lo:hi], out_cols[lo:hi] - at] = -np.inf
            even = size - size % group
            tops.append(scores[:, :even].reshape(len(single), -1, group).max(axis=2, initial=-np.inf))
            if even < size:
                tops.append(scores[:, even:].max(axis=1, keepdims=True))
        tops = np.concatenate(tops, axis=1)
        if tops.shape[1] < self.k:
            return np.full(len(single), -np.inf)
        return np.partition(tops, tops.shape[1] - self.k, axis=1)[:, tops.shape[1] - self.k] - margins

    def _found(self, exact, single, columns, falling, items, width, limits, margins, banned, out_rows, out_cols):
        """(rows, items, scores) that may be among the k best; ``columns`` are the items that can be, in the order ``falling``."""
        tiles = range(0, items.size, TILE_ITEMS)
        if np.isfinite(limits).all():
            rows, cols = self._screened(single, columns, (limits - margins).astype(np.float32), *banned)
            if len(rows) <= CROWDED * len(exact) * len(tiles):
                if not len(rows):
                    return
                used, place = np.unique(falling[cols], return_inverse=True)
                values = np.round(np.einsum("ij,ij->i", exact[rows], items.picked(used, width)[place]), 9)
                good = values >= limits[rows]
                yield rows[good], used[place[good]], values[good]
                return
        for at in tiles:
            here = (out_cols >= at) & (out_cols < at + TILE_ITEMS)
            rows, cols, values = self._tile(exact, items, at, width, limits, out_rows[here], out_cols[here] - at)
            yield rows, cols + at, values

    def _tile(self, exact, items, at, width, limits, out_rows, out_cols):
        """The same of a tile, all of it in double precision; raises ``limits`` where the tile alone has k better ones."""
        scores = np.round(exact @ items.dense(at, at + TILE_ITEMS, width, np.float64).T, 9)
        scores[out_rows, out_cols] = -np.inf
        if self.k <= scores.shape[1]:
            np.maximum(limits, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k], out=limits)
        above, equal = scores > limits[:, None], (scores == limits[:, None]) & (scores > -np.inf)
        # Items stand in order of their ids, so the first of those that tie come first.
        rows, cols = np.nonzero(above | equal & (equal.cumsum(axis=1) <= self.k - above.sum(axis=1)[:, None]))
        return rows, cols, scores[rows, cols]

    def _screened(self, single, columns, limits, out_rows, out_cols) -> tuple[np.ndarray, np.ndarray]:
        """(rows, columns) of the products in single precision that reach ``limits``; strip by strip, and only rows whose largest does are gone through."""
        strips = range(0, columns.shape[1], STRIP_ITEMS)
        cuts = np.searchsorted(out_cols, [*strips, columns.shape[1]])
        rows, cols = [], []
        for at, lo, hi in zip(strips, cuts, cuts[1:]):
            strip = columns[:, at:at + STRIP_ITEMS]
            scores = np.matmul(single, strip, out=self.products[:len(single), :strip.shape[1]])
            if lo < hi:
                scores[out_rows[lo:hi], out_cols[lo:hi] - at] = -np.inf
            high = np.flatnonzero(scores.max(axis=1) >= limits)
            if len(high):
                place, found = np.divmod(np.flatnonzero(scores[high] >= limits[high, None]), strip.shape[1])
                rows.append(high[place])
                cols.append(found + at)
        return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _merge(self) -> None:
        parts = [(self.rows, self.scores, self.items), *self.pending]
        self.pending, self.n_pending = [], 0
        rows, scores, items = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((-scores, rows))
        rows, scores, items = rows[order], scores[order], items[order]
        first = np.searchsorted(rows, np.arange(self.queries.size + 1))
        cut = first[:-1] + self.wanted
        over = np.flatnonzero(cut < first[1:])
        for r in over[scores[cut[over] - 1] == scores[cut[over]]]:
            # Equal scores on both sides of the cut: the smaller ids stay.
            falling = -scores[first[r]:first[r + 1]]
            lo, hi = (first[r] + np.searchsorted(falling, -scores[cut[r]], side) for side in ("left", "right"))
            items[lo:hi] = sorted(items[lo:hi], key=lambda x: (x is not None, x))
        kept = np.arange(len(rows)) - first[rows] < self.wanted[rows]
        full = first[1:] - first[:-1] >= self.wanted
        self.limits[full] = scores[cut[full] - 1]
        self.rows, self.scores, self.items = rows[kept], scores[kept], items[kept]

    def result(self, names: list[str]) -> pa.RecordBatch:
        self._merge()
        place, _ = pd.factorize(pd.Series(self.items, dtype=object), sort=True)
        order = np.lexsort((place, -self.scores, self.rows))
        rows = self.rows[order]
        ranks = np.arange(len(rows)) - np.searchsorted(rows, np.arange(self.queries.size))[rows] + 1 if len(rows) else rows
        return pa.RecordBatch.from_arrays([
            self.queries.ids.take(pa.array(rows)), pa.array(self.items[order], pa.string()), pa.array(self.scores[order] + 0.0),
            pa.array(ranks, pa.int32())], [*names, "score", "rank"])


def _columns_of(batch: pa.RecordBatch, i: int, names: dict[str, str]) -> dict:
    """Row ``i``: lists as Arrow arrays, the rest as Python values."""
    return {to: batch[c][i].values if pa.types.is_list(batch[c].type) else batch[c][i].as_py() for c, to in names.items()}


OF_CHUNK = {c: c for c in ("chunk", "ids", "lengths", "positions", "weights", "ban_rows", "ban_starts", "ban_items", "extra")}
OF_BLOCK = {"block": "block", **{f"item_{c}": c for c in ("ids", "lengths", "positions", "weights")}}


def _scored(k: int, cosine: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {}
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = batch["chunk"][i].as_py()
                if chunk not in best:
                    best[chunk] = _Best(_columns_of(batch, i, OF_CHUNK), k, cosine)
                best[chunk].meet(_columns_of(batch, i, OF_BLOCK))
        for found in best.values():
            yield found.result(names)

    return run


def _paired(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = {}
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch["chunk"][i].as_py()
                if number not in chunks:
                    row = _columns_of(batch, i, OF_CHUNK)
                    chunks[number] = (_Vectors(row, False), np.frombuffer(row["ban_rows"], np.int32), np.frombuffer(row["ban_starts"], np.int64),
                                      row["ban_items"])
                queries, rows, starts, asked = chunks[number]
                row = _columns_of(batch, i, OF_BLOCK)
                items, (lo, hi) = _Vectors(row, False), starts[row["block"]:row["block"] + 2]
                place, cols = _matches(asked.slice(lo, hi - lo), items.ids)
                of = rows[lo:hi][place]
                yield pa.RecordBatch.from_arrays([
                    queries.ids.take(pa.array(of)), items.ids.take(pa.array(cols)),
                    pa.array(np.einsum("ij,ij->i", queries.weights[of], items.weights[cols]))], [*names, "score"])

    return run


def _met(queries: DataFrame, items: DataFrame, query_key: str, item_key: str, named: DataFrame | None, n_queries: int, n_items: int,
         extra: str | None = None) -> DataFrame:
    """Every chunk of queries, with the items ``named`` for them, beside every block of items."""
    spark = queries.sparkSession
    blocks = max(1, math.ceil(n_items / ITEMS_PER_BLOCK))
    spread = min(GROUPS_PER_TASK * shuffle_partitions(spark), math.ceil(n_queries / MIN_QUERIES_PER_CHUNK))
    chunks = max(1, math.ceil(n_queries / QUERIES_PER_CHUNK), spread)

    asked = queries.select(_slot(query_key, chunks).alias("chunk"), F.col(query_key).cast("string").alias("id"), *_vector_columns(queries),
                           (F.lit(0) if extra is None else F.col(extra)).cast("int").alias("extra"))
    if named is None:
        banned = spark.createDataFrame([], "chunk int, block int, id string, item string")
    else:
        banned = named.where(F.col(item_key).isNotNull()).select(
            _slot(query_key, chunks).alias("chunk"), _slot(item_key, blocks).alias("block"),
            F.col(query_key).cast("string").alias("id"), F.col(item_key).cast("string").alias("item"))
    # The work per byte is high, so partition numbers are fixed and not left to size-based coalescing.
    packed = asked.groupBy("chunk").cogroup(banned.groupBy("chunk")).applyInArrow(_pack_chunk(blocks), f"chunk int, {VECTORS}, {BANNED}, {EXTRA}")
    packed = packed.repartitionById(chunks, F.col("chunk"))
    dealt = cut_lineage(
        items.select(_slot(item_key, blocks).alias("block"), F.col(item_key).cast("string").alias("id"), *_vector_columns(items))
        .groupBy("block").applyInArrow(_pack_block, f"block int, {VECTORS}").repartitionById(blocks, F.col("block")))
    # One partition of blocks: a task holds its chunk and reads the blocks one after the other.
    streamed = dealt.select("block", *[F.col(c).alias(f"item_{c}") for c in ("ids", "lengths", "positions", "weights")]).coalesce(1)
    return streamed.hint("shuffle_replicate_nl").crossJoin(packed)


def pair_scores(queries: DataFrame, items: DataFrame, pairs: DataFrame, query_key: str, item_key: str) -> DataFrame:
    """(query_key, item_key, score): dot products of the given ``pairs``; dense vectors.

    No vector is shuffled for a pair: pairs travel with the chunk of their query, and the chunk meets all blocks.
    """
    met = _met(queries, items, query_key, item_key, pairs.where(F.col(query_key).isNotNull()), queries.count(), items.count())
    return met.mapInArrow(_paired([query_key, item_key]), f"{query_key} string, {item_key} string, score double")


def top_scores(
    queries: DataFrame,
    items: DataFrame,
    query_key: str,
    item_key: str,
    k: int,
    exclude: DataFrame | None = None,
    cosine: bool = False,
    n_queries: int | None = None,
    n_items: int | None = None,
    digits: int = 4,
    extra: str | None = None,
) -> DataFrame:
    """(query_key, item_key, score, rank): the exact k best items of every query, and as many more as its column ``extra`` says.

    ``queries`` / ``items`` carry a dense ``vector`` or sparse ``positions`` and
    ``weights``. Order: score (9 digits) descending, then item key. ``exclude`` holds
    (query_key, item_key) rows to leave out. Chunk and block numbers follow from the
    row counts, which keeps every chunk and block at a bounded size.
    """
    n_queries = queries.select(query_key).count() if n_queries is None else n_queries
    n_items = items.select(item_key).count() if n_items is None else n_items
    best = _met(queries, items, query_key, item_key, exclude, n_queries, n_items, extra).mapInArrow(
        _scored(k, cosine, [query_key, item_key]), f"{query_key} string, {item_key} string, score double, rank int")
    return best.withColumn("score", F.round("score", digits))

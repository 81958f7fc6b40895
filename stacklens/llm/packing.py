"""Best-fit packing of documents into sequences, with conflicts by source and duplicate cluster."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import n_words, per_task, told_apart, whole, words

#: Documents packed by one task.
GROUP = 8_192


class Bins:
    """Bins of one group, ordered by the room left.

    A bin carries bitmaps of its sources and of its clusters. ``rooms`` has a bit for each
    room that occurs. Below a room, bins are kept by source bitmap. ``full`` has, for a
    source or cluster, the rooms at which every bin holds it: the successor search steps over
    those at once. A room that is missing there only costs a look at its bins.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.room: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.held: list[list[tuple[str, int]]] = []
        self.rooms = 0
        self.at: defaultdict[int, dict[int, dict[int, None]]] = defaultdict(dict)
        self.count: defaultdict[int, int] = defaultdict(int)
        self.holding: defaultdict[tuple, int] = defaultdict(int)
        self.full: defaultdict[tuple[str, int], int] = defaultdict(int)
        self.full_at: defaultdict[int, set] = defaultdict(set)

    def _update(self, k: int, step: int) -> None:
        """Puts bin ``k`` at its room (1) or takes it away (-1)."""
        room, mask = self.room[k], self.sources[k]
        bit = 1 << room
        if step > 0:
            self.at[room].setdefault(mask, {})[k] = None
        else:
            del self.at[room][mask][k]
            if not self.at[room][mask]:
                del self.at[room][mask]
        self.count[room] += step
        self.rooms = self.rooms | bit if self.count[room] else self.rooms & ~bit
        for key in self.held[k]:
            self.holding[key, room] += step
        for key in {*self.held[k], *self.full_at[room]}:
            if self.count[room] and self.holding[key, room] == self.count[room]:
                self.full[key] |= bit
                self.full_at[room].add(key)
            else:
                self.full[key] &= ~bit
                self.full_at[room].discard(key)

    def _find(self, length: int, source: int, cluster: int) -> int | None:
        rooms = (self.rooms & ~self.full["s", source] & ~self.full["c", cluster]) >> length << length
        while rooms:
            room = (rooms & -rooms).bit_length() - 1
            for mask, bins in self.at[room].items():
                if not mask >> source & 1:
                    for k in bins:
                        if not self.clusters[k] >> cluster & 1:
                            return k
            rooms &= rooms - 1
        return None

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset): the bin with the least room that fits and has no conflict, else a new one."""
        k = self._find(length, source, cluster)
        if k is None:
            k = len(self.room)
            self.room.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
            self.held.append([])
        else:
            self._update(k, -1)
        offset = self.capacity - self.room[k]
        self.room[k] -= length
        self.sources[k] |= 1 << source
        self.clusters[k] |= 1 << cluster
        self.held[k] += [("s", source), ("c", cluster)]
        self._update(k, 1)
        return k, offset


def pack_group(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, longest first; ties in the order given."""
    bins = Bins(capacity)
    where, offsets = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        where[i], offsets[i] = bins.place(lengths[i], sources[i], clusters[i])
    return where, offsets


def content_cluster(text: Column) -> Column:
    """Cluster of texts that are equal but for case and white space."""
    return F.xxhash64(F.lower(F.array_join(words(text), " ")))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster: Column | None = None, capacity: int = 2048, group: int = GROUP) -> DataFrame:
    """One row per piece: id, piece, start_word, n_words, bin_id, bin_offset.

    A document over ``capacity`` words is cut into pieces; full pieces fill bins of their own, the
    last one is packed. No bin holds two pieces of one source or of one duplicate cluster
    (``cluster``; default: equal texts). Documents are dealt by hash into groups of about
    ``group`` documents, each packed by one task, so every source and cluster is spread over all groups.
    Groups and order follow from what the rows hold, so bins do not depend on partitions.

    A document without words (null text too) has one row with a null bin. A null source is a
    source of its own; repeated rows conflict as copies. An empty table gives no rows; other
    columns are ignored.
    """
    text = whole(text_col)
    units = told_apart(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        (content_cluster(text) if cluster is None else cluster).alias("cluster"), n_words(text).alias("n")), "units")
    groups = per_task(docs.sparkSession, units.count(), group)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["order", "n", "repeat"], kind="stable")
        g, n = int(frame["g"].iloc[0]), frame["n"].to_numpy()
        rest = np.flatnonzero(n % capacity)
        sources, clusters = (pd.factorize(frame[c].iloc[rest], use_na_sentinel=False)[0].tolist() for c in ("source", "cluster"))
        where, offsets = pack_group((n[rest] % capacity).tolist(), sources, clusters, capacity)
        full = n // capacity
        at = np.repeat(np.arange(len(n)), full)
        piece = np.arange(len(at)) - np.repeat(np.cumsum(full) - full, full)
        none = np.flatnonzero(n == 0)
        first = max(where, default=-1) + 1
        bins = np.concatenate([np.array(where, dtype=np.int64), first + np.arange(len(at))]) + (g << 40)
        rows = np.concatenate([rest, at, none])
        pieces = np.concatenate([full[rest], piece, np.zeros(len(none), dtype=np.int64)])
        blank = [pd.NA] * len(none)
        return pd.DataFrame({
            "id": frame["id"].iloc[rows].array, "piece": pieces, "start_word": pieces * capacity,
            "n_words": np.concatenate([n[rest] % capacity, np.full(len(at), capacity), n[none]]),
            "bin_id": pd.array([*bins.tolist(), *blank], dtype="Int64"),
            "bin_offset": pd.array([*offsets, *[0] * len(at), *blank], dtype="Int64")})

    kind = units.schema["id"].dataType.simpleString()
    unit = ("id", "source", "cluster", "n", "repeat")
    dealt = units.withColumns({"order": F.xxhash64(*unit, F.lit(1)), "g": F.pmod(F.xxhash64(*unit), F.lit(groups))})
    packed = dealt.groupBy("g").applyInPandas(
        run, f"id {kind}, piece bigint, start_word bigint, n_words bigint, bin_id bigint, bin_offset bigint")
    return packed.withColumnRenamed("id", id_col)

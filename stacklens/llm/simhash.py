"""SimHash near-duplicates, linked by a self-join of a binary trie over the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import numbered, unpacked, whole, written
from stacklens.llm.components import components

BITS = 64
SEED = 42
#: Shingles hashed at once, which bounds the memory of a very long text.
BLOCK = 50_000
#: Fingerprints below a pair of trie nodes that one task joins; larger pairs are split.
NODE_ROWS = 20_000
#: Leaf pairs of up to so many comparisons are compared directly.
LEAF = 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Fingerprint as an unsigned 64-bit number; 0 for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + BLOCK], ends[at:at + BLOCK])]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: Column, shingle: int, **keep: Column) -> DataFrame:
    """``keep`` and fp (bigint with the bits of the fingerprint)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py(), shingle) for x in batch["t"]], dtype=np.uint64).view(np.int64)
            columns = [batch[name] for name in batch.schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values)], [*batch.schema.names[:-1], "fp"])

    df = docs.select(*[c.alias(n) for n, c in keep.items()], text.cast("binary").alias("t"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema[:-1])
    return df.mapInArrow(run, f"{schema}, fp bigint")


class _Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))
        self.trees = n

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.trees -= 1


def trie_links(a: np.ndarray, b: np.ndarray | None, depth: int, used: int, budget: int) -> np.ndarray:
    """Spanning links, as rows of two values, among values at ``budget`` or fewer differing bits.

    ``a`` and ``b`` are sorted distinct unsigned values below two trie nodes at ``depth`` whose
    prefixes differ in ``used`` bits; without ``b`` the node is paired with itself. Node pairs
    descend together: children that agree keep the error, children that differ add one, and
    a pair over the budget is dropped with all below it. A pair inside one tree of links adds none.
    """
    same = b is None
    values = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    b = a if same else b
    forest = _Forest(len(values))
    stack = [(0, len(a), 0, len(b), depth, used)]
    while stack and forest.trees > 1:
        a0, a1, b0, b1, at, errors = stack.pop()
        if a0 == a1 or b0 == b1 or errors > budget:
            continue
        own = same and a0 == b0 and a1 == b1
        if own and a1 - a0 == 1:
            continue
        if (a1 - a0) * (b1 - b0) <= LEAF or at == BITS:
            near = np.bitwise_count(a[a0:a1, None] ^ b[None, b0:b1]) <= budget
            if own:
                near = np.triu(near, 1)
            for x, y in np.argwhere(near).tolist():
                forest.join(a0 + x, shift + b0 + y)
            continue
        bit = np.uint64(BITS - 1 - at)
        am = a0 + int(np.count_nonzero(((a[a0:a1] >> bit) & np.uint64(1)) == 0))
        bm = am if own else b0 + int(np.count_nonzero(((b[b0:b1] >> bit) & np.uint64(1)) == 0))
        stack.append((a0, am, bm, b1, at + 1, errors + 1))
        if not own:
            stack.append((am, a1, b0, bm, at + 1, errors + 1))
        stack.append((a0, am, b0, bm, at + 1, errors))
        stack.append((am, a1, bm, b1, at + 1, errors))
    pairs = [(i, r) for i in range(len(values)) if (r := forest.root(i)) != i]
    return values[np.array(pairs, dtype=np.int64).reshape(-1, 2)]


PAIR = ("turn", "a", "b", "depth", "used")


def _split(rows: DataFrame, budget: int) -> DataFrame:
    """Rows of node pairs, dealt to the pairs of their children some levels below."""
    step = 7
    masks = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(m.bit_count()).alias("e"))
                      for m in range(1 << step) if m.bit_count() <= budget])
    levels = F.least(F.lit(step), BITS - F.col("depth"))
    child = F.call_function("shiftrightunsigned", F.col("fp"), (BITS - F.col("depth") - levels)).bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), levels) - 1)
    df = rows.select("*", levels.alias("levels"), child.alias("c"), F.explode(masks).alias("x"))
    other = F.col("c").bitwiseXOR(F.col("x.m").cast("long"))
    alone = F.col("side") == 0
    low = F.when(alone, F.col("c") <= other).otherwise(F.col("side") == 1)
    below = lambda prefix, c: F.call_function("shiftleft", F.col(prefix), F.col("levels")).bitwiseOR(c)
    side = F.when(alone & (F.col("x.m") == 0), 0).when(low, 1).otherwise(2)
    return df.where((F.col("used") + F.col("x.e") <= budget) & (F.col("x.m") < F.call_function("shiftleft", F.lit(1), F.col("levels")))).select(
        "turn", F.when(low, below("a", F.col("c"))).otherwise(below("a", other)).alias("a"),
        F.when(low, below("b", other)).otherwise(below("b", F.col("c"))).alias("b"),
        (F.col("depth") + F.col("levels")).alias("depth"), (F.col("used") + F.col("x.e")).alias("used"),
        side.cast("int").alias("side"), "fp")


def _join_nodes(rows: DataFrame, budget: int) -> DataFrame:
    """Spanning links (u, v), as values turned as in ``turn``, of all node pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def links(table: pa.Table):
            keys = [table[c].to_numpy() for c in PAIR]
            values, side = table["fp"].to_numpy().view(np.uint64), table["side"].to_numpy()
            change = np.zeros(len(values), dtype=bool)
            for k in keys:
                change[1:] |= k[1:] != k[:-1]
            bounds = [0, *np.flatnonzero(change).tolist(), len(values)]
            for lo, hi in zip(bounds, bounds[1:]):
                if hi - lo < 2:
                    continue
                depth, used, alone = int(keys[3][lo]), int(keys[4][lo]), side[lo] == 0
                if alone:
                    found = trie_links(np.sort(values[lo:hi]), None, depth, used, budget)
                else:
                    a, b = values[lo:hi][side[lo:hi] == 1], values[lo:hi][side[lo:hi] == 2]
                    found = trie_links(np.sort(a), np.sort(b), depth, used, budget)
                if len(found):
                    # Turned back to the bits of the fingerprint.
                    t = np.uint64(keys[0][lo])
                    found = (found >> t) | (found << np.uint64(BITS - int(t))) if t else found
                    yield np.ascontiguousarray(found).view(np.int64)

        def out(table):
            found = list(links(table))
            if found:
                both = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["u", "v"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, table]) if rest is not None else table
            rest = rest.combine_chunks()
            last = len(rest) - 1
            first = last
            same = np.ones(len(rest), dtype=bool)
            for c in PAIR:
                column = rest[c].to_numpy()
                same &= column == column[last]
            first = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
            yield from out(rest.slice(0, first))
            rest = rest.slice(first)
        if rest is not None:
            yield from out(rest)

    dealt = rows.repartition(*PAIR).sortWithinPartitions(*PAIR)
    return dealt.mapInArrow(run, "u bigint, v bigint")


def near_links(distinct: DataFrame, budget: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (u, v) that connect all fingerprints ``fp`` (distinct) within ``budget`` bits.

    Two fingerprints with so few differing bits agree in one of ``budget`` + 1 blocks of bits.
    With that block turned to the top, their trie nodes coincide there, so only such nodes
    are paired and the whole budget goes to the levels below. Node pairs over ``node_rows`` values
    descend some levels as rows, to pairs of children within the budget; nothing is cut off.
    """
    parts = budget + 1
    cuts = [BITS * i // parts for i in range(parts + 1)]
    turned = []
    for lo, hi in zip(cuts, cuts[1:]):
        fp = F.shiftleft("fp", lo).bitwiseOR(F.shiftrightunsigned("fp", BITS - lo)) if lo else F.col("fp")
        block = F.shiftrightunsigned(fp, BITS - (hi - lo))
        turned.append(distinct.select(F.lit(lo).alias("turn"), block.alias("a"), block.alias("b"), F.lit(hi - lo).alias("depth"),
                                      F.lit(0).alias("used"), F.lit(0).alias("side"), fp.alias("fp")))
    rows = turned[0]
    for more in turned[1:]:
        rows = rows.unionByName(more)
    found = None
    while True:
        large = written(rows.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n")).where(
            (F.col("n") > node_rows) & (F.col("depth") < BITS)), "nodes")
        none = large.isEmpty()
        here = rows if none else rows.join(large, list(PAIR), "left_anti")
        links = _join_nodes(here, budget)
        found = links if found is None else found.unionByName(links)
        if none:
            return found
        rows = written(_split(rows.join(large, list(PAIR), "left_semi"), budget), "nodes")


def _classes(signed: DataFrame, budget: int) -> DataFrame:
    """(fp, root) of the fingerprints that are linked to others."""
    return components(near_links(signed.select("fp").distinct(), budget))


def _with_class(signed: DataFrame, budget: int) -> DataFrame:
    roots = _classes(signed, budget).withColumnRenamed("node", "fp")
    return signed.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       budget: int = 2) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    Documents link when their fingerprints differ in ``budget`` or fewer bits;
    component_id is the smallest id reachable. Null and empty texts have the fingerprint
    zero and link like any other; a component of null ids only has a null component_id.
    Repeated rows give repeated rows; an empty table gives none; other columns are ignored.
    """
    signed = written(fingerprints(docs, F.col(text_col), shingle, id=F.col(id_col)), "simhash")
    rows = _with_class(signed, budget)
    # Written, so that the join below is of two shuffles and a class of many documents can be split.
    smallest = written(rows.groupBy("root").agg(F.min("id").alias("component_id")), "classes")
    return rows.join(smallest, "root").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         budget: int = 2) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id (null ids last)."""
    rows = numbered(docs, "near", id=F.col(id_col), text=F.col(text_col))
    signed = written(fingerprints(rows, F.col("text"), shingle, rid=F.col("rid"), id=F.col("id")), "simhash")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid"))["rid"].alias("rid")
    keep = _with_class(signed, budget).groupBy("root").agg(first).select("rid")
    return unpacked(rows.select("rid", "row").join(keep, "rid", "left_semi"))

"""Mixing sources to target weights by cube-method balanced sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stacklens.llm.common import join_checked, n_words, numbered, told_apart, unpacked, written
from stacklens.operators.interactions import with_global_rank

#: Rows that one task balances at a time.
CHUNK = 5_000
#: Drawn units that the landing may decide anew beside the two left open.
LANDING = 12
#: Share of the words due by which a landing may be off before it changes more drawn units.
NEAR = 0.001
EPS = 1e-9


def source_targets(units: DataFrame, weights: tuple[int, ...] = (3, 1, 2), total: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, rank, source_size, n_docs, target; one row per source.

    Sources in code-point order, null last, take the weights in turn and share ``total`` times
    all sizes. A target stops at ``cap`` times its source's size; the excess goes to the
    others by weight until none is above.
    """
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = with_global_rank(sources, F.col("source").asc_nulls_last(), name="rank")
    turn = F.pmod(F.col("rank") - 1, F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))
    ranked = written(ranked.withColumns({"weight": weight, "most": F.col("source_size") * F.lit(float(cap))}), "sources")
    whole = total * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, n_full = 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(level)
        sums = ranked.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("most"),
                          F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if sums["n"] == n_full or not sums["weight"]:
            break
        n_full, level = sums["n"], max(level, (whole - sums["most"]) / sums["weight"])
    target = F.least("most", F.col("weight") * F.lit(level))
    return ranked.select("source", "rank", "source_size", "n_docs", target.alias("target"))


def flight(p: np.ndarray, size: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight phase: at most two are left between 0 and 1.

    Three open units at a time move along the null space of (1, size), which keeps the expected
    number of units and of words; the direction is drawn so that each probability keeps its
    mean, and the step ends when a unit reaches 0 or 1.
    """
    p = p.copy()
    draws = random.random(len(p) + 1)
    waiting = iter(np.flatnonzero((p > EPS) & (p < 1 - EPS)).tolist())
    open_units: list[int] = []
    for step in range(len(p) + 1):
        while len(open_units) < 3 and (k := next(waiting, None)) is not None:
            open_units.append(k)
        if len(open_units) < 3:
            break
        t = [float(size[k]) for k in open_units]
        u = (t[2] - t[1], t[0] - t[2], t[1] - t[0])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        q = [float(p[k]) for k in open_units]
        up = min((1 - x) / y if y > 0 else -x / y for x, y in zip(q, u) if y)
        down = min(x / y if y > 0 else (x - 1) / y for x, y in zip(q, u) if y)
        move = up if draws[step] * (up + down) < down else -down
        left = []
        for k, x, y in zip(open_units, q, u):
            x += move * y
            p[k] = x = 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
            if EPS < x < 1 - EPS:
                left.append(k)
        open_units = left
    return p


def landing(start: np.ndarray, p: np.ndarray, size: np.ndarray, more: int = LANDING) -> np.ndarray:
    """Decides the at most two units left so that the words come nearest to what was due at the ``start``.

    Up to ``more`` drawn units, spread evenly over the sizes, may be decided anew with them. Of all
    choices whose number of units is less than one off what is due, or as near as any, those
    with words within ``NEAR`` of what is due, or as near as any, are left; the fewest changes decide.
    """
    p = p.copy()
    open_before = (start > EPS) & (start < 1 - EPS)
    open_now = (p > EPS) & (p < 1 - EPS)
    if not open_now.any():
        return p
    drawn = np.flatnonzero(open_before & ~open_now & (size > 0))
    loose = np.concatenate([np.flatnonzero(open_now), drawn[np.unique(np.linspace(0, len(drawn) - 1, min(more, len(drawn))).astype(int))]])
    due = float(((start - p) * size).sum() + (p[loose] * size[loose]).sum()), float((start - p).sum() + p[loose].sum())
    x = (np.arange(1 << len(loose))[:, None] >> np.arange(len(loose)) & 1).astype(float)
    units = np.abs(x.sum(axis=1) - due[1])
    x = x[units <= max(1 - EPS, units.min() + EPS)]
    changes = np.abs(x - p[loose]).sum(axis=1).round(6)
    words = np.abs(x @ size[loose] - due[0]).round(6)
    near = words <= max(words.min(), NEAR * float(start @ size))
    p[loose] = x[near][np.lexsort((words[near], changes[near]))[0]]
    return p


def cube_sample(units: DataFrame, seed: int = 7, chunk: int = CHUNK) -> DataFrame:
    """``rid`` of the drawn units; ``units`` has rid, key, rank (stratum), size and p.

    A stratum is dealt by hash into chunks; each goes through the flight phase in one task,
    large units first, and gives up to two open units. These meet in the next round's
    chunks, until a stratum has one chunk, where the landing decides the last two.
    Draws depend only on seed, stratum, chunk and key order, so reruns agree.
    """
    drawn = None
    level = 0
    left = units.where((F.col("p") > EPS) & (F.col("p") < 1 - EPS))
    while True:
        per = left.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
        n_chunks = F.ceil(F.col("n") / chunk).cast("long")
        strata = written(per.select(F.col("rank").alias("sr"), n_chunks.alias("chunks")), "strata")
        most = strata.agg(F.max("chunks")).first()[0]
        if most is None:
            break
        part = F.pmod(F.xxhash64("key", F.lit(seed + level)), F.col("chunks"))
        dealt = join_checked(left, strata, F.col("rank") == F.col("sr")).withColumn("part", part).drop("sr")
        done = written(_flights(dealt, seed, level), "flight")
        take = done.where(F.col("p") >= 1 - EPS).select("rid")
        drawn = take if drawn is None else drawn.unionByName(take)
        left = done.where((F.col("p") > EPS) & (F.col("p") < 1 - EPS))
        level += 1
        if most <= 1:
            break
    whole = units.where(F.col("p") >= 1 - EPS).select("rid")
    return whole if drawn is None else whole.unionByName(drawn)


def _flights(dealt: DataFrame, seed: int, level: int) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rank, part, chunks = (int(frame[c].iloc[0]) for c in ("rank", "part", "chunks"))
        frame = frame.sort_values(["size", "order", "rid"], ascending=[False, True, True], kind="stable")
        size, start = frame["size"].to_numpy(dtype=np.float64), frame["p"].to_numpy()
        p = flight(start, size, np.random.Generator(np.random.PCG64([seed, level, rank, part])))
        if chunks == 1:
            p = landing(start, p, size)
        return frame[["rid", "key", "rank", "size"]].assign(p=p)

    df = dealt.withColumn("order", F.xxhash64("key", F.lit(seed + 1000)))
    kind = dealt.schema["key"].dataType.simpleString()
    return df.groupBy("rank", "part").applyInPandas(run, f"rid bigint, key {kind}, rank bigint, size bigint, p double")


def _copies(units: DataFrame, weights: tuple[int, ...], seed: int) -> DataFrame:
    """rid, copies, source_size, target of every unit (rid, key, source, size, repeat).

    Units are dealt by key, size and repeat, so units with one key are spread as well.
    """
    targets = source_targets(units, weights)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = join_checked(units, targets.withColumn("rate", rate).withColumnRenamed("source", "ts"),
                           F.col("source").eqNullSafe(F.col("ts"))).drop("ts")
    whole = F.floor(F.col("rate") + EPS)
    planned = written(planned.withColumns({"whole": whole.cast("long"), "p": F.greatest(F.col("rate") - whole, F.lit(0.0))}), "plan")
    deal = F.xxhash64("key", "size", "repeat").alias("key")
    extra = cube_sample(planned.select("rid", deal, "rank", "size", "p"), seed).withColumn("extra", F.lit(1).cast("long"))
    return planned.join(extra, "rid", "left").withColumn("copies", F.col("whole") + F.coalesce("extra", F.lit(0)))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (3, 1, 2), seed: int = 7) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, taken.

    A source's rate is its target over its size. Each document is taken floor(rate) times and
    once more with the rest as its probability; the cube method draws these so that the
    words and documents of a source come to what is due, but for the last two units, which
    are set together with up to twelve drawn ones.
    Null text has size 0; null is a source of its own, last in order; a source without
    words takes none. Repeated rows are documents of their own. An empty table gives no rows.
    """
    units = told_apart(docs.select(F.col(id_col).alias("key"), F.col(source_col).alias("source"),
                                   n_words(F.coalesce(F.col(text_col), F.lit(""))).alias("size")), "units")
    units = written(units.select(F.monotonically_increasing_id().alias("rid"), "*"), "numbered-units")
    return _copies(units, weights, seed).select(
        F.col("key").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = (3, 1, 2), seed: int = 7) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with all their columns.

    Null text has size 0 and null is a source, as in ``mix_sources``; clashing names of extra
    columns stay apart. Rows that share id and size are told apart by their row number, so
    which of them is taken may depend on the files. An empty table gives no rows.
    """
    rows = numbered(docs, "mix", key=F.col(id_col), source=F.col(source_col), size=n_words(F.coalesce(F.col(text_col), F.lit(""))))
    units = rows.select("rid", "key", "source", "size")
    shared = units.groupBy(F.col("key").alias("k"), F.col("size").alias("s")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(shared, "shared-ids")
    on = F.col("key").eqNullSafe(F.col("k")) & (F.col("size") == F.col("s"))
    repeat = F.when(F.col("n").isNull(), 0).otherwise(F.col("rid"))
    units = join_checked(units, shared, on, "left").select("rid", "key", "source", "size", repeat.alias("repeat"))
    taken = _copies(units, weights, seed).where("copies > 0").select("rid", "copies")
    out = rows.select("rid", "row").join(taken, "rid")
    return unpacked(out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))))

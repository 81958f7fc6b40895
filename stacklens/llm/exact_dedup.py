"""Exact duplicates: 128-bit hash, bytes compared inside its groups, smallest id stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import SPACE, whole


def normalised(text: Column) -> Column:
    """Every run of white space becomes one space; single spaces need no work."""
    return F.regexp_replace(text, rf"{SPACE}{{2,}}|[\x09-\x0D]", " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = normalised(whole(text_col))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("h"))


def _groups(keyed: DataFrame) -> DataFrame:
    """One row per distinct text.

    The aggregate looks up the 128-bit hash first and then compares the bytes, so a
    collision makes two groups. Copies meet in the map-side half: a text that a third
    of all rows share leaves each task as one row.
    """
    return (
        keyed.groupBy("h", "text").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are; null counts as empty. The smallest
    id of a group stays; an id that is null stays only if all ids of the group are. Of rows
    with the same id and text exactly one is kept. An empty table gives no rows; other
    columns are ignored.
    """
    keyed = _keyed(docs, id_col, text_col)
    members = keyed.select("id", "h", F.sha2("text", 256).alias("sha")).groupBy("id", "h", "sha").agg(F.count(F.lit(1)).alias("n"))
    return (
        members.join(_groups(keyed), ["h", "sha"])
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i"))
        .select(F.col("id").alias(id_col), "keep_id", "group_size",
                (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"),
                F.col("sha").alias("text_sha256"))
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` with all their columns.

    Of rows with the same id and text one stays (any, where other columns differ). Whole texts
    are shuffled once: the other columns travel with the group, and a row's own text only
    where normalising changed it.
    """
    norm = normalised(whole(text_col))
    own = F.col(f"`{text_col}`")
    same = own.isNotNull() & (own == norm)
    rest = [c for c in docs.columns if c != text_col]
    payload = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], same.alias("same"), F.when(~same | own.isNull(), own).alias("own"))
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"))
    keyed = docs.select(F.unhex(F.md5(norm)).alias("h"), norm.alias("norm"), payload.alias("x"), order.alias("o"))
    kept = keyed.groupBy("h", "norm").agg(F.min_by("x", "o").alias("x"))
    text = F.when(F.col("x.same"), F.col("norm")).otherwise(F.col("x.own"))
    at = {c: F.col(f"x.c{i}") for i, c in enumerate(rest)} | {text_col: text}
    return kept.select(*[at[c].alias(c) for c in docs.columns])

"""Fill-in-middle: texts cut into units, and prefix, middle and suffix put into another order.

The units of a whole batch are one flat array. Each knows its text and its place in it; the pieces
of all texts come from filtering that array by role and joining the lists that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import whole

# The marks of the pieces, and the unit pattern on the bytes of UTF-8.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc0-\xff][\x80-\xbf]*)"
#: A byte that UTF-8 never uses.
END = b"\xff"

BINARY = pa.large_binary()
OUT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"
_OUT = ["n", "form", "prefix_chars", "middle_chars", "output"]


def _bytes(value: str | bytes) -> pa.Scalar:
    return pa.scalar(value.encode() if isinstance(value, str) else value, BINARY)


def split_units(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(units, n): a list of units per text, closed by an empty one, and their number without it."""
    marked = pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\1" + END)
    lists = pc.split_pattern(marked, pattern=END)
    return lists, pc.subtract(pc.cast(pc.list_value_length(lists), pa.int64()), 1)


def _modulo(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _joined(units: pa.Array, keep: pa.Array, lengths: pa.Array) -> pa.Array:
    """The kept units of each text as one string; ``lengths`` counts them per text."""
    kept = units.filter(keep)
    offsets = np.concatenate(([0], np.cumsum(lengths.to_numpy(zero_copy_only=False)))).astype(np.int64)
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), kept), _bytes(b""))


def pieces(texts: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """(n, prefix, middle, suffix) of texts cut after ``first`` and ``second`` modulo n + 1 units."""
    lists, n = split_units(texts)
    choices = pc.add(n, 1)
    cuts = [_modulo(h, choices) for h in (first, second)]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    starts = pa.array(np.concatenate(([0], np.cumsum(choices.to_numpy())[:-1])).astype(np.int64))
    ordinal = pc.subtract(pa.array(np.arange(len(units), dtype=np.int64)), starts.take(parent))
    in_prefix, in_suffix = pc.less(ordinal, low.take(parent)), pc.greater_equal(ordinal, high.take(parent))
    in_middle = pc.invert(pc.or_(in_prefix, in_suffix))
    return (n, _joined(units, in_prefix, low), _joined(units, in_middle, pc.subtract(high, low)),
            _joined(units, in_suffix, pc.subtract(choices, high)))


def _characters(texts: pa.Array) -> pa.Array:
    """Code points: bytes that do not continue one."""
    return pc.cast(pc.count_substring_regex(texts, pattern=rb"[\x00-\x7f\xc0-\xff]"), pa.int64())


def transformed(texts: pa.Array, seeds: list[pa.Array], rate: int, spm: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of each text, by its four seeds."""
    n, prefix, middle, suffix = pieces(texts, seeds[0], seeds[1])
    hundred = pa.array(np.full(len(texts), 100, dtype=np.int64))
    marked = pc.or_(pc.or_(*[pc.match_substring(texts, pattern=m.encode()) for m in (PREFIX, SUFFIX)]),
                    pc.match_substring(texts, pattern=MIDDLE.encode()))
    plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pc.greater_equal(_modulo(seeds[2], hundred), rate))
    is_spm = pc.less(_modulo(seeds[3], hundred), spm)
    p, s, m, nothing = (_bytes(x) for x in (PREFIX, SUFFIX, MIDDLE, b""))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing)
    swapped = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing)
    none = pa.scalar(None, pa.int64())
    return [n, pc.if_else(plain, "plain", pc.if_else(is_spm, "spm", "psm")),
            *[pc.if_else(plain, none, _characters(x)) for x in (prefix, middle)],
            pc.if_else(plain, texts, pc.if_else(is_spm, swapped, psm))]


def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts again, from outputs and forms alone.

    A mark begins with the only ``<`` that it has, so no mark can arise where a piece meets one.
    """
    plain = pc.equal(forms, "plain")
    parts = pc.split_pattern_regex(pc.if_else(plain, _bytes(PREFIX + SUFFIX + MIDDLE), outputs), pattern=b"<[PSM]>")
    one, two, middle = (pc.list_element(parts, i) for i in (1, 2, 3))
    spm = pc.equal(forms, "spm")
    prefix, suffix = pc.if_else(spm, two, one), pc.if_else(spm, one, two)
    return pc.if_else(plain, outputs, pc.binary_join_element_wise(prefix, middle, suffix, _bytes(b"")))


def _seeds(seed: int, key: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of each key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: id, n, form, prefix_chars, middle_chars, output (bytes of UTF-8).

    Units are words of A-Z in either case and single other characters. The id decides both
    cuts, whether the text is changed (``rate`` of 100) and whether its suffix comes first (``spm``
    of 100), so equal ids cut alike and reruns agree. Null and empty texts, and those that hold one of the
    marks, stay plain, without piece lengths. A null id is hashed as empty. Repeated rows give
    repeated rows; an empty table gives none; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                seeds = [batch[f"s{i}"] for i in range(4)]
                columns = transformed(batch["text"].cast(BINARY), seeds, rate, spm)
                columns[-1] = columns[-1].cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch["id"], *columns], ["id", *_OUT])

    df = docs.select(F.col(id_col).alias("id"), *[s.alias(f"s{i}") for i, s in enumerate(_seeds(seed, F.col(id_col)))],
                     whole(text_col).cast("binary").alias("text"))
    made = df.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, {OUT}")
    return made.withColumnRenamed("id", id_col)


def restore(made: DataFrame) -> DataFrame:
    """``made`` with the column ``restored``: the text rebuilt from output and form."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                back = restored(batch["output"].cast(BINARY), batch["form"]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, back], [*batch.schema.names, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema)
    return made.mapInArrow(run, f"{schema}, restored binary")


def digests(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and form, and the digests of output and restored text."""
    return restore(made).select(id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                                F.sha2("restored", 256).alias("restored_sha256"))

"""Secrets in texts: fixed patterns, and runs of high entropy that no allow-list explains."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import whole

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")
MIN_ASSIGN = 6

#: Strings looked at for entropy.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Character classes: runs within a candidate, and the bits a window must reach.
CLASSES = ((re.compile(r"[0-9a-fA-F]{20,}"), 3.0), (re.compile(r"[A-Za-z0-9]{20,}"), 3.8), (re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.9))
WINDOW = 20
#: What explains a candidate by what stands right before it: digests named as such, embedded data.
NAMED = re.compile(r"\b(?:(?:sha-?(?:1|224|256|384|512)|md5|crc32|integrity|checksum|digest|commit|etag)\W{0,3}|data:[\w/+.-]{0,64};base64,)\Z",
                   re.IGNORECASE | re.ASCII)
#: What explains it by where it begins: inside an address.
ADDRESS = re.compile(r"\b(?:https?|ftp|file):/*+[^\s\"'<>]*+\Z", re.IGNORECASE | re.ASCII)
#: Characters looked at before a candidate.
BEFORE = 512
#: What explains a stretch of high entropy: being part of a UUID, or what it holds.
UUID = re.compile(r"\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b", re.IGNORECASE | re.ASCII)
SAMPLE = re.compile(r"example|sample|dummy|placeholder|x{6,}|0123456789|abcdefghij", re.IGNORECASE | re.ASCII)
STROKES = re.compile(r"[/_+=-]+")
#: Letters for each capital that words written together have, at least.
LETTERS_A_WORD = 3


def is_wordlike(stretch: str) -> bool:
    """Numbers, or words, joined by strokes; capitals inside a word begin another one."""
    parts = [p for p in STROKES.split(stretch) if p]
    if all(p.isdigit() for p in parts):
        return True
    mixed = "".join(p for p in parts if not p.isupper())
    return all(p.isalpha() for p in parts) and len(mixed) >= LETTERS_A_WORD * sum(c.isupper() for c in mixed)


# One more than a window holds: the new character enters before the old one leaves.
_PLOG = [0.0, *[c * math.log2(c) for c in range(1, WINDOW + 2)]]


def hot_runs(run: str, bits: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal parts of ``run`` covered by windows of at least ``bits`` of Shannon entropy.

    The counts of the window's characters, and the sum of c log c, change by the
    character that enters and the one that leaves; one pass over the run.
    """
    counts: dict[str, int] = {}
    total, found = 0.0, []
    limit = window * (math.log2(window) - bits) + 1e-9
    for i, char in enumerate(run):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += _PLOG[c + 1] - _PLOG[c]
        if i >= window:
            gone = run[i - window]
            c = counts[gone]
            counts[gone] = c - 1
            total += _PLOG[c - 1] - _PLOG[c]
        if i >= window - 1 and total <= limit:
            start = i - window + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; kind by its place in ``KINDS``."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of high entropy that are neither allowed nor inside a base span.

    Digests named as such, embedded data and addresses are told by what stands before, within
    ``BEFORE`` characters; all else by the stretch itself.
    """
    spans = []
    for m in CANDIDATE.finditer(text):
        candidate, at = m[0], m.start()
        if candidate.isalpha() and (candidate.islower() or candidate[1:].islower()):
            continue
        before = text[max(0, at - BEFORE):at]
        merged: list[tuple[int, int]] = []
        for kind, bits in CLASSES:
            merged += [(r.start() + a, r.start() + b) for r in kind.finditer(candidate) for a, b in hot_runs(r[0], bits)]
        if not merged or NAMED.search(before) or ADDRESS.search(before):
            continue
        joined: list[list[int]] = []
        for a, b in sorted(merged):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        spans += [(at + a, 3, at + b) for a, b in joined if not SAMPLE.search(candidate, a, b) and not is_wordlike(candidate[a:b])
                  and not any(u.start() <= a and b <= u.end() for u in UUID.finditer(candidate))
                  and not any(s <= at + a and at + b <= e for s, _, e in base)]
    return spans


def spans(text: str) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    return sorted(base + entropy_spans(text, base))


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and the array ``spans`` of (kind, start, end) in code points, end exclusive.

    Ordered by start, then kind. Null and empty texts have none. Repeated rows give repeated
    rows; an empty table gives none; other columns are ignored.
    """
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(x.as_py())] for x in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found, struct)], ["id", "spans"])

    df = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return df.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, spans {SPANS}").withColumnRenamed("id", id_col)


def joined(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text."""
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "entropy")
    return found.select(id_col, count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))

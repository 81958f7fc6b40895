"""Toxicity of documents: a learned lexicon, found with typing errors, weighed by context."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import whole, written

#: Labelled rows at most from which lexicon and weights are learned.
TRAIN_ROWS = 12_000
#: Words on either side that make the context of a hit.
CONTEXT = 8
#: States and words remembered by a Python worker; beyond it the memory starts anew.
CACHE = 200_000

EXACT, FUZZY, STEM = 1, 2, 3
FEATURES = 7
#: A word with a typing error counts so much of the word it is taken for.
FUZZY_SHARE = 0.8

# Quotation marks, words of report, words of address, digits for letters.
OPENING, CLOSING = "\"“«„‘'‹`", "\"”»“’'›`"
REPORT = frozenset(
    "said says say called calls calling quoted quote quotes wrote writes word words term terms reported "
    "sagte sagt nannte nennt wort zitat schrieb dit disait appelé mot citation écrit dijo llamó palabra cita escribió".split())
ADDRESS = frozenset("you your you're u ur du dich dir ihr euch tu te toi vous tú ti usted ustedes vosotros".split())
LEET = str.maketrans("013457@$!", "oieastasi")


def bare(token: str) -> str:
    """Lower case, without what is no letter at either end."""
    token = token.lower()
    a, z = 0, len(token)
    while a < z and not token[a].isalpha():
        a += 1
    while z > a and not token[z - 1].isalpha():
        z -= 1
    return token[a:z]


def errors_allowed(term: str) -> int:
    """Typing errors with which a term is still found."""
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class FuzzyTrie:
    """Product of a lexicon trie and Levenshtein automata, made deterministic as words are read.

    A state is the set of (trie node, errors) that a read prefix can be in; reading a
    character matches or replaces an edge, or skips the character; closing a state skips
    edges. With ``swaps`` two neighbours that changed places are one error: half of a swap is a
    (node, character still to come). Most words reach the empty state after a few characters.
    """

    def __init__(self, terms: dict[str, float], swaps: bool = False):
        self.swaps = swaps
        self.children: list[dict[str, int]] = [{}]
        self.weight: list[float] = [0.0]
        self.limit: list[int] = [-1]
        #: The highest limit of the terms at or below a node.
        self.reach: list[int] = [0]
        for term, weight in sorted(terms.items()):
            node, limit = 0, errors_allowed(term)
            self.reach[0] = max(self.reach[0], limit)
            for char in term:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.weight.append(0.0)
                    self.limit.append(-1)
                    self.reach.append(0)
                node = self.children[node][char]
                self.reach[node] = max(self.reach[node], limit)
            self.weight[node], self.limit[node] = weight, limit
        self._reset()

    def _reset(self) -> None:
        self.start = self._closed({0: 0})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}

    def _closed(self, state: dict) -> frozenset:
        todo = [x for x in state.items() if isinstance(x[0], int)]
        while todo:
            node, errors = todo.pop()
            for child in self.children[node].values():
                if errors < self.reach[child] and state.get(child, errors + 2) > errors + 1:
                    state[child] = errors + 1
                    todo.append((child, errors + 1))
        return frozenset(state.items())

    def _step(self, state: frozenset, char: str) -> frozenset:
        after: dict = {}

        def put(key, node: int, errors: int) -> None:
            if errors <= self.reach[node] and errors < after.get(key, errors + 1):
                after[key] = errors

        for key, errors in state:
            if not isinstance(key, int):
                if key[1] == char:
                    put(key[0], key[0], errors)
                continue
            for edge, child in self.children[key].items():
                put(child, child, errors + (edge != char))
                if self.swaps and edge != char and char in self.children[child]:
                    below = self.children[child][char]
                    put((below, edge), below, errors + 1)
            put(key, key, errors + 1)
        return self._closed(after)

    def match(self, word: str) -> tuple[int, float] | None:
        """(errors, weight) of the nearest term, the heaviest of those; None beyond a term's limit."""
        state, steps = self.start, self.steps
        for char in word:
            after = steps.get((state, char))
            if after is None:
                if len(steps) >= CACHE:
                    self._reset()
                    steps = self.steps
                after = steps[state, char] = self._step(state, char)
            state = after
            if not state:
                return None
        found = [(errors, -self.weight[node]) for node, errors in state if isinstance(node, int) and errors <= self.limit[node]]
        return (min(found)[0], -min(found)[1]) if found else None


@dataclass
class Lexicon:
    """Words and stems (beginnings of words) with their log odds.

    All words are looked for with typing errors. ``clean`` has words that look like them but occur
    in clean documents.
    """

    words: dict[str, float]
    stems: dict[str, float]
    clean: frozenset[str] = frozenset()
    seen: dict[str, tuple[int, float]] = field(default_factory=dict, repr=False)
    trie: FuzzyTrie | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "seen": {}, "trie": None}

    def look_up(self, token: str) -> tuple[int, float]:
        """(kind, weight) of a raw token; kind 0 if it is no hit."""
        found = self.seen.get(token)
        if found is None:
            if len(self.seen) >= CACHE:
                self.seen.clear()
            found = self.seen[token] = self._look_up(bare(token))
        return found

    def _look_up(self, word: str) -> tuple[int, float]:
        if not word:
            return 0, 0.0
        if word in self.words:
            return EXACT, self.words[word]
        for n in range(4, min(len(word), 8)):
            if word[:n] in self.stems:
                return STEM, self.stems[word[:n]]
        weight = 0.0 if word in self.clean else self.fuzzy(word)
        return (FUZZY, FUZZY_SHARE * weight) if weight else (0, 0.0)

    def fuzzy(self, word: str) -> float:
        """Weight of the word that ``word`` is a misspelling of, or 0."""
        if self.trie is None:
            self.trie = FuzzyTrie(self.words, swaps=True)
        hit = self.trie.match(word)
        if not hit and not word.isalpha() and not word.isdigit():
            hit = self.trie.match(word.translate(LEET))
        return hit[1] if hit else 0.0


def quoted(tokens: list[str], at: int) -> bool:
    """Whether the token stands inside quotation marks that close within the context."""
    own = tokens[at]
    opened = own[0] in OPENING
    for k in range(at - 1, max(-1, at - 2 * CONTEXT - 1), -1):
        if opened or tokens[k].rstrip(".,;:!?")[-1:] in CLOSING and len(tokens[k]) > 1:
            break
        opened = tokens[k][0] in OPENING
    return opened and any(t.rstrip(".,;:!?")[-1:] in CLOSING for t in tokens[at:at + 2 * CONTEXT])


def context_score(tokens: list[str], at: int, hits: set[int]) -> tuple[float, bool]:
    """(weight of the hit by its surroundings, whether it looks quoted).

    Quotation marks and words of report lower it; address and further hits raise it.
    """
    near = range(max(0, at - CONTEXT), min(len(tokens), at + CONTEXT + 1))
    around = [bare(tokens[k]) for k in near if k != at]
    report = any(w in REPORT for w in around[:at - near.start])
    in_quotes = quoted(tokens, at)
    score = (0.3 if in_quotes else 1.0) * (0.6 if report else 1.0)
    score *= 1.2 if any(w in ADDRESS for w in around) else 1.0
    return score * (1.3 if any(k != at and k in hits for k in near) else 1.0), in_quotes or report


def features(lexicon: Lexicon, texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` numbers per text.

    Each distinct token of the batch is looked up once; only hits are visited one by one.
    """
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    found = [lexicon.look_up(x) if x else (0, 0.0) for x in names]
    kinds = np.array([k for k, _ in found], dtype=np.int8)
    codes = coded.indices.to_numpy()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    out = np.zeros((len(texts), FEATURES))
    out[:, 0] = np.log1p(lengths)
    at = np.flatnonzero(kinds[codes]) if len(codes) else np.zeros(0, dtype=np.int64)
    owner = np.searchsorted(ends, at, side="right")
    bounds = np.flatnonzero(np.diff(owner)) + 1
    for hits in np.split(at, bounds) if len(at) else []:
        doc = int(np.searchsorted(ends, hits[0], side="right"))
        first = int(ends[doc] - lengths[doc])
        everywhere = {int(h) for h in hits}
        sums, plain = [0.0] * 4, []
        for h in sorted(everywhere):
            lo, hi = max(first, h - 3 * CONTEXT), min(int(ends[doc]), h + 3 * CONTEXT)
            tokens = [names[c] for c in codes[lo:hi].tolist()]
            score, is_quoted = context_score(tokens, h - lo, {x - lo for x in range(h - CONTEXT, h + CONTEXT + 1) if x in everywhere})
            kind, weight = found[codes[h]]
            sums[(kind == STEM) + 2 * is_quoted] += score * min(weight, 6.0) / 3
            if not is_quoted:
                plain.append(h)
        out[doc, 1:5] = np.log1p(sums)
        if plain:
            out[doc, 5] = math.log1p(1000 * len(plain) / lengths[doc])
            out[doc, 6] = math.log1p(max(int(np.searchsorted(plain, h + 6 * CONTEXT)) - k for k, h in enumerate(plain)))
    return out


def _is_held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(5)) == 0


def train_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, toxic) of at most ``rows`` labelled documents, chosen by a hash of the id."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~_is_held_out(id_col))
    one = known.groupBy(F.col(id_col).alias("label_id")).agg(F.max("toxic").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    # At most ``rows`` rows, so it may be broadcast.
    sample = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("label_id"))
    return written(sample.select(F.col("label_id").alias("id"), whole(text_col).alias("text"), "toxic"), "sample")


def count_terms(sample: DataFrame) -> DataFrame:
    """(term, pos0, neg0, pos1, neg1): toxic and clean documents with the term, by half of the sample.

    Terms are words, and with a star beginnings that two words of a document share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter() for _ in range(4)]
            for text, toxic, half in zip(batch["text"], batch["toxic"], batch["half"]):
                found = {w for w in map(bare, text.as_py().split()) if 2 < len(w) < 40}
                begin = Counter(w[:n] for w in found for n in range(4, min(len(w), 8)))
                counts[2 * half.as_py() + (not toxic.as_py())].update([*found, *(f"{p}*" for p, n in begin.items() if n > 1)])
            for k, counted in enumerate(counts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counted), pa.string()), pa.array([k] * len(counted), pa.int32()),
                     pa.array(list(counted.values()), pa.int64())], ["term", "k", "n"])

    rows = sample.select("text", "toxic", "half").mapInArrow(run, "term string, k int, n bigint")
    sums = [F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(("pos0", "neg0", "pos1", "neg1"))]
    return written(rows.groupBy("term").agg(*sums), "terms")


def learn_lexicon(counts: DataFrame, totals: dict[tuple[int, int], int], halves: tuple[int, ...]) -> Lexicon:
    """All terms that mark the toxic documents of some halves of the sample, whose size bounds them."""
    n_pos, n_neg = (sum(totals.get((h, k), 0) for h in halves) for k in (1, 0))
    pos, neg = (sum((F.col(f"{k}{h}") for h in halves[1:]), F.col(f"{k}{halves[0]}")) for k in ("pos", "neg"))
    odds = F.ln((pos + 0.5) / F.lit(n_pos + 1.0)) - F.ln((neg + 0.5) / F.lit(n_neg + 1.0))
    strong = counts.select("term", pos.alias("pos"), neg.alias("neg"), odds.alias("odds")).where(
        (F.col("pos") >= max(3, 0.004 * n_pos)) & (F.col("odds") >= 2.0))
    rows = strong.collect()
    stems: dict[str, float] = {}
    for r in sorted((r for r in rows if r["term"].endswith("*")), key=lambda r: len(r["term"])):
        stem = r["term"][:-1]
        shorter = [stems[stem[:n]] for n in range(4, len(stem)) if stem[:n] in stems]
        if not shorter or max(shorter) < 0.8 * r["odds"]:
            stems[stem] = round(r["odds"], 4)
    words = {r["term"]: round(r["odds"], 4) for r in rows if not r["term"].endswith("*")}
    lexicon = Lexicon(words, stems)
    # Words a typing error away from a term: few, as the terms are.
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([lexicon.fuzzy(w) > 0 for w in batch["term"].to_pylist()], pa.bool_()))

    alike = counts.where((neg > 0) & ~F.col("term").endswith("*") & (F.length("term") >= 3)).select("term").mapInArrow(near, "term string")
    return Lexicon(words, stems, frozenset(r["term"] for r in alike.collect()) - set(words))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weights, the constant last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([*[ridge] * (x.shape[1] - 1), 1e-6])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        change = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += change
        if np.abs(change).max() < 1e-8:
            break
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _with_features(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray | None) -> DataFrame:
    """(id, toxic, features) or, with weights, (id, score)."""
    keep = docs.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(lexicon, batch["text"])
            if weights is None:
                value = pa.array(x.tolist(), pa.list_(pa.float64()))
            else:
                value = pa.array(np.round(_sigmoid(np.column_stack([x, np.ones(len(x))]) @ weights), 6))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], value], [*keep, "x"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema[:-1])
    return docs.mapInArrow(run, f"{schema}, x {'array<double>' if weights is None else 'double'}")


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per document: id, held_out, score, predicted.

        Empty and null texts are scored like any text without a hit. Repeated rows get equal
        scores; a null id counts as held out; an empty table gives no rows.
        """
        rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
        scored = _with_features(rows, self.lexicon, self.weights)
        return scored.select(F.col("id").alias(id_col), _is_held_out("id").alias("held_out"), F.col("x").alias("score"),
                             (F.col("x") >= 0.5).cast("int").alias("predicted"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learns from labelled rows that are not held out, at most ``rows``.

    Two lexicons, each from one half of them (by hash), give the features of the other half,
    so that words which mark a half by chance get no weight; the lexicon that scores is
    learned from both halves. Without labels of both kinds every document scores as the
    share of toxic ones. Nothing but the text enters a score.
    """
    sample = train_sample(docs, labels, rows, id_col, text_col).withColumn("half", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int"))
    totals = {(r["half"], r["toxic"]): r["n"] for r in sample.groupBy("half", F.col("toxic").cast("int").alias("toxic")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    counts = count_terms(sample)
    frame = []
    for half in (0, 1):
        other = learn_lexicon(counts, totals, (1 - half,))
        frame += _with_features(sample.where(F.col("half") == half).select("toxic", "text"), other, None).collect()
    lexicon = learn_lexicon(counts, totals, (0, 1))
    x = np.array([r["x"] for r in frame]).reshape(-1, FEATURES)
    y = np.array([float(r["toxic"] > 0) for r in frame])
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return ToxicityModel(lexicon, np.array([*[0.0] * FEATURES, math.log(share / (1 - share))]))
    return ToxicityModel(lexicon, fit_logistic(x, y))

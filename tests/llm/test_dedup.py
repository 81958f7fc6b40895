"""Exact and near duplicates and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from stacklens.llm import exact_dedup, simhash, suffix_dedup
from stacklens.llm.components import components
from tests.llm.data import COLUMNS, documents, edge_rows, sentences


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact_expected(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[norm(t)].append(i)
    out, seen = [], set()
    for i, t, _ in rows:
        n = norm(t)
        known = [x for x in groups[n] if x is not None]
        keep = min(known) if known else None
        kept = i == keep and n not in seen
        if kept:
            seen.add(n)
        out.append((i, keep, len(groups[n]), kept, hashlib.sha256(n.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def test_exact_edges(spark):
    rows = edge_rows()
    got = [tuple(r) for r in exact_dedup.exact_duplicates(documents(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(exact_expected(rows), key=key)


def test_exact_drop_keeps_columns(spark):
    rows = edge_rows()
    kept = exact_dedup.drop_exact_duplicates(documents(spark, rows))
    assert kept.columns == COLUMNS
    want = sorted(((i, norm(t)) for (i, t, _), e in zip(rows, exact_expected(rows)) if e[3]), key=key)
    assert sorted(((r.doc_id, norm(r.text)) for r in kept.collect()), key=key) == want


def test_empty_tables(spark):
    none = documents(spark, [])
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(none).count() == 0
    assert simhash.simhash_components(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0
    assert suffix_dedup.passage_digests(none).count() == 0
    assert suffix_dedup.repeated_passages(none).count() == 0


def plain_fingerprint(text, shingle=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, budget=2):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= budget:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def near_rows():
    rows = edge_rows()
    for k in range(6):
        words = sentences(100 + k, 150).split()
        for c in range(5):
            changed = list(words)
            changed[random.Random(k * 10 + c).randrange(150)] = "other"
            rows.append((100 + 10 * k + c, " ".join(changed if c else words), "abc"[c % 3]))
    return rows


def near_expected(rows):
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    roots = classes(prints)
    ids = defaultdict(list)
    for (i, _, _), r in zip(rows, roots):
        if i is not None:
            ids[r].append(i)
    return [(i, f"{p:016x}", min(ids[r], default=None)) for (i, _, _), p, r in zip(rows, prints, roots)]


def test_fingerprint():
    for _, text, _ in edge_rows():
        assert simhash.fingerprint(text.encode() if text is not None else None) == plain_fingerprint(text)


def test_simhash_against_brute_force(spark):
    rows = near_rows()
    got = [tuple(r) for r in simhash.simhash_components(documents(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(near_expected(rows), key=key)


def test_one_document_of_each_class_stays(spark):
    rows = near_rows()
    kept = simhash.drop_near_duplicates(documents(spark, rows))
    assert kept.columns == COLUMNS
    want = Counter(c for _, _, c in {(f, c, c) for _, f, c in near_expected(rows)})
    roots = classes([plain_fingerprint(t) for _, t, _ in rows])
    assert kept.count() == len(set(roots))
    assert {r.doc_id for r in kept.collect()} == set(want)


@pytest.mark.parametrize("node_rows", [20_000, 30, 3])
def test_trie_join_splits_large_nodes(spark, node_rows):
    pick = random.Random(3)
    values = {pick.getrandbits(64) for _ in range(60)}
    for v in list(values)[:30]:
        for _ in range(8):
            values.add(v ^ 1 << pick.randrange(64) ^ 1 << pick.randrange(64))
    values |= {5 | k << 50 for k in range(200)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, node_rows)
    rows = [(r.u, r.v) for r in links.collect()]
    mask = (1 << 64) - 1
    assert all(0 < ((u & mask) ^ (v & mask)).bit_count() for u, v in rows)
    got = {r.node: r.root for r in components(links).collect()}
    want = classes(values)
    assert len(set(got.get(s, s) for s in signed)) == len(set(want))
    by = defaultdict(set)
    for s, w in zip(signed, want):
        by[w].add(got.get(s, s))
    assert all(len(x) == 1 for x in by.values())


def test_trie_links_reach_every_close_pair():
    pick = np.random.default_rng(0)
    base = pick.integers(0, 1 << 63, 20, dtype=np.uint64)
    near = np.unique(np.concatenate([base, *[base ^ np.uint64(1 << int(pick.integers(64))) for _ in range(90)]]))
    found = simhash.trie_links(near, None, 0, 0, 2)
    at = {v: i for i, v in enumerate(near.tolist())}
    parent = list(range(len(near)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in found.tolist():
        parent[root(at[u])] = root(at[v])
    want = classes(near.tolist())
    assert len({(root(i), w) for i, w in enumerate(want)}) == len(set(want)) == len({root(i) for i in range(len(near))})


def test_small_nodes_descend_too():
    """Leaves are a few prints, so that six of them already walk down the trie."""
    values = np.array(sorted({1 << 60, 3 << 60, 7 << 59, 9, 11, 1 << 30}), dtype=np.uint64)
    assert len(values) ** 2 > simhash.LEAF
    assert len(simhash.trie_links(values, None, 0, 0, 2)) == len(values) - len(set(classes(values.tolist())))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- repeated passages -------------------------------------------------------------------


def passages_expected(rows, length=200):
    texts = [(t or "").encode() for _, t, _ in rows]
    count = Counter(b[p:p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (i, _, _), b in zip(rows, texts):
        spans = []
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        kept = suffix_dedup.kept_bytes(b, spans)
        out.append((i, len(b), sum(z - a for a, z in spans), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def passage_rows():
    pick = random.Random(9)
    shared = [sentences(200 + k, 70) for k in range(4)]
    rows = [r for r in edge_rows() if r[0] not in (7, 8)]
    for k in range(40):
        parts = [sentences(300 + k, pick.randrange(5, 60)), pick.choice(shared), sentences(400 + k, 30), pick.choice(shared)[pick.randrange(40):]]
        rows.append((1000 + k, "\n".join(parts), "a"))
    rows += [(2000, "a" * 500, "a"), (2001, "ab" * 150, "a"), (2002, "a" * 199, "a"), (2003, sentences(500, 40)[:200], "a"),
             (2004, "x" + sentences(500, 40)[:200], "a")]
    return rows


@pytest.mark.parametrize("hot", [20_000, 4])
def test_passages_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = passage_rows()
    got = [tuple(r) for r in suffix_dedup.passage_digests(documents(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(passages_expected(rows), key=key)


def test_passages_have_spans_and_text(spark):
    rows = passage_rows()
    got = []
    for r in suffix_dedup.repeated_passages(documents(spark, rows)).collect():
        pairs = [tuple(x) for x in r.spans]
        kept = suffix_dedup.kept_bytes(bytes(r.text), pairs)
        got.append((r.doc_id, len(r.text), sum(b - a for a, b in pairs), len(pairs), hashlib.sha256(kept).hexdigest()))
    assert sorted(got, key=key) == sorted(passages_expected(rows), key=key)


def test_anchors_are_leftmost_minima(monkeypatch):
    pick = random.Random(1)
    width = suffix_dedup.LENGTH - suffix_dedup.GRAM + 1
    for segment in (1 << 20, 50):
        monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
        for trial in range(30):
            n = pick.randint(150, 900)
            data = np.array([pick.choice(b"abcdefgh" if trial % 3 else b"a") for _ in range(n)], dtype=np.uint8)
            _, place, first, last = suffix_dedup.anchors(data)
            if n < suffix_dedup.LENGTH:
                assert not len(place)
                continue
            monkeypatch.setattr(suffix_dedup, "SEGMENT", 1 << 20)
            hashes = suffix_dedup.gram_hashes(data)
            monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
            want = [int(p + np.argmin(hashes[p:p + width])) for p in range(n - suffix_dedup.LENGTH + 1)]
            assert [int(a) for a, x, z in zip(place, first, last) for _ in range(z - x + 1)] == want


def test_blind_trie_orders_strings():
    pick = random.Random(2)
    strings = [bytes(pick.choice(b"ab") for _ in range(12)) for _ in range(300)]
    trie = suffix_dedup.BlindTrie()
    for i, s in enumerate(strings):
        trie.insert(s, i)
    groups = list(trie.ordered())
    assert [strings[g[0]] for g in groups] == sorted(set(strings))
    assert all(len({strings[i] for i in g}) == 1 for g in groups) and sum(map(len, groups)) == len(strings)


def test_repeated_suffixes():
    pick = random.Random(4)
    text = bytes(pick.choice(b"ab") for _ in range(3000)) * 2 + b"a" * 300
    starts = np.arange(0, len(text) - 40)
    got = suffix_dedup.repeated_suffixes(text, starts, 40, 16)
    count = Counter(text[p:p + 40] for p in starts)
    assert got.tolist() == [count[text[p:p + 40]] > 1 for p in starts]

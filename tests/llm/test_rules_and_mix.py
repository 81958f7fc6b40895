"""Quality rules, mixing and packing against plain Python."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stacklens.llm import common, mixing, packing, quality
from tests.llm.data import COLUMNS, documents, edge_rows, sentences

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines))


def quality_rows():
    rows = edge_rows()
    rows += [(20, "one two three four five six seven eight\n" * 9, "bad"), (21, "a " * 9, "bad"), (22, "# | < > * $ % &" * 5, "bad"),
             (23, sentences(8, 40) + " " + sentences(8, 40), "a"), (24, "x\n\ny\nx\n x\n", "a"), (25, "\v".join("abcdefghij") * 4, "b")]
    rows += [(200 + k, "too short", "spam") for k in range(40)] + [(300 + k, sentences(600 + k, 60), "good") for k in range(40)]
    return rows + [(400, sentences(700, 60), "spam")]


def verdicts(rows):
    n, fails = Counter(), defaultdict(Counter)
    for _, t, s in rows:
        w, _, sym, dup, rep, lines = measures(t)
        n[s] += 1
        for r, bad in zip(quality.RULES, (w < 20, 100 * rep > 30 * w, sym > 0.5 * w, 100 * dup > 50 * lines)):
            fails[r][s] += bad
    out = {}
    for s in n:
        worst = 0.0
        for r in quality.RULES:
            m = sum(fails[r].values()) / sum(n.values())
            rates = [fails[r][x] / n[x] for x in n]
            v = sum((x - sum(rates) / len(rates)) ** 2 for x in rates) / len(rates)
            k = 1e6 if v <= m * (1 - m) / (1e6 + 1) else max(m * (1 - m) / v - 1, 1.0)
            worst = max(worst, (fails[r][s] + m * k) / (n[s] + k))
        out[s] = worst <= 0.5
    return out


def test_quality_against_plain_python(spark):
    rows = quality_rows()
    hosts = verdicts(rows)
    assert not hosts["spam"] and hosts["good"]
    want = []
    for i, t, s in rows:
        w, chars, sym, dup, rep, _ = measures(t)
        failed = w < 20 or 100 * rep > 30 * w
        want.append((i, w, chars, sym, dup, rep, failed, hosts[s], not failed and hosts[s]))
    got = [tuple(r) for r in quality.quality_rules(documents(spark, rows)).collect()]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_quality_stage_keeps_columns(spark):
    rows = quality_rows()
    kept = quality.keep_quality(documents(spark, rows))
    assert kept.columns == COLUMNS
    judged = quality.quality_rules(documents(spark, rows)).where("kept")
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in judged.collect())
    assert quality.keep_quality(documents(spark, [])).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    from stacklens.llm import common

    rows = quality_rows()
    want = sorted(map(str, quality.quality_rules(documents(spark, rows)).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(map(str, quality.quality_rules(documents(spark, rows)).collect())) == want


# --- mixing ------------------------------------------------------------------------------


def targets(sizes, weights=(3, 1, 2)):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, full, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        level = (left - sum(2 * sizes[s] for s in full)) / max(1e-9, sum(weight[s] for s in sizes if s not in full))
        more = {s for s in sizes if s not in full and level * weight[s] >= 2 * sizes[s]}
        if not more:
            break
        full |= more
    for s in sizes:
        out[s] = 2.0 * sizes[s] if s in full else level * weight[s]
    return out


def mix_rows():
    pick = np.random.default_rng(5)
    rows = edge_rows()
    for k, n in enumerate((900, 200, 120, 60, 10)):
        rows += [(1000 * (k + 1) + i, sentences(k * 1000 + i, int(pick.lognormal(3, 1)) + 1), f"s{k}") for i in range(n)]
    return rows


@pytest.fixture(scope="module")
def mix(spark):
    rows = mix_rows()
    return rows, mixing.mix_sources(documents(spark, rows)).collect()


def test_mix_meets_targets(mix):
    rows, got = mix
    assert len(got) == len(rows)
    sizes, taken, biggest = Counter(), Counter(), Counter()
    want_size = sorted((str(i), len(WORD.findall(t or ""))) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r["size"]) for r in got) == want_size
    for i, t, s in rows:
        n = len(WORD.findall(t or ""))
        sizes[s] += n
        biggest[s] = max(biggest[s], n)
    due = targets(sizes)
    by_size = {(r.source_size, round(r.target, 6)) for r in got}
    assert by_size == {(sizes[s], round(due[s], 6)) for s in sizes}
    assert all(r.taken == r.copies * r["size"] and r.taken <= 2 * r["size"] for r in got)
    for r in got:
        taken[r.source_size] += r.taken
    for s in sizes:
        assert abs(taken[sizes[s]] - due[s]) <= max(biggest[s] / 2, 0.01 * due[s]), s


def test_mix_agrees_when_run_again(spark, mix):
    rows, got = mix
    again = mixing.mix_sources(documents(spark, rows).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_rows(spark):
    rows = mix_rows()[:400]
    docs = documents(spark, rows)
    out = mixing.mixed(docs)
    assert out.columns == COLUMNS
    copies = Counter()
    for r in mixing.mix_sources(docs).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +copies
    assert mixing.mixed(documents(spark, [])).count() == 0
    assert mixing.mix_sources(documents(spark, [(1, None, "a"), (2, "", None)])).where("taken > 0").count() == 0


def test_chunks_and_rounds(spark):
    pick = np.random.default_rng(1)
    units = [(i, i, 1, int(n), 0.3) for i, n in enumerate(pick.lognormal(5, 1.5, 3000) + 1)]
    df = spark.createDataFrame(units, "rid long, key long, rank long, size long, p double")
    drawn = {r.rid for r in mixing.cube_sample(df, chunk=100).collect()}
    words = sum(u[3] for u in units)
    assert abs(len(drawn) - 900) <= 3
    assert abs(sum(u[3] for u in units if u[0] in drawn) - 0.3 * words) <= 0.01 * words


def test_flight_keeps_totals():
    random = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 400):
        size, p = random.integers(1, 1000, n).astype(float), random.uniform(0, 1, n)
        q = mixing.flight(p, size, np.random.default_rng(n))
        assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 2
        assert math.isclose(q.sum(), p.sum(), abs_tol=1e-5) and math.isclose((q * size).sum(), (p * size).sum(), rel_tol=1e-6, abs_tol=1e-3)
    mean = np.mean([mixing.flight(np.full(9, 0.4), np.arange(1.0, 10), np.random.default_rng(k)) for k in range(3000)], axis=0)
    assert np.abs(mean - 0.4).max() < 0.04


def test_landing_comes_near_with_few_changes():
    random = np.random.default_rng(2)
    size = np.sort(random.integers(1, 2000, 60).astype(float))[::-1].copy()
    start = np.full(60, 0.37)
    p = mixing.flight(start, size, np.random.default_rng(1))
    landed = mixing.landing(start, p, size)
    assert set(landed.tolist()) <= {0.0, 1.0} and abs(landed.sum() - start.sum()) < 1
    assert abs(landed @ size - start @ size) <= 0.001 * (start @ size)
    decided = np.isin(p, (0.0, 1.0))
    assert (landed[decided] != p[decided]).sum() <= 12
    done = np.array([0.0, 1.0, 1.0])
    assert np.array_equal(mixing.landing(done, done, np.ones(3)), done)


@pytest.mark.parametrize("at_once", [100_000, 7])
def test_equal_rows_are_told_apart_and_dealt_evenly(spark, at_once):
    rows = spark.createDataFrame([(None, "a", 5)] * 1200 + [(1, "a", 5)] * 3 + [(1, None, 5)], "key long, source string, size long")
    units = common.told_apart(rows, "test", at_once)
    got = units.groupBy("key", "source", "size").agg(F.min("repeat"), F.max("repeat"), F.countDistinct("repeat"), F.count(F.lit(1))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(None, "a", 5, 0, 1199, 1200, 1200), (1, "a", 5, 0, 2, 3, 3), (1, None, 5, 0, 0, 1, 1)]))
    parts = units.where("key IS NULL").groupBy(F.pmod(F.xxhash64("key", "size", "repeat"), F.lit(12))).count().collect()
    assert len(parts) == 12 and max(r["count"] for r in parts) < 160


def test_mix_of_equal_ids(spark):
    rows = [(None, "one two three", "a")] * 200 + [(1, "four", "b")] * 50 + [(1, "five six", "b")] * 50
    docs = documents(spark, rows)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == 300 and all(r.copies in (0, 1, 2) for r in got)
    for s in {r.source_size for r in got}:
        assert abs(sum(r.taken for r in got if r.source_size == s) - next(r.target for r in got if r.source_size == s)) <= 3
    assert sorted(map(str, mixing.mix_sources(docs.repartition(5)).collect())) == sorted(map(str, got))
    assert mixing.mixed(docs).count() > 0


# --- packing -----------------------------------------------------------------------------


def naive(lengths, sources, clusters, capacity):
    bins, where, offsets = [], [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(capacity - b["n"], k) for k, b in enumerate(bins)
                if b["n"] + lengths[i] <= capacity and sources[i] not in b["s"] and clusters[i] not in b["c"]]
        if fits:
            room = min(f[0] for f in fits)
            best = {k for r, k in fits if r == room}
        else:
            bins.append({"n": 0, "s": set(), "c": set()})
            best = {len(bins) - 1}
        yield i, best, where, offsets, bins


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_takes_the_tightest_bin(seed):
    pick = np.random.default_rng(seed)
    n, capacity = 400, 100
    lengths = pick.integers(1, 101, n).tolist()
    sources = np.where(pick.random(n) < 0.34, 0, pick.integers(1, 12, n)).tolist()
    clusters = np.where(pick.random(n) < 0.3, 0, np.arange(n) + 1).tolist()
    got, offsets = packing.pack_group(lengths, sources, clusters, capacity)
    for i, best, _, _, bins in naive(lengths, sources, clusters, capacity):
        assert got[i] in best
        assert offsets[i] == bins[got[i]]["n"]
        bins[got[i]]["n"] += lengths[i]
        bins[got[i]]["s"].add(sources[i])
        bins[got[i]]["c"].add(clusters[i])


def packed_rows():
    rows = edge_rows()
    rows += [(1000 + k, sentences(k, 5 + 13 * k % 300), "src" if k % 3 == 0 else f"s{k % 7}") for k in range(300)]
    return rows + [(5000 + k, sentences(77, 90), f"c{k % 5}") for k in range(60)]


def test_packing_is_whole_and_free_of_conflicts(spark):
    rows = packed_rows()
    got = packing.pack(documents(spark, rows), capacity=200, group=100).collect()
    words = Counter()
    for i, t, _ in rows:
        words[i] += len(WORD.findall(t or ""))
    assert Counter({k: v for k, v in words.items() if v}) == +Counter({
        i: sum(r.n_words for r in got if r.doc_id == i) for i in words})
    assert sum(r.bin_id is None for r in got) == sum(not WORD.search(t or "") for _, t, _ in rows)
    source, text = {i: s for i, _, s in rows}, {i: " ".join(WORD.findall((t or "").lower())) for i, t, _ in rows}
    bins = defaultdict(list)
    for r in got:
        assert r.start_word == 200 * r.piece
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for pieces in bins.values():
        pieces.sort(key=lambda r: r.bin_offset)
        assert sum(r.n_words for r in pieces) <= 200
        assert [r.bin_offset for r in pieces] == [sum(x.n_words for x in pieces[:k]) for k in range(len(pieces))]
        known = [r.doc_id for r in pieces if r.doc_id is not None]
        assert len({source[i] for i in known}) == len(known) and len({text[i] for i in known}) == len(known)


def test_bins_do_not_depend_on_partitions(spark):
    docs = documents(spark, packed_rows())
    once, again, third = (sorted(map(str, packing.pack(d, capacity=200, group=100).collect()))
                          for d in (docs, docs.repartition(9), docs.orderBy(F.desc("text")).coalesce(1)))
    assert once == again == third


def test_packing_of_nothing(spark):
    assert packing.pack(documents(spark, [])).count() == 0
    assert [r.bin_id for r in packing.pack(documents(spark, [(1, None, None)])).collect()] == [None]

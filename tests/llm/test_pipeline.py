"""The pipeline's stages, each checked on its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from stacklens.llm.common import documents
from tests.llm.test_dedup import classes, norm, plain_fingerprint
from tests.llm.test_rules_and_mix import measures, verdicts


@pytest.fixture(scope="module")
def outputs(spark, tiny, tmp_path_factory):
    home = tmp_path_factory.mktemp("stages")
    out = [documents(spark, tiny)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], tiny).write.parquet(str(home / name))
        out.append(spark.read.parquet(str(home / name)))
    return [df.collect() for df in out], [df.columns for df in out]


def test_stages(outputs):
    frames, columns = outputs
    assert all(c == columns[0] for c in columns[:5])
    source, rules, exact, near, mix, packed = frames
    rows = [(r.doc_id, r.text, r.source) for r in source]
    hosts = verdicts(rows)
    want = {i for i, t, s in rows if (m := measures(t))[0] >= 20 and 100 * m[4] <= 30 * m[0] and hosts[s]}
    assert {r.doc_id for r in rules} == want and len(rules) == len(want)
    first = {}
    for r in sorted(rules, key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(first.values())
    roots = classes([plain_fingerprint(r.text) for r in exact])
    least = {}
    for r, root in zip(exact, roots):
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in near) == sorted(least.values())
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in near}
    copies = Counter(r.doc_id for r in mix)
    assert set(copies) <= set(words) and max(copies.values()) <= 2
    total = sum(words.values())
    assert abs(sum(words[i] * n for i, n in copies.items()) - 1.5 * total) < 0.1 * total
    assert Counter({i: words[i] * n for i, n in copies.items()}) == Counter(
        {i: sum(p.n_words for p in packed if p.doc_id == i) for i in copies})


def test_run_gives_the_last_stage(spark, tiny, outputs):
    got = corpus_pipeline.run(spark, tiny)
    assert sorted((r.doc_id, r.piece, r.n_words) for r in got.collect()) == sorted((r.doc_id, r.piece, r.n_words) for r in outputs[0][-1])

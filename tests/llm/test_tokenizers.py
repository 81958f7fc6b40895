"""Alignment of two tokenizers, fill-in-middle, and encoding by chunks, against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stacklens.llm import chunked_bpe, fill_middle, oracle, queries, tokenizer_alignment
from tests.llm.data import COLUMNS, documents, edge_rows, sentences

BYTE, PIECE, WORD = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def odd_texts():
    return ["<|endoftext|> and <|startoftext|>", "tabs\t\tand spaces 　 wide", "ẹ́ decomposed 한", "▁ lower bar ▁▁x",
            "日本語のテキスト と 🙂🙂 emoji", "a" * 9000, "x " * 6000, "\x00\x01\x1c control", "İstanbul ΣΑΣ ǅ", "don't 'S 're 100,000.50!!",
            "́starts with a mark", "no-break line", "<0x41> <unk> <s>", " " * 5000, "ﬁ ligature ½", "word​join " * 700]


def many(spark):
    rows = edge_rows() + [(100 + i, t, "o") for i, t in enumerate(odd_texts())]
    shared = sentences(50, 3000, 4000)
    rows += [(200 + i, sentences(60 + i, 40 + 37 * i, 3000) + shared[i * 7:], "s") for i in range(12)]
    return rows, documents(spark, rows).repartition(3)


# --- chunks and encoding ----------------------------------------------------------------------

def test_chunks_depend_on_content_only():
    text = sentences(1, 20_000, 5000).encode()
    ends = chunked_bpe.chunk_ends(text)
    assert b"".join(text[a:b] for a, b in zip([0, *ends], ends)) == text
    sizes = np.diff([0, *ends])
    assert sizes.max() <= chunked_bpe.LONGEST + 3 and sizes[:-1].min() >= chunked_bpe.SHORTEST and 300 < sizes.mean() < 900
    ahead = "ein anderer Anfang, der ".encode()
    moved = {e - len(ahead) for e in chunked_bpe.chunk_ends(ahead + text)}
    assert len(moved & set(ends)) > 0.95 * len(ends)
    assert chunked_bpe.chunk_ends(b"") == [0]
    for end in chunked_bpe.chunk_ends(("é" * 20_000).encode()):
        assert end % 2 == 0


def test_rolling_hash_over_slices(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 3000).astype(np.uint8)
    plain = []
    for i in range(len(data)):
        h = 0
        for k, b in enumerate(data[max(0, i - chunked_bpe.WINDOW + 1):i + 1][::-1].tolist()):
            h += int(chunked_bpe._BYTE[b]) * pow(chunked_bpe._FACTOR, k, 1 << 32)
        plain.append(h % (1 << 32))
    assert chunked_bpe.rolling(data).tolist() == plain
    text = data.tobytes()
    want = chunked_bpe.chunk_ends(text)
    monkeypatch.setattr(chunked_bpe, "SLICE", 100)
    assert chunked_bpe.chunk_ends(text) == want


def test_encoding_equals_the_library(spark):
    rows, docs = many(spark)
    library = Tokenizer.from_file(WORD)
    found = chunked_bpe.decode(chunked_bpe.encode(docs, WORD), WORD).collect()
    want = Counter()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded.decode()) for r in found) == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)


def test_chunks_are_encoded_once(monkeypatch):
    coder = chunked_bpe.Encoder(WORD)
    asked = []
    plain = chunked_bpe.encode_chunks
    monkeypatch.setattr(chunked_bpe, "encode_chunks", lambda c, texts: asked.extend(texts) or plain(c, texts))
    shared = sentences(50, 3000, 4000)
    texts = [(sentences(60 + i, 40 + 37 * i, 3000) + " " + shared).encode() for i in range(20)]
    for t in texts:
        ids = chunked_bpe.encode_texts(coder, [t, t])
        assert ids[0].tolist() == ids[1].tolist() == coder.tokenizer.encode(t.decode(), add_special_tokens=False).ids
    assert len(asked) == len(set(asked))
    assert sum(map(len, asked)) < 0.45 * sum(map(len, texts))


def test_forgetful_encoding(monkeypatch):
    monkeypatch.setattr(chunked_bpe, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(chunked_bpe, "WORDS", 100)
    monkeypatch.setattr(chunked_bpe, "LONG_WORD", 3)
    coder = chunked_bpe.Encoder(WORD)
    for i in range(30):
        texts = [sentences(i % 7, 300, 4000), sentences(i % 5, 700, 4000)]
        ids = chunked_bpe.encode_texts(coder, [t.encode() for t in texts])
        assert [x.tolist() for x in ids] == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_encode_whole_texts(spark):
    rows, docs = many(spark)
    library = Tokenizer.from_file(BYTE)
    assert not chunked_bpe.encoder(BYTE).keeps_words_apart() and chunked_bpe.encoder(WORD).keeps_words_apart()
    found = chunked_bpe.decode(chunked_bpe.encode(docs, BYTE), BYTE).collect()
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found) == want
    assert {r.decoded.decode() for r in found} == {t or "" for _, t, _ in rows}


def test_encoding_of_an_empty_table(spark):
    docs = documents(spark, [(1, "a", "b")]).where("doc_id > 1")
    out = chunked_bpe.digests(chunked_bpe.decode(chunked_bpe.encode(docs, WORD), WORD))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0


def test_encoding_query(spark, tiny):
    library = Tokenizer.from_file(WORD)
    want = {}
    for r in spark.read.parquet(f"{tiny}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False)))
    assert {r[0]: tuple(r[1:]) for r in queries.op13_bpe_chunks(spark, tiny).collect()} == want


# --- alignment --------------------------------------------------------------------------------

def plain_alignment(rows):
    """Groups, links and counts, token by token."""
    a_lib, b_lib = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a_lib.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbol = dict(zip(map(chr, visible), visible))
    symbol.update(zip(map(chr, range(256, 400)), [b for b in range(256) if b not in set(visible)]))
    tokens = []
    for _, text, _ in rows:
        a = b = []
        if text:
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            raw_a = [bytes(symbol[c] for c in a_lib.id_to_token(i)) for i in a]
            raw_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                     for p in map(b_lib.id_to_piece, b)]
            if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                a = b = []
        if not a:
            tokens.append(([], [], [], []))
            continue
        ends = [np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b)]
        spans = [list(zip([0, *e], e)) for e in ends]
        links = []
        j = 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        groups, start = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append([[x for x, (s, e) in zip(ids, sp) if start <= s and e <= cut] for ids, sp in zip((a, b), spans)])
            start = cut
        tokens.append((a, b, links, groups))
    counts = Counter(link for t in tokens for link in t[2])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    made = Counter()
    for (i, _, _), (a, b, links, groups) in zip(rows, tokens):
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        made[i, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
             sha(text) if a else ""] += 1
    return made


@pytest.fixture(scope="module")
def short_rows():
    return [(i, t if t is None or len(t) < 5000 else t[:5000], s) for i, t, s in edge_rows()] + [
        (100 + i, t[:3000], "o") for i, t in enumerate(odd_texts())] + [(300 + i, sentences(i, 60, 30), "x") for i in range(20)]


@pytest.fixture(scope="module")
def plain_rows(short_rows):
    return plain_alignment(short_rows)


@pytest.mark.parametrize("limit", [tokenizer_alignment.BROADCAST_PAIRS, 0])
def test_alignment(spark, short_rows, plain_rows, limit):
    docs = documents(spark, short_rows).repartition(3)
    found = tokenizer_alignment.alignment(docs, BYTE, PIECE, broadcast_pairs=limit)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, found.collect())) == plain_rows


def test_alignment_in_small_parts(spark, short_rows, plain_rows, monkeypatch):
    monkeypatch.setattr(tokenizer_alignment, "PAIRS_HELD", 50)
    monkeypatch.setattr(tokenizer_alignment, "TEXT_AT_ONCE", 500)
    docs = documents(spark, short_rows)
    assert Counter(map(tuple, tokenizer_alignment.alignment(docs, BYTE, PIECE).collect())) == plain_rows


PAIR = tokenizer_alignment.tokenizer_pair(BYTE, PIECE)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(max_codepoint=0x3100, exclude_categories=("Cs",)), st.sampled_from("ab  \n\t\x1c'|>1")), max_size=30),
                max_size=4))
def test_remembered_parts_give_the_library_s_ids(texts):
    found = [np.frombuffer(x, "<u4").tolist() for x in PAIR.a.encode(texts)]
    assert found == [PAIR.a.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_partner_array():
    pair = tokenizer_alignment.TokenizerPair(BYTE, PIECE)
    for i in np.flatnonzero(pair.same >= 0)[:3000].tolist():
        assert pair.bytes_a[i] == pair.bytes_b[pair.same[i]]
    assert pair.same[50256] == -1 and (pair.same >= 0).sum() > 5000


def test_alignment_of_an_empty_table(spark):
    assert tokenizer_alignment.alignment(documents(spark, [(1, "a", "b")]).where("doc_id > 1"), BYTE, PIECE).count() == 0


def test_alignment_query(spark, tiny):
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    assert Counter(map(tuple, queries.op11_tokenizer_alignment(spark, tiny).collect())) == plain_alignment(rows)


# --- fill-in-middle ---------------------------------------------------------------------------

def plain_fill(i, text, rate=90, spm=20):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if i is None else i}")
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return i, len(units), "plain", None, None, text, text
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return i, len(units), form, len(p), len(m), out, text


def test_fill_in_middle(spark):
    rows, _ = many(spark)
    rows += [(400 + i, f"{i} some <text> with <P, S> and > < signs", "m") for i in range(60)] + [(500, "a <P> mark", "m"), (501, "<M>", "m")]
    docs = documents(spark, rows).repartition(3)
    assert COLUMNS[:2] == ["doc_id", "text"]
    found = fill_middle.restore(fill_middle.fill_in_middle(docs)).collect()
    assert Counter((*r[:5], r.output.decode(), r.restored.decode()) for r in found) == Counter(plain_fill(i, t) for i, t, _ in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("rate,spm", [(0, 0), (100, 100), (100, 0)])
def test_fill_in_middle_parameters(spark, rate, spm):
    rows, docs = many(spark)
    found = fill_middle.fill_in_middle(docs, rate=rate, spm=spm).collect()
    assert Counter((*r[:5], r.output.decode()) for r in found) == Counter(plain_fill(i, t, rate, spm)[:6] for i, t, _ in rows)


def test_fill_in_middle_of_an_empty_table(spark):
    docs = documents(spark, [(1, "a", "b")]).where("doc_id > 1")
    assert fill_middle.digests(fill_middle.fill_in_middle(docs)).count() == 0
    assert "op12_fill_in_middle" in oracle.oracle_sql()


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_joins_at_any_place(data):
    """Cuts anywhere, also inside words, marks and special tokens, leave the library's ids."""
    piece = st.one_of(st.text(st.characters(max_codepoint=0x3100), max_size=4),
                      st.sampled_from(["hello", "wörld's", "<|endoftext|>", " ", "\n", " ", "é", "123", "á", "한"]))
    text = "".join(data.draw(st.lists(piece, max_size=30))).encode("utf-8", "ignore").decode()
    cuts = sorted(data.draw(st.sets(st.integers(0, len(text)), max_size=6)))
    chunks = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
    coder = chunked_bpe.encoder(WORD)
    made = chunked_bpe.join_chunks(coder, chunked_bpe.remembered_chunks(coder, [chunks, [text]]))
    assert [x.tolist() for x in made] == 2 * [coder.tokenizer.encode(text, add_special_tokens=False).ids]

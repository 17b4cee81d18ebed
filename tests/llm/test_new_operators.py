"""Collocations, token alignment and vector search against plain Python."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from voxpop.llm import collocations as C
from voxpop.llm import token_alignment as TA
from voxpop.llm import vector_search as V

# -- collocations --------------------------------------------------------------


def collocations_by_hand(rows, longest, least, absorbed, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    cands = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = {}
    for (lang, p), a in cands.items():
        if any(l2 == lang and len(q) > len(p) and 100 * b >= absorbed * a and inside(p, q) for (l2, q), b in cands.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, i + 1, phrase.decode(), -a, l, r, n[lang], -s)
        for lang, listed in out.items()
        for i, (s, a, phrase, l, r) in enumerate(sorted(listed)[:top])
    }


def phrase_rows():
    rng = np.random.default_rng(5)
    words = ["New", "york", "ci\x01ty", "état", "of", "the", "art", "x\x00y", "a", "b"]
    rows = [(["en", "fr", None, "und"][i % 4], " ".join(rng.choice(words, int(rng.integers(0, 30)))) + ["", ". of the art", "\tof  the\tart!"][i % 3]) for i in range(150)]
    return rows + [("en", None), ("de", ""), (None, "  \n\t"), ("en", "na " * 400), ("en", "the art of. the art of\vthe art")] + [("en", "same old copy of the text")] * 50


@pytest.mark.parametrize(("absorbed", "held"), [(100, True), (60, True), (100, False)])
def test_collocations_by_hand(spark, monkeypatch, absorbed, held):
    monkeypatch.setattr(C, "BLOCK", 100)
    if not held:
        monkeypatch.setattr(C, "WORDS_HELD", 3)
        monkeypatch.setattr(C, "PAIRS_HELD", 3)
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = C.collocations(docs, least=3, absorbed=absorbed, top=40).collect()
    assert {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got} == collocations_by_hand(rows, 5, 3, absorbed, 40)


def test_collocation_scores_beyond_64_bits(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "a b")] * 4, "lang string, text string")
    big = 4_000_000_000
    real = C.word_counts
    monkeypatch.setattr(C, "word_counts", lambda d, least: real(d, least).withColumn("f", C.F.col("f") * big))
    (row,) = C.collocations(docs, least=2).collect()
    assert row["score"] == 1000 * 4 * (8 * big) // (4 * big * 4 * big)
    assert row["n"] == 8 * big


def test_collocations_odd_tables(odd_docs, with_clashes, no_docs):
    assert C.collocations(no_docs).count() == 0
    plain, clashed = (C.collocations(d, least=2).collect() for d in (odd_docs, with_clashes(odd_docs)))
    assert sorted(plain) == sorted(clashed) and plain


def test_windows_of_numbered_words(spark, monkeypatch):
    """Blocks of word numbers hold the same windows as blocks of words, and repeat no
    window within a block."""
    monkeypatch.setattr(C, "BLOCK", 50)
    monkeypatch.setattr(C, "READ", 64)
    monkeypatch.setattr(C, "SENT", 7)
    odd = ["", " ", "A b\tB  c\x1cd, a b b", "Ünï ünï a\x0bb a;b", "a" * 70 + " b a b", "b a\r\nb a b a b a!b a", "ü b ü b ü\x00 b ü"]
    rows = [(lang, text) for lang in ("en", "ö", "und") for text in odd * 5]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    words = {lang: C.in_byte_order({w for r in rows if r[0] == lang for w in C.words_of(r[1])} - {"\n"}) for lang in ("en", "ö", "und")}

    def runs(lang, ids):
        reach = C.reach_of((ids[:-1] > 0) & (ids[1:] > 0), 5)
        at = np.flatnonzero(reach > 1)
        return at, reach[at].astype(np.int64) + 1

    def summed(found):
        return sorted(found.groupBy("lang", "window").agg(C.F.sum("f")).collect())

    numbered = C.number_blocks(docs, words, runs, 5)
    assert summed(numbered) == summed(C.blocks(docs, lambda w: C.runs_of(w, 5))) != []
    monkeypatch.setattr(C, "BLOCK", 10_000)
    whole = C.number_blocks(docs, words, runs, 5).select("lang", "window").collect()
    assert len(set(whole)) == len(whole)
    assert all([r["window"].encode() for r in whole if r["lang"] == lang] == sorted(r["window"].encode() for r in whole if r["lang"] == lang) for lang in words)


# -- token alignment -----------------------------------------------------------


def tokens_by_hand(text):
    """(A ids, A bytes, B ids, B bytes) from the tokenizers file and the model."""
    import public_tokenizers as files
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=files.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    a = a_model.encode(" " + text, add_special_tokens=False).ids
    b = b_model.encode(text)
    a_bytes = [bytes(byte[c] for c in a_model.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return a, a_bytes, b, b_bytes


def spans(pieces):
    ends = np.cumsum([len(p) for p in pieces]).tolist()
    return list(zip([0, *ends], ends))


def aligned_by_hand(texts):
    docs, held = [], Counter()
    for text in texts:
        a, a_bytes, b, b_bytes = tokens_by_hand(text or "")
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append((0, 0, 0, Counter(), ""))
            continue
        sa, sb = spans(a_bytes), spans(b_bytes)
        links = Counter((x, y) for x, (s, e) in zip(a, sa) for y, (t, u) in zip(b, sb) if s < u and t < e)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups = [
            ",".join(str(x) for x, (s, e) in zip(a, sa) if lo <= s and e <= hi) + "|" + ",".join(str(y) for y, (t, u) in zip(b, sb) if lo <= t and u <= hi)
            for lo, hi in zip([0, *cuts], cuts)
        ]
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.update(links.keys())
    highest = Counter()
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    return [
        (n_a, n_b, n_g, sum(k.values()), sum(c for p, c in k.items() if held[p] == highest[p[0]]), sum(c * held[p] for p, c in k.items()), d)
        for n_a, n_b, n_g, k, d in docs
    ]


TEXTS = [
    "Hello world, this is antidisestablishmentarianism.", "  two  spaces\n\nand\tlines ", "日本語のテキスト 😀👩‍👩‍👧 naïve café", "▁looks like a mark", None, "",
    "<|endoftext|> is <s> plain </s> text <0x41>", "Hello world, this is again", "Hello world, this is again", "x" * 3000, "½ﬁ Ⅻ   ﷺ", "\x00\x01 control", "don't we'll I'm",
]


@pytest.mark.parametrize("sent", [TA.PAIRS_SENT, 5])
def test_alignment_by_hand(make_docs, monkeypatch, sent):
    monkeypatch.setattr(TA, "PAIRS_SENT", sent)
    monkeypatch.setattr(TA, "REMEMBERED", 7)
    docs = make_docs(list(enumerate(TEXTS)))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = [tuple(r[c] for c in columns) for r in TA.align_tokenizers(docs).orderBy("doc_id").collect()]
    assert got == aligned_by_hand(TEXTS)
    assert got[3][0] == got[4][0] == got[5][0] == 0 and got[2][0] > 0


def test_texts_aligned_together(monkeypatch):
    """What a text's alignment is doesn't depend on the texts beside it, nor on whether
    its windows are told apart by one number or by their tuples."""
    import public_tokenizers as files

    aligner = TA.Aligner(files.path("byte_bpe_50k.tiktoken"), files.path("piece_bpe_32k.model"))
    texts = [text or "" for text in (*TEXTS, "é ünï 漢字", None, "a b a b", *TEXTS)]
    plain = lambda rows: [(*r[:5], list(r[5]), list(r[6])) for r in rows]
    alone = plain(row for text in texts for row in aligner.align([text]))
    assert plain(aligner.align(texts)) == alone
    aligner.known.clear()
    aligner.a_bits = aligner.b_bits = 24  # windows of up to two tokens have a number
    assert plain(aligner.align(texts)) == alone
    monkeypatch.setattr(TA, "TEXTS", 3)
    monkeypatch.setattr(TA, "CHARS", 50)
    parts = list(TA.portions(texts))
    assert [at for begin, end in parts for at in range(begin, end)] == list(range(len(texts))) and len(parts) > len(texts) // 3
    assert plain(row for begin, end in parts for row in aligner.align(texts[begin:end])) == alone
    assert list(TA.portions([])) == [] == aligner.align([])


def test_alignment_odd_tables(odd_docs, with_clashes, no_docs):
    assert TA.align_tokenizers(no_docs).count() == 0
    rows = TA.align_tokenizers(with_clashes(odd_docs)).collect()
    assert len(rows) == odd_docs.count() and sum(r["doc_id"] is None for r in rows) == 2
    same = [r for r in rows if r["doc_id"] == 2]
    assert same[0] == same[1] and same[0]["n_links"] > 0
    assert sorted(rows, key=str) == sorted(TA.align_tokenizers(odd_docs.repartition(3)).collect(), key=str)


# -- vector search ---------------------------------------------------------------


def nearest_by_hand(rows, every, most):
    """(query id, [(id, cosine)]) per query row, best first."""
    def fit(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    live = [(i, np.array(v, float)) for i, v in rows if fit(v)]
    out = []
    for at, (i, q) in enumerate(live):
        if i is None or i % every:
            continue
        near = [
            (j, float(q @ v / np.sqrt((q @ q) * (v @ v)))) for k, (j, v) in enumerate(live) if k != at and len(v) == len(q)
        ]
        near.sort(key=lambda x: (-round(x[1], 12), x[0] is None, x[0] or 0))
        out.append((i, near[:most]))
    return out


def test_search_by_hand(spark):
    rng = np.random.default_rng(2)
    few = [list(map(float, rng.integers(-2, 3, 6))) for _ in range(40)]  # many ties
    rows = [(i, few[int(rng.integers(40))]) for i in range(300)]
    rows += [(400, None), (450, []), (500, [0.0] * 6), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] + [1.0] * 5), (650, [float("inf")] * 6)]
    rows += [(700, [1.0, 2.0]), (701, [2.0, 1.0]), (750, [1.0] * 3), (None, few[0]), (50, few[1]), (50, few[1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    # ids that repeat make rows ambiguous by id: compare scores there, ids elsewhere
    got = {}
    for r in V.nearest(df, recall=1.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {}
    for i, near in nearest_by_hand(rows, V.EVERY, V.NEAREST):
        want.setdefault(i, []).append(near)
    assert set(got) == {i for i, near in want.items() if near[0]}
    for i, lists in want.items():
        if not lists[0]:
            continue
        mine = sorted(got[i], key=lambda x: x[0])
        assert sorted(round(s, 9) for _, _, s in mine) == sorted(round(s, 9) for near in lists for _, s in near)
        if len(lists) == 1:
            assert [r for r, _, _ in mine] == list(range(1, len(lists[0]) + 1))
            assert [j for _, j, _ in mine] == [j for j, _ in lists[0]]


def test_search_recall_and_tests(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 24)) + 2 * rng.standard_normal((12, 24))[rng.integers(12, size=3000)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {i: {j for j, _ in near} for i, near in nearest_by_hand(rows, 50, 5)}
    found = V.nearest(df).collect()
    assert len(found) == 5 * len(want)
    assert sum(r["vec_id"] in want[r["query_id"]] for r in found) >= 0.9 * 5 * len(want)


def test_a_third_of_all_vectors_equal(spark, monkeypatch):
    monkeypatch.setattr(V, "CHUNK", 20)
    monkeypatch.setattr(V, "TILE", 3)
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.standard_normal(4).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in V.nearest(df, recall=1.0).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {i: [j for j, _ in near] for i, near in nearest_by_hand(rows, 50, 5)}


def test_search_of_an_empty_table(spark):
    assert V.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_dropped_pairs_are_farther(spark):
    rng = np.random.default_rng(7)
    x, q = (v / np.linalg.norm(v, axis=1)[:, None] for v in (rng.standard_normal((500, 48)), rng.standard_normal((9, 48))))
    far = 2 - 2 * q @ x.T
    beat = np.sort(far, axis=1)[:, 5]
    at = V.survivors(x, q, beat)
    kept = set(zip(*(a.tolist() for a in at)))
    near = set(zip(*(a.tolist() for a in np.nonzero(far <= beat[:, None]))))
    assert kept <= near and len(kept) >= 0.95 * len(near)

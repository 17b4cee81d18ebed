"""The other operators against plain Python, and their odd cases."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxpop.llm import fingerprints as FP
from voxpop.llm import language as LANG
from voxpop.llm import packing as PACK
from voxpop.llm import quality as Q
from voxpop.llm import samples as SAMPLES
from voxpop.llm import sharding as SH
from voxpop.llm.html_extract import extract, extract_pages
from voxpop.llm.mix_sources import mix, mixed_corpus, source_targets
from voxpop.llm.samples import labelled_sample
from tests.conftest import SF_SMALL

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS, n))


# -- mixing ------------------------------------------------------------------


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    """Share out, cap, share the excess again until nobody is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest, w = total - sum(capped.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / w for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: float(most * sizes[s]) for s in above}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500, None: 3}, {"b": 7, "a": 7}, {"x": 1, "y": 1, "z": 5000, "w": 9}, {"only": 5}])
def test_targets_by_hand(spark, sizes):
    rows = spark.createDataFrame([(s, n, 1.0) for s, n in sizes.items()], "source string, size long, weight double")
    got = {r["source"]: r["target"] for r in source_targets(rows).collect()}
    assert got == pytest.approx(targets_by_hand(sizes))


def test_mix_odd_rows(odd_docs, with_clashes, no_docs):
    rows = mix(with_clashes(odd_docs)).collect()
    assert len(rows) == 12
    assert all(0 <= r["__copies"] <= 3 for r in rows)
    assert {r["__size"] for r in rows if not (r["text"] or "").strip()} == {0}
    assert [r["__copies"] for r in mix(odd_docs).orderBy("doc_id", "text").collect()] == [
        r["__copies"] for r in mix(odd_docs.repartition(3)).orderBy("doc_id", "text").collect()
    ]
    assert mix(no_docs).count() == 0
    copies = sum(r["__copies"] for r in rows)
    assert mixed_corpus(with_clashes(odd_docs)).columns == with_clashes(odd_docs).columns
    assert mixed_corpus(odd_docs).count() == copies


def test_mix_comes_near_its_targets(make_docs):
    rng = np.random.default_rng(3)
    docs = make_docs([(i, prose(rng, int(rng.integers(1, 60))), "en", f"s{min(i % 9, 4)}") for i in range(3000)])
    per = mix(docs).groupBy("source").agg(
        F.first("__target").alias("target"), F.sum(F.col("__size") * F.col("__copies")).alias("taken")
    )
    for r in per.collect():
        assert abs(r["taken"] - r["target"]) <= 60


@pytest.mark.parametrize("same_id", [None, 7])
def test_mix_takes_some_of_equal_rows(make_docs, same_id):
    rng = np.random.default_rng(4)
    # A source of equal rows alone, one with some, one without.
    equal = [(same_id, "ten words of text that all the equal rows share", "en", s) for s in ["s0"] * 500 + ["s1"] * 300]
    docs = make_docs([(i, prose(rng, int(rng.integers(1, 30))), "en", f"s{1 + i % 2}") for i in range(1600)] + equal)
    rows = mix(docs, weights=(3, 3, 1)).select("source", "text", "__size", "__source_size", "__target", "__copies").toPandas()
    assert len(rows) == 2400
    for _, own in rows.groupby("source"):
        assert abs((own["__size"] * own["__copies"]).sum() - own["__target"].iloc[0]) <= own["__size"].max()
    copies = rows[rows["source"] == "s0"]["__copies"]
    assert copies.max() - copies.min() == 1


# -- fingerprints ------------------------------------------------------------


def marks_by_hand(run, k=FP.K, w=FP.WINDOW):
    """(hash, position) of a list of unit hashes."""
    if len(run) < k:
        return None
    grams = []
    for i in range(len(run) - k + 1):
        h = 0
        for x in run[i : i + k]:
            h = (h * FP.BASE + x) % FP.PRIME
        grams.append(h)
    if len(grams) < w:
        windows = [range(len(grams))]
    else:
        windows = [range(i, i + w) for i in range(len(grams) - w + 1)]
    out = []
    for window in windows:
        best = min(window, key=lambda i: (grams[i], -i))
        if (grams[best], best) not in out:
            out.append((grams[best], best))
    return out


def units_by_hand(text):
    """Runs between blanks; those of more than 16 code points as code points."""
    runs = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [unit for run in runs for unit in ([run] if len(run) <= 16 else run)]


@pytest.mark.parametrize("k,w", [(5, 4), (4, 1), (3, 5), (1, 3)])
def test_marks_by_hand(spark, make_docs, k, w):
    rng = np.random.default_rng(5)
    texts = [prose(rng, n) for n in (1, 2, 3, 4, 5, 6, 8, 9, 40, 300)] + ["a b " * 40, "x" * 100, "", None]
    texts += ["y" * 16 + " " + "z" * 17 + "\t" + "é𝒳語" * 9, "語" * 16 + "\n" + "語" * 17 + " end"]
    docs = spark.createDataFrame([(t, units_by_hand(t)) for t in texts], "text string, units array<string>")
    hashed = F.transform("units", lambda u: F.pmod(F.xxhash64(u), F.lit(FP.PRIME)))
    got = FP.winnow(docs.withColumn("run", hashed), F.col("text"), "marks", k, w)
    got = got.select("run", FP.mark_hashes(F.col("marks")).alias("h"), FP.mark_positions(F.col("marks")).alias("p"))
    for r in got.collect():
        wanted = marks_by_hand(r["run"], k, w)
        if wanted is None:
            assert len(r["h"]) == min(len(r["run"]), 1)
        else:
            assert list(zip(r["h"], r["p"])) == wanted


def test_shared_runs_share_a_mark(spark, make_docs):
    rng = np.random.default_rng(6)
    shared = prose(rng, FP.K + FP.WINDOW - 1)
    docs = make_docs([(i, f"{prose(rng, 30)} own{i} {shared} mine{i} {prose(rng, 30)}") for i in range(8)])
    rows = [set(r[0]) for r in FP.winnow(docs, F.col("text"), "m").select(FP.mark_hashes(F.col("m"))).collect()]
    assert set.intersection(*rows)


@pytest.mark.parametrize("shift", range(0, 20, 3))
def test_shared_runs_without_blanks_share_a_mark_at_any_shift(spark, make_docs, shift):
    rng = np.random.default_rng(16)
    signs = lambda n: "".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 5000, n))
    shared = signs(FP.K + FP.WINDOW - 1)
    docs = make_docs([(0, signs(40) + shared + signs(40)), (1, signs(40 + shift) + shared + signs(50))])
    rows = [set(r[0]) for r in FP.winnow(docs, F.col("text"), "m").select(FP.mark_hashes(F.col("m"))).collect()]
    assert set.intersection(*rows)


def test_edits_by_hand(odd_docs, with_clashes, no_docs):
    order = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"])
    rows = sorted(FP.compare_with_edits(with_clashes(odd_docs)).collect(), key=order)
    assert len(rows) == 12
    for r, after in zip(rows, rows[1:] + rows[:1]):
        half = len(r["text"]) // 2
        assert r["edited"] == r["text"][: len(r["text"]) - half] + after["text"][:half]
        own, edited, follower = ({m >> 32 for m in x} for x in (r["marks"], r["edited_marks"], after["marks"]))
        for value, other in ((r["near_edited"], edited), (r["near_next"], follower)):
            assert value == pytest.approx(len(own & other) / len(own | other) if own | other else 1.0)
    assert FP.compare_with_edits(no_docs).count() == 0
    only = FP.compare_with_edits(odd_docs.where("doc_id = 8")).collect()
    assert [r["edited"] for r in only] == ["12345 12345 "[: 11]] or only[0]["edited"] == "12345 " + "12345"


# -- sharding ----------------------------------------------------------------


def test_shards_of_odd_rows(odd_docs, with_clashes, no_docs):
    rows = SH.shard_documents(with_clashes(odd_docs)).collect()
    assert sum(r["size"] for r in rows) == sum(len((r["text"] or "").encode()) + 1 for r in odd_docs.collect())
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and set(by_shard) <= set(range(16))
    crc = {zlib.crc32((r["text"] or "").encode()) for r in odd_docs.collect()}
    assert {r["text_crc32"] for r in rows} == crc
    assert SH.shard_documents(no_docs).count() == 0


@pytest.mark.parametrize("same_id", [None, 7])
def test_equal_rows_are_dealt_whatever_their_ids(make_docs, same_id):
    rng = np.random.default_rng(9)
    rows = [(i, prose(rng, int(rng.integers(3, 20)))) for i in range(2000)] + [(same_id, "one text in a third of all rows")] * 1000
    got = SH.shard_documents(make_docs(rows), shards=8).toPandas()
    assert len(got) == 3000
    per = got.groupby("shard").agg(size=("size", "sum"), rows=("slot", "count"), last=("slot", "max"))
    assert len(per) == 8 and (per["last"] == per["rows"] - 1).all()
    assert per["size"].max() <= 1.03 * per["size"].mean() and per["size"].min() >= 0.97 * per["size"].mean()


def test_shards_are_even_with_a_third_copies(make_docs, monkeypatch):
    monkeypatch.setattr(SH, "BLOCK", 500)
    rng = np.random.default_rng(8)
    rows = [(i, "the same text over and over" if i % 3 == 0 else prose(rng, int(rng.lognormal(3, 1)) + 1)) for i in range(6000)]
    got = SH.shard_documents(make_docs(rows)).toPandas()
    per = got.groupby("shard").agg(size=("size", "sum"), rows=("slot", "count"))
    assert len(per) == 16
    assert per["size"].max() / per["size"].mean() < 1.03 and per["size"].min() / per["size"].mean() > 0.97
    assert per["rows"].max() / per["rows"].mean() < 1.05
    texts = dict(rows)
    got["text"] = got["doc_id"].map(texts)
    assert (got[got["text"] != "the same text over and over"].groupby("text")["shard"].nunique() == 1).all()


def test_place_prefers_the_largest_dot_product():
    room = np.array([[1.0, 0.2], [0.2, 1.0]])
    assert SH.place(np.array([[0.1, 0.5], [0.5, 0.1], [0.1, 0.1]]), room).tolist() == [1, 0, 0]


# -- packing -----------------------------------------------------------------


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_ids_are_those_of_the_tokenizer_file(odd_docs):
    texts = [r["text"] for r in odd_docs.collect()] + ["a  b  c\x1c\x1d d\r\n\r\n  e", "x" * 3000, "日本語 emoji 🎉🎉", "it's <|endoftext|> here", "  ", "\n"]
    path = PACK.ranks_file()
    assert [PACK.token_ids(t, path).tolist() for t in texts] == reference_ids(texts)


def test_packing_round_trip(odd_docs, with_clashes, no_docs):
    length = 64
    got = PACK.pack(with_clashes(odd_docs), length=length).toPandas()
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    ids = reference_ids([t for _, t in rows])
    wanted = []
    for (i, _), seq in zip(rows, ids):
        seq = np.array(seq, "<u4")
        ends = [e for e in range(len(seq) % length, len(seq) + 1, length) if e]
        for piece, (a, b) in enumerate(zip([0, *ends], ends)):
            wanted.append((i, piece, a, b - a, zlib.crc32(seq[a:b].tobytes())))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    clean = [tuple(None if x != x else int(x) for x in r) for r in got[cols].itertuples(index=False)]
    assert sorted(clean, key=repr) == sorted(wanted, key=repr)
    placed = got.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id")["length"].cumsum() - placed["length"] == placed["offset"]).all()
    assert placed.groupby("sequence_id")["length"].sum().max() <= length
    assert PACK.pack(no_docs).count() == 0


def test_plan_uses_every_length_once_and_packs_tightly():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 20000):
        hist = np.bincount(np.minimum(rng.lognormal(4.5, 1, n).astype(int) + 1, 256), minlength=257)
        planned = PACK.plan(hist, 256)
        used = np.zeros(257, np.int64)
        for sizes, count in planned:
            assert sum(sizes) <= 256
            np.add.at(used, list(sizes), count)
        assert (used == hist).all()
        total = (hist * np.arange(257)).sum()
        if n == 20000:
            assert sum(c for _, c in planned) <= 1.005 * total / 256
    pats = PACK.patterns(12)
    assert (pats.sum(axis=1) == 12).all() and len({tuple(sorted(p)) for p in pats.tolist()}) == len(pats) == 19


def test_fit_is_a_non_negative_least_squares_optimum():
    rng = np.random.default_rng(4)
    pats = PACK.patterns(24)
    hist = np.zeros(25)
    hist[1:] = rng.integers(0, 200, 24)
    x = PACK.fit_counts(pats, hist, rounds=5000)
    a = np.zeros((25, len(pats)))
    for j, p in enumerate(pats):
        np.add.at(a[:, j], p[p > 0], 1)
    slope = a.T @ (a @ x - hist)
    assert (x >= 0).all() and slope.min() > -0.05 and abs(slope[x > 1e-6]).max() < 0.05


# -- pages -------------------------------------------------------------------

P = "The quick brown fox jumps over the lazy dog and runs away from the wolf in the wood. "


@pytest.mark.parametrize(
    "html,text",
    [
        (None, ""),
        ("", ""),
        ("plain &lt;b&gt; text", "plain <b> text"),
        ("<p>one<p>two  \n three", "one two three"),
        ("<p>a<b>b</b>c<br>d</p>", "abc d"),
        (f"<body><nav><a>x</a></nav><article><h1>T</h1><p>{P}</p></article><footer>f</footer>", f"T {P}".strip()),
        (f"<html><head><title>t</title><script>var a='</p>';</script></head><body><div class=ad>buy</div><article><p>{P}</p>", P.strip()),
        (f"<div class='content no-sidebar'><p>{P}</p><p>{P}</p></div><div id='comments'><p>{P}</p></div>", (P + P).strip()),
        (f"<main><p>{P}</p><form><p>name</p></form><aside>{P}</aside><p>x &amp; y&#33;</p></main>", P + "x & y!"),
        (f"<article><!-- <p>no</p> --><p>{P}</p><ul><li><a>one</a><li><a>two</a></ul></article>", P.strip()),
    ],
)
def test_extract(html, text):
    assert extract(html) == text


A = f"<article><h1>T</h1><p>{P}</p><p>{P}</p></article>"
A_TEXT = f"T {P}{P}".strip()


@pytest.mark.parametrize(
    "html,text",
    [
        (f"<div class='overflow-hidden'>{A}</div>", A_TEXT),
        (f"<div aria-hidden='false' title='hidden gems'>{A}</div>", A_TEXT),
        (f"<div class='layout-sidebar-right'>{A}</div>", A_TEXT),
        (f"<form id='aspnetForm'>{A}</form>", A_TEXT),
        (f"<nav><ul><li><a href=/x>x</a></li></ul>{A}", A_TEXT),
        (f"<div class=ad><a href=/x>buy</a>{A}", A_TEXT),
        (f"<div data-id='sidebar' data-role='navigation'>{A}</div>", A_TEXT),
        (f"<div class='layout-sidebar-right'><p>{P}</p><p>{P}</p></div>", (P + P).strip()),
        (f"<article><p>{P}</p><section id='discussion'><p>{P}</p></section><p id='notice'>x</p></article>", (P + P + "x").strip()),
        (f"{A}<div id='comments'><p>{P}</p><p>{P}</p><p>{P}</p><p>{P}</p></div>", A_TEXT),
        (f"{A}<p hidden>{P}</p><p aria-hidden=true>{P}</p><p style='display: none'>{P}</p>", A_TEXT),
        (f"<article><p>{P}</p><div class='share-buttons'><p>share</p></div><p hidden>{P}</p><p>{P}</p></article>", (P + P).strip()),
    ],
)
def test_extract_keeps_what_holds_the_article(html, text):
    assert extract(html) == text


TEASER = "<div class=box><p><a href=/a>One more story</a> today</p><p><a href=/b>Another one of these</a> soon</p></div>"


@pytest.mark.parametrize(
    "html,text",
    [
        # An article in two parts, the second shorter, and teasers in articles of their own.
        (f"{A}<article><p>{P}</p></article><article>{TEASER}</article>", f"{A_TEXT} {P}".strip()),
        (f"<main>{A}<article><p>{P}</p></article></main>", f"{A_TEXT} {P}".strip()),
        # Dense blocks beside the article, teasers beside both.
        (f"{TEASER}{A}<div><p>{P * 3}</p><p>{P * 3}</p></div>{TEASER}", f"{A_TEXT} {P * 6}".strip()),
        ("<article>" + f"<p>{P}</p>" * 30 + f"</article><div><p>{P * 9}</p></div>{TEASER}", (P * 39).strip()),
        # Teasers and notices in a page-wide main, with its own paragraphs or a block of them.
        (f"<main><h1>T</h1><p>{P * 3}</p><p>{P * 3}</p><p>End.</p>{TEASER}<div>We like you</div></main>", f"T {P * 6}End."),
        (f"<main><h1>T</h1><div><p>{P * 3}</p><p>{P * 3}</p></div>{TEASER}<div>We like you</div></main>", f"T {P * 6}".strip()),
        (f"<main><h1>T</h1>{A}<ul><li>{P}</li></ul>{TEASER}</main>", f"T {A_TEXT} {P}".strip()),
        # Sections alike stay, however many.
        ("<main>" + f"<section><h2>S</h2><p>{P}</p></section>" * 200 + "</main>", (f"S {P}" * 200).strip()),
    ],
)
def test_extract_threshold_beside_article_and_in_main(html, text):
    assert extract(html) == text


LINKS = "<ul><li><a href=/1>First reference</a><li><a href=/2>Second reference</a></ul>"
TERMS = "".join(f"<p><a href=/t{i}>term{i}</a> <a href=/u{i}>other{i}</a></p>" for i in range(9))
TERMS_TEXT = " ".join(f"term{i} other{i}" for i in range(9))


@pytest.mark.parametrize(
    "html,text",
    [
        (f"<article><p>{P}</p>{LINKS}</article>", f"{P}First reference Second reference"),
        (f"<article><p>{P}</p><table><tr><td><a href=/1>a</a><td><a href=/2>b</a></table></article>", f"{P}a b"),
        (f"<article><p>{P}</p><p><a href=/1>one</a>, <a href=/2>two</a></p></article>", f"{P}one, two"),
        (f"<article><h1>Terms</h1><div>{TERMS}</div></article>", f"Terms {TERMS_TEXT}"),
        (f"<article><header><h1>T</h1></header><p>{P}</p><ul><li><a name=n>n</a><li><a id=i>i</a></ul></article>", f"T {P}n i"),
        (f"<div class=post><p>{P}</p><p>{P}</p>{LINKS}</div>", f"{P}{P}First reference Second reference"),
        # Beside the article and in navigation they aren't its text.
        (f"{LINKS}<article><p>{P}</p><nav>{LINKS}</nav><p>{P}</p></article>", (P + P).strip()),
        (f"<body>{LINKS}<p>{P}</p><p>{P}</p>{LINKS}</body>", (P + P).strip()),
    ],
)
def test_extract_keeps_links_of_the_article(html, text):
    assert extract(html) == text


DENSE = f"<h1>T</h1><p><b>{P * 4}<br>{P}</b></p><p>End.</p>"
QUOTED = " ".join(f'a{i}="x>y"' for i in range(450))


@pytest.mark.parametrize(
    "html,text",
    [
        # Density alone: no article tag, bold text and line breaks in the densest paragraph.
        (f"<nav><a href=/x>x</a></nav><div>{DENSE}</div><footer>All rights</footer>", f"T {P * 5}End."),
        # A footer longer than a page's short text isn't the text.
        (f"<div><h1>T</h1><p>Short.</p></div><footer>{P}</footer>", "T Short."),
        # The article around the densest part keeps its headings and paragraphs.
        (f"<article><header><h1>T</h1></header><div class=body><p>{P}</p><p>{P}</p></div><p>x</p></article>", f"T {P * 2}x"),
        # Prose under a name that may be a control's, controls and readers' comments.
        (f"<article><p>{P}</p><section class=social><p>{P * 2}</p></section><div class=share>Share</div></article>", (P * 3).strip()),
        (f"<article><p>{P}</p><p class=promotion>{P * 2}</p><ol class=comment-list><li>{P}</li></ol></article>", (P * 3).strip()),
        (f"<article><p>{P}</p><div class=advert><p>{P * 2}</p></div><p>{P}</p></article>", (P * 2).strip()),
        # Empty comments, and attributes of any number and length.
        (f"<p>{P}</p><!--><p>{P}</p><!---><p>{P}</p><!-- no --!><p>{P}</p>", (P * 4).strip()),
        (f"<p data-x='{'x>y ' * 8000}'>{P}</p>", P.strip()),
        (f"<p {QUOTED}>{P}</p><p>{P}</p>", (P * 2).strip()),
        # A quote that doesn't close: the tag ends at the first >.
        (f"<p title=\"a>{P}</p><p class='x>y'>{P}</p>", (P * 2).strip()),
    ],
)
def test_extract_by_density(html, text):
    assert extract(html) == text


def trees():
    rng = np.random.default_rng(8)
    for _ in range(300):
        blocks = []
        for _ in range(int(rng.integers(1, 6))):
            words = "word " * int(rng.integers(1, 60))
            link = "<a href=/l>" + "link " * int(rng.integers(1, 30)) + "</a>" if rng.random() < 0.4 else ""
            blocks.append(f"<p>{words}{link}</p>")
        cut = int(rng.integers(0, len(blocks) + 1))
        yield f"<div><section>{''.join(blocks[:cut])}</section><section>{''.join(blocks[cut:])}</section></div>"


def density_by_hand(el, share):
    """Of an ElementTree element: characters a tag, less the more of them are linked."""
    count = lambda e: sum(len("".join(t.split())) for t in e.itertext())
    chars, tags = count(el), max(sum(1 for _ in el.iter()) - 1, 1)
    links = list(el.iter("a"))
    linked, n_links = max(sum(map(count, links)), 1), max(len([x for x in links if x is not el]), 1)
    linked_raw = sum(map(count, links))
    base = math.log(chars / max(chars - linked_raw, 1) * linked_raw + share * chars + math.e)
    weight = math.log(chars / linked * tags / n_links) if chars * tags > linked * n_links else 0.0
    return chars / tags * (weight / math.log(base) if base > math.e else weight)


def test_density_sums_by_hand():
    import xml.etree.ElementTree as ET

    from voxpop.llm.html_extract import _measure, parse

    for html in trees():
        root = ET.fromstring(f"<html>{html}</html>")
        chars = sum(len("".join(t.split())) for t in root.itertext())
        linked = sum(len("".join(t.split())) for a in root.iter("a") for t in a.itertext())
        share = linked / max(chars, 1)
        wanted = {}
        for el in root.iter():
            if el.tag != "a":
                wanted.setdefault(el.tag, []).append((density_by_hand(el, share), sum(density_by_hand(k, share) for k in el if k.tag != "a")))
        got = {}
        for node in _measure(parse(html)):
            if node.tag != "a":
                got.setdefault(node.tag, []).append((node.density, node.total))
        assert wanted.keys() == got.keys()
        for tag, pairs in wanted.items():
            assert np.allclose(sorted(pairs), sorted(got[tag])), html


def test_broken_quotes_are_read_once():
    import time

    def seconds(n):
        start = time.process_time()
        extract("<br \">\"" * n + "'")
        return time.process_time() - start

    seconds(1000)
    assert seconds(80000) < 40 * max(seconds(8000), 0.01)


def test_extract_deep_and_broken_pages():
    assert extract("<div>" * 20000 + "deep") == "deep"
    for junk in ("<" * 5000, "<a " * 5000, "<a b='" * 5000, "</p>" * 5000, "<!--" * 5000, "&" * 5000):
        extract(junk)


def test_extract_pages_columns(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "u", "<p>t</p>", "y")], "page_id long, url string, html string, main_text string")
    assert sorted(map(tuple, extract_pages(pages).collect())) == [(1, None, ""), (2, "u", "t")]
    assert extract_pages(pages.limit(0)).count() == 0


# -- classifiers -------------------------------------------------------------


def test_quality_score_is_the_softmax_of_the_average():
    rng = np.random.default_rng(1)
    model = Q.SubwordModel(rng.normal(size=Q.BUCKETS).astype(np.float32))
    texts = ["", None, "one two two two three", prose(rng, 500), "x" * 4000, "a\nb\t c"]
    for text, got in zip(texts, model.scorer()(texts)):
        ids, parts = Q.document_weights(text)
        assert parts.sum() == pytest.approx(1)
        assert got == pytest.approx(1 / (1 + np.exp(-(model.numbers[ids] @ parts))), rel=1e-5)


def test_quality_learns_and_handles_odd_rows(spark, odd_docs, with_clashes, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = Q.fit_quality(docs, labels)
    scored = Q.score_texts(docs, model).join(labels, "doc_id")
    held = scored.where(Q.id_remainder(F.col("doc_id"), 4) == 2).select("score", "quality").toPandas()
    assert ((held["score"] >= Q.THRESHOLD) == (held["quality"] == 1)).mean() > 0.9
    rows = Q.score_texts(with_clashes(odd_docs), model).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert Q.score_texts(no_docs, model).count() == 0
    assert not Q.fit_quality(docs, labels.limit(0)).learned
    assert not Q.fit_quality(no_docs, labels).learned


def test_language_learns_and_handles_odd_rows(spark, odd_docs, with_clashes, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = LANG.fit_language(docs)
    assert (model.weights == 0).mean() > 0.3  # the L1 penalty leaves most out
    got = LANG.identify(docs, model).where(LANG.id_remainder(F.col("doc_id"), 5) == 0).select("lang", "predicted.lang")
    pairs = [tuple(r) for r in got.collect()]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.9
    rows = {r["doc_id"]: r["predicted"] for r in LANG.identify(with_clashes(odd_docs), model).collect()}
    assert rows[3]["lang"] == rows[4]["lang"] == rows[5]["lang"] == rows[8]["lang"] == "und"
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    nothing = LANG.fit_language(no_docs)
    assert LANG.identify(no_docs, nothing).count() == 0
    assert {r["predicted"]["lang"] for r in LANG.identify(odd_docs, nothing).collect()} == {"und"}


def test_sample_leaves_out_only_what_does_not_fit(make_docs):
    docs = make_docs([(i, "x" * (2000 if i % 3 == 0 else 10)) for i in range(30)])
    labelled = docs.select("doc_id", (F.col("doc_id") % 2).alias("label"))
    got = labelled_sample(labelled, docs, 30, 1000)
    assert sorted(got["doc_id"]) == [i for i in range(30) if i % 3]
    assert len(labelled_sample(labelled, docs, 30, 10**6)) == 30
    with pytest.raises(ValueError, match="no labelled document"):
        labelled_sample(labelled, docs, 30, 5)


def test_sample_has_rows_of_each_label(make_docs):
    docs = make_docs([(i, f"text {i}") for i in range(2000)])
    labelled = docs.select("doc_id", F.when(F.col("doc_id") < 1990, "common").otherwise("rare").alias("label"))
    got = labelled_sample(labelled, docs, 100, 10**6)
    assert got["label"].value_counts().to_dict() == {"common": 90, "rare": 10}
    assert labelled_sample(labelled, docs.limit(0), 100, 10**6).empty


def test_document_frequencies_count_every_text(make_docs):
    texts = ["abc", "abd", None, "", "é" * 5]
    total, having = LANG.document_frequencies(make_docs(list(enumerate(texts))).fillna("", ["text"]))
    wanted = np.zeros(LANG.FEATURES, np.int64)
    for t in texts:
        wanted[LANG.gram_counts(t or "")[0]] += 1
    assert total == 5 and (having == wanted).all()


def test_sample_of_repeated_ids_keeps_each_text_with_its_label(make_docs):
    docs = make_docs([(i, f"{lang} text {i}", lang, "s") for i in range(300) for lang in ("en", "fr")] + [(7, "en text 7", "en", "s")] * 300)
    labelled = docs.select("doc_id", F.xxhash64("text").alias("key"), F.col("lang").alias("label"))
    got = labelled_sample(labelled, docs, 400, 10**6)
    assert len(got) == 400 and not got.duplicated().any()
    assert all(t.startswith(label) for label, t in zip(got["label"], got["text"]))
    assert got["label"].nunique() == 2
    # Without the key a label goes to each text of its id.
    both = labelled_sample(labelled.drop("key"), docs, 4000, 10**6)
    assert len(both) == 1200


def test_sample_ranks_a_label_of_many_tasks(make_docs, monkeypatch):
    monkeypatch.setattr(SAMPLES, "TASKS_TOGETHER", 2)
    docs = make_docs([(i, f"text {i}") for i in range(900)])
    labelled = docs.select("doc_id", F.when(F.col("doc_id") % 300 == 0, "rare").otherwise("common").alias("label"))
    wanted = labelled_sample(labelled, docs, 60, 10**6)
    assert wanted["label"].value_counts().to_dict() == {"common": 57, "rare": 3}
    assert labelled_sample(labelled.repartition(13), docs, 60, 10**6).equals(wanted)


def test_sample_decides_on_lengths_before_texts(make_docs):
    rows = 3000
    docs = make_docs([(i, "w " * 40_000 if i % 30 else "w " * 50) for i in range(rows)])
    got = labelled_sample(docs.select("doc_id", F.lit(1).alias("label")), docs, rows, 1_000_000)
    lengths = got["text"].str.len()
    assert lengths.sum() <= 1_000_000 and (lengths == 100).sum() == 100 and (lengths == 80_000).sum() == 12


def test_packing_numbers_equal_rows_without_id(make_docs):
    docs = make_docs([(None, "the same words in every row")] * 700 + [(i, "w " * (i % 90)) for i in range(700)])
    rows = PACK.pack(docs).toPandas()
    assert len(rows) == 1400
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert (own["offset"] == own["length"].cumsum() - own["length"]).all() and own["length"].sum() <= PACK.SEQUENCE


def test_sample_sorts_few_rows_whatever_the_table(make_docs):
    docs = make_docs([(i, "t") for i in range(3000)])
    known = docs.select("doc_id", F.lit(1).alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    got = SAMPLES._first_by_hash(known, order[0], order, 200)
    assert got.collect() == known.orderBy(*order).limit(200).collect()
    # One hash for all: the bound can't tell them apart and is widened.
    same = [F.xxhash64(F.lit(2)), F.col("doc_id")]
    assert [r[0] for r in SAMPLES._first_by_hash(known, same[0], same, 200).collect()] == list(range(200))
    assert SAMPLES._first_by_hash(known.limit(0), order[0], order, 200).count() == 0

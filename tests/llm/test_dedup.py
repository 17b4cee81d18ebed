"""Exact, line and near dedup against plain Python."""

import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from voxpop.llm.exact_dedup import DigestIndex, exact_dedup, text_digest
from voxpop.llm.line_dedup import LineRuns, dedup_lines
from voxpop.llm.sorted_runs import file_order
from voxpop.llm.simhash import GrayIndex, block_count, block_masks, components, near_dedup, near_links, one_of_each_group, simhash, smallest_reachable


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_exact_dedup_by_hand(odd_docs, with_clashes, no_docs):
    texts = [(r["doc_id"], ascii_lower(r["text"])) for r in odd_docs.collect()]
    expected, seen = [], set()
    for i, t in texts:
        ids = [j for j, u in texts if u == t]
        keep = max((j for j in ids if j is not None), default=None)
        kept = i == keep and (i, t) not in seen
        seen.add((i, t))
        expected.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(exact_dedup(with_clashes(odd_docs)), *cols) == sorted(expected, key=repr)
    assert exact_dedup(no_docs).count() == 0


def test_digest_index_keeps_what_came_first(spark):
    index = DigestIndex(spark, buckets=4)
    batch = lambda rows: spark.createDataFrame(rows, "id long, text string").select("id", text_digest("text").alias("digest"))
    index.add(batch([(9, "a"), (8, "a"), (7, "b")]))
    index.add(batch([(5, "a"), (4, "c"), (3, "c")]))
    assert rows_of(index.read(), "keep_id") == [(4,), (7,), (9,)]


def lines_by_hand(rows, min_chars=10):
    last = 2**63
    key = lambda x: ascii_lower(x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(last if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if min(held.get(key(x), {last if i is None else i})) == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def test_line_dedup_by_hand(odd_docs, with_clashes, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for batches, fanout in ((1, 3), (4, 2), (6, 3)):
        got = dedup_lines(with_clashes(odd_docs), batches=batches, fanout=fanout)
        assert rows_of(got, "doc_id", "__n_lines", "__n_dropped", "__kept") == lines_by_hand(rows)
        assert set(with_clashes(odd_docs).columns) < set(got.columns)
    assert dedup_lines(no_docs).count() == 0


def test_full_levels_of_runs_are_merged(spark):
    runs = LineRuns(spark, fanout=2, buckets=2)
    for start in range(5):
        runs.add(spark.range(start, start + 3).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.lit(start).cast("long").alias("owner")))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert rows_of(runs.owners(), "h1", "owner") == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 2), (5, 3), (6, 4)]


def simhash_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def components_by_hand(fps, max_bits):
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps[i + 1 :]) <= max_bits) + i + 1:
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_simhash_by_hand(odd_docs):
    for r in odd_docs.collect():
        assert simhash(r["text"]) == simhash_by_hand(r["text"])


def crowd(seed, n, spread):
    """Clusters of close fingerprints, chains among them, and random ones."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    near = centres[rng.integers(0, 6, n)]
    for _ in range(spread):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(np.concatenate([near, rng.integers(0, 2**63, n, dtype=np.uint64)]))


def gray(x):
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def test_gray_index_finds_all_pairs():
    for spread in (2, 4):
        codes = crowd(spread, 1500, spread)
        codes = codes[np.argsort(gray(codes), kind="stable")]
        for group in (np.zeros(len(codes), np.int64), np.arange(len(codes)) // 700, np.sort(np.arange(len(codes)) % 997)):
            found = set()
            for a, b in GrayIndex(group, codes).pairs(4):
                assert (a < b).all()
                found.update(zip(a.tolist(), b.tolist()))
            near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4
            wanted = {(i, j) for i, j in np.argwhere(near).tolist() if i < j and group[i] == group[j]}
            assert found == wanted


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    import voxpop.llm.simhash as S

    codes = crowd(7, 600, 3)
    monkeypatch.setattr(S, "TILE", 64)  # so that clusters are searched in parts
    nodes = spark.createDataFrame([(int(x),) for x in codes.astype(np.int64)], "fp long")
    roots = {r["fp"]: r["root"] for r in components(near_links(nodes, 4)).collect()}
    groups = {}
    for code, i in zip(codes.astype(np.int64).tolist(), components_by_hand(codes, 4)):
        groups.setdefault(i, set()).add(code)
    for members in groups.values():
        assert {roots.get(m, m) for m in members} == {min(members)}


def test_more_blocks_find_the_same_components(spark):
    codes = crowd(11, 300, 3)
    nodes = spark.createDataFrame([(int(x),) for x in codes.astype(np.int64)], "fp long")
    groups = {}
    for code, i in zip(codes.astype(np.int64).tolist(), components_by_hand(codes, 4)):
        groups.setdefault(i, set()).add(code)
    for blocks in (7, 8):
        near = [(r["x"], r["y"]) for r in near_links(nodes, 4, blocks).collect()]
        joined = {m: {m} for g in groups.values() for m in g}
        for x, y in near:
            assert bin((x ^ y) & (2**64 - 1)).count("1") <= 4 or any({x, y} <= g for g in groups.values())
            if joined[x] is not joined[y]:
                joined[x] |= joined[y]
                for m in joined[y]:
                    joined[m] = joined[x]
        assert all(joined[m] == g for g in groups.values() for m in g)


def test_blocks_grow_with_the_table():
    assert [block_count(n, 4) for n in (0, 10**6, 2**30, 2**30 + 1, 5 * 10**10, 10**12)] == [6, 6, 6, 7, 7, 8]
    for blocks, masks in ((6, 15), (7, 35), (8, 70)):
        found = block_masks(4, blocks)
        assert len(found) == masks and min(m.bit_count() for m in found) >= 64 * (blocks - 4) // blocks - 1
        # Any four flipped bits leave one choice of blocks untouched.
        for seed in range(200):
            flips = sum(1 << int(b) for b in np.random.default_rng(seed).choice(64, 4, replace=False))
            assert any(not m & flips for m in found)


def test_smallest_reachable_follows_chains():
    a, b = np.array([4, 3, 2, 9]), np.array([5, 4, 3, 8])
    assert smallest_reachable(10, iter([(a, b)])).tolist() == [0, 1, 2, 2, 2, 2, 6, 7, 8, 8]


def test_near_dedup_by_hand(odd_docs, with_clashes, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    fps = np.array([simhash_by_hand(t) for _, t in rows], np.uint64)
    group = components_by_hand(fps, 4)
    least = {g: min((i for (i, _), h in zip(rows, group) if h == g and i is not None), default=None) for g in group}
    expected = sorted(((i, int(f), least[g]) for (i, _), f, g in zip(rows, fps.astype(np.int64), group)), key=repr)
    assert rows_of(near_dedup(with_clashes(odd_docs)), "doc_id", "fp", "component_id") == expected
    assert near_dedup(no_docs).count() == 0
    kept = one_of_each_group(odd_docs).collect()
    assert len(kept) == len(set(group))
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted({x for x in least.values() if x is not None})


def test_one_of_each_group_with_repeated_and_null_ids(make_docs):
    words = lambda p: " ".join(f"{p}{i}" for i in range(400))
    near = words("n")
    docs = make_docs([(1, words("a")), (1, words("b")), (None, near), (None, near + " tail"), (None, words("c")), (5, words("d")), (5, words("d"))])
    kept = sorted((r["doc_id"] or 0, r["text"][0]) for r in one_of_each_group(docs).collect())
    assert kept == [(0, "c"), (0, "n"), (1, "a"), (1, "b"), (5, "d")]


def run_plan(df):
    """The physical plan without the plan of what is written elsewhere."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_are_read_in_their_order(spark):
    keyed = lambda a, b: spark.range(a, b).select(F.xxhash64("id").alias("h1"), F.col("id").alias("h2"), F.lit(a).cast("long").alias("owner"))
    runs = LineRuns(spark, fanout=4, buckets=4)
    for start in (0, 500):
        runs.add(keyed(start, start + 1000))
    with file_order(spark):
        unseen = run_plan(runs.unseen(keyed(1000, 3000)))
        merged = run_plan(runs.merged(runs.live()))
    # Only the batch is shuffled and sorted; runs are merged without a shuffle.
    assert (unseen.count("SortMergeJoin"), unseen.count("Exchange"), unseen.count("Sort [")) == (2, 1, 1)
    assert merged.count("Bucketed: true") == 2 and "Exchange" not in merged
    runs.close()


def test_line_runs_reopen(spark, make_docs):
    first = make_docs([(5, "a line of many words\nonly in the first"), (6, "a line of many words")])
    later = make_docs([(1, "A line of many words\nsomething new here"), (2, "something new here\nshort"), (None, None)])
    runs = LineRuns(spark, fanout=2, buckets=2)
    dedup_lines(first, runs=runs, batches=2).count()
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name in runs.live()]
    again = LineRuns(spark, fanout=2, path=runs.path)
    assert (again.levels, again.buckets) == (runs.levels, 2)
    for _ in range(2):  # run again as after a failure
        got = rows_of(dedup_lines(later, runs=again), "doc_id", "__n_dropped", "__kept")
        assert got == [(1, 1, "something new here"), (2, 1, "short"), (None, 0, "")]
    assert again.owners().count() == 3
    assert dedup_lines(later.limit(0), runs=again).count() == 0


def test_digest_index_reopens(spark, make_docs):
    first = make_docs([(5, "one"), (6, "ONE"), (7, "two"), (None, "none")])
    later = make_docs([(9, "One"), (8, "three"), (10, "three"), (10, "three"), (11, None)])
    index = DigestIndex(spark, buckets=2)
    assert [r[0] for r in rows_of(exact_dedup(first, index=index).where("kept"), "doc_id")] == [6, 7, None]
    index.close()
    again = DigestIndex(spark, path=index.path)
    for _ in range(2):
        got = rows_of(exact_dedup(later, index=again), "doc_id", "keep_id", "group_size", "kept")
        assert got == sorted(
            [(9, 6, 1, False), (8, 10, 3, False), (10, 10, 3, True), (10, 10, 3, False), (11, 11, 1, True)], key=repr
        )
    assert again.read().count() == 5
    again.close()


def test_half_written_runs_are_not_read(spark):
    runs = LineRuns(spark, fanout=3, buckets=2)
    lines = lambda a, b: spark.range(a, b).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.lit(a).cast("long").alias("owner"))
    runs.add(lines(0, 3))
    runs._write(lines(100, 103))  # a job lost before the manifest names its run
    again = LineRuns(spark, fanout=3, path=runs.path)
    again.add(lines(2, 5))
    assert rows_of(again.owners(), "h1", "owner") == [(0, 0), (1, 0), (2, 0), (3, 2), (4, 2)]

"""M3-M6 on a 0/1 matrix kept as a table: regularised logistic regressions by L-BFGS,
many at once, whose weights never come to the driver.

The fits take the steps of Spark ML's ``LogisticRegression``: features scaled to standard
deviation 1 and centred, L-BFGS with ten corrections and a strong Wolfe line search. From
zero weights every vector of such a fit is the matrix's transpose times some numbers a
row, plus an intercept; these are sums of the errors (probability minus label) at the
points evaluated. So the driver only holds, a fit, a few coefficients of those errors
and their products, and the tables hold the errors and the scaled matrix times its
transpose times them (``images``), in chunks of rows. One evaluation serves all fits: the
columns are dealt into groups of bounded size, the fits into parts, and one task does both
products of a part for a group; sums for the matrix's rows alone are shuffled. Sums are
taken in a fixed order, so reruns agree to the bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxpop.session import drop_table, materialize, release_shuffles

#: Entries of columns that are packed together, about, and at least where there are fewer
#: such groups than ``TASKS``.
GROUP, SMALL, TASKS = 4_000_000, 1_000_000, 12
#: Groups a task, where there are more than ``TASKS``: each task is sent the errors of all
#: rows, so fewer tasks shuffle less.
TOGETHER = 4
#: Entries of a group that are added up at a time.
SLICE = 1 << 20
#: Bytes of errors that a task is sent, about; more fits are dealt to several tasks.
SENT = 32 << 20
#: Matrix rows a chunk.
CHUNK = 4096
#: Evaluations after which the shuffle files of earlier ones go.
RELEASE = 2
#: Spark ML's tolerance and number of corrections.
TOLERANCE, CORRECTIONS = 1e-6, 10


class SearchFailed(Exception):
    """No step could be found; the history is dropped once, then the fit ends."""


@dataclass(frozen=True)
class Point:
    """A vector of a fit: coefficients of the errors so far, and the intercept's part."""

    a: np.ndarray
    b: float

    def plus(self, other: Point, times: float = 1.0) -> Point:
        a = np.zeros(max(len(self.a), len(other.a)))
        a[: len(self.a)] += self.a
        a[: len(other.a)] += times * other.a
        return Point(a, self.b + times * other.b)

    def scaled(self, times: float) -> Point:
        return Point(times * self.a, times * self.b)


@dataclass
class Fit:
    """One regression: its label's column, the fold that it leaves out (None: none), and
    what its steps came to."""

    label: str
    left_out: int | None
    reg: float
    n: int = 0
    ones: int = 0
    products: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    history: list[float] = field(default_factory=list)
    end: Point = field(default_factory=lambda: Point(np.zeros(0), 0.0))

    def dot(self, u: Point, v: Point) -> float:
        return float(u.a @ self.products[: len(u.a), : len(v.a)] @ v.a + u.b * v.b)

    def objective(self, x: Point, sums: tuple[int, float, float]) -> tuple[float, Point]:
        at, loss, error = sums
        mine = np.zeros(at + 1)
        mine[at] = 1.0 / self.n
        grad = Point(mine, error / self.n).plus(Point(x.a, 0.0), self.reg)
        return loss / self.n + 0.5 * self.reg * self.dot(Point(x.a, 0.0), Point(x.a, 0.0)), grad

    def steps(self, max_iter: int) -> Iterator[Point]:
        """L-BFGS: yields each point to evaluate and is sent (number of its errors, sum of
        losses, sum of errors)."""
        x = Point(np.zeros(0), float(np.log(self.ones / (self.n - self.ones))))
        value, grad = self.objective(x, (yield x))
        self.history, pairs, number, failed = [value], [], 0, False
        while number < max_iter:
            if np.sqrt(max(self.dot(grad, grad), 0.0)) <= max(TOLERANCE * value, 1e-8):
                break
            try:
                way = self.direction(grad, pairs)
                first = 1.0 / np.sqrt(self.dot(way, way)) if number == 0 else 1.0
                step, new = yield from self.search(x, value, grad, way, first)
                if step * np.sqrt(max(self.dot(grad, grad), 0.0)) < 1e-10:
                    raise SearchFailed("step size")
            except SearchFailed:
                if failed:
                    break
                failed, pairs = True, []
                continue
            moved, (new_value, new_grad) = x.plus(way, step), new
            pairs = [(moved.plus(x, -1.0), new_grad.plus(grad, -1.0)), *pairs][:CORRECTIONS]
            x, value, grad, number, failed = moved, new_value, new_grad, number + 1, False
            self.history.append(value)
        self.end = x

    def direction(self, grad: Point, pairs: list[tuple[Point, Point]]) -> Point:
        way, kept = grad, []
        for s, y in pairs:
            rho = self.dot(s, y)
            alpha = self.dot(s, way) / rho if rho else np.nan
            if np.isnan(alpha):
                raise SearchFailed("history")
            way = way.plus(y, -alpha)
            kept.append((alpha, rho))
        if pairs:
            s, y = pairs[0]
            sy = self.dot(s, y)
            if not sy >= 0:
                raise SearchFailed("history")
            way = way.scaled(sy / self.dot(y, y))
        for (s, y), (alpha, rho) in zip(reversed(pairs), reversed(kept)):
            way = way.plus(s, alpha - self.dot(y, way) / rho)
        return way.scaled(-1.0)

    def search(self, x: Point, value: float, grad: Point, way: Point, t: float):
        """The strong Wolfe line search of N&W 3.5 and 3.6: (step, objective there)."""
        slope0 = self.dot(grad, way)
        if slope0 > 0:
            raise SearchFailed("direction")

        def at(t: float):
            p = x.plus(way, t)
            found = self.objective(p, (yield p))
            return t, found[0], self.dot(found[1], way), found

        def between(left, right) -> float:
            if left[0] > right[0]:
                left, right = right, left
            d1 = left[2] + right[2] - 3 * (left[1] - right[1]) / (left[0] - right[0])
            d2 = np.sqrt(d1 * d1 - left[2] * right[2])
            wide = right[0] - left[0]
            t = right[0] - wide * (right[2] + d2 - d1) / (right[2] - left[2] + 2 * d2)
            if t < left[0] + 0.1 * wide:
                return left[0] + 0.1 * wide
            return left[0] + 0.9 * wide if t > left[0] + 0.9 * wide else t

        def zoom(low, high):
            for _ in range(10):
                c = yield from at(between(low, high))
                if c[1] > value + 1e-4 * c[0] * slope0 or c[1] >= low[1]:
                    high = c
                else:
                    if abs(c[2]) <= 0.9 * abs(slope0):
                        return c[0], c[3]
                    if c[2] * (high[0] - low[0]) >= 0:
                        high = low
                    low = c
            raise SearchFailed("zoom")

        low = (0.0, value, slope0, None)
        for i in range(10):
            c = yield from at(t)
            if not np.isfinite(c[1]):
                t /= 2
                continue
            if c[1] > value + 1e-4 * t * slope0 or (c[1] >= low[1] and i > 0):
                return (yield from zoom(low, c))
            if abs(c[2]) <= 0.9 * abs(slope0):
                return c[0], c[3]
            if c[2] >= 0:
                return (yield from zoom(c, low))
            low, t = c, t * 1.5
        raise SearchFailed("line search")

    def known(self) -> bool:
        """Both labels occur; of one label alone the probability is certain."""
        return 0 < self.ones < self.n


def matrix(rows: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables of a 0/1 matrix: ``rows`` (pos from 0 without gaps, labels, fold) as
    chunks, and ``entries`` (pos, idx) as groups of columns, each one packed row."""
    columns = [f.name for f in rows.schema.fields if f.name != "pos"]

    def chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        packed = pdf[columns].to_numpy(dtype=np.int32)
        return pd.DataFrame({"chunk": [int(pdf["pos"].iloc[0]) // CHUNK], "known": [packed.tobytes()]})

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        number, idx, pos = int(pdf["group"].iloc[0]), pdf["idx"].to_numpy(), pdf["pos"].to_numpy()
        order = np.lexsort((pos, idx))
        idx, pos = idx[order], pos[order].astype(np.int32)
        first = np.flatnonzero(np.r_[True, idx[1:] != idx[:-1]])
        return pd.DataFrame({"group": [number], "idx": [idx[first].astype(np.int32).tobytes()], "first": [first.astype(np.int64).tobytes()], "at": [pos.tobytes()]})

    chunks = rows.withColumn("_chunk", F.floor(F.col("pos") / CHUNK)).groupBy("_chunk").applyInPandas(chunk, "chunk long, known binary")
    n = entries.count()
    groups = max(1, -(-n // GROUP), min(TASKS, n // SMALL))
    dealt = entries.select(F.pmod(F.xxhash64("idx"), F.lit(groups)).cast("int").alias("group"), "pos", "idx")
    cells = dealt.groupBy("group").applyInPandas(group, "group int, idx binary, first binary, at binary")
    return materialize(chunks, "fit-chunks"), materialize(cells, "fit-cells")


def _taking_part(known: np.ndarray, fits: list[Fit]) -> np.ndarray:
    """(rows, fits): whether a fit trains on a row; the fold is the last column."""
    return np.stack([known[:, -1] != (-1 if f.left_out is None else f.left_out) for f in fits], axis=1)


def _columns(cell: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns' numbers, their first entries, entries' rows) of a packed group."""
    return np.frombuffer(cell["idx"], np.int32), np.frombuffer(cell["first"], np.int64), np.frombuffer(cell["at"], np.int32)


def _slices(first: np.ndarray, at: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(columns, their first entries, numbers of entries, entries' rows) of a group piece by
    piece; a piece is at least one column."""
    ends, low = np.r_[first[1:], len(at)], 0
    while low < len(first):
        high = max(low + 1, int(np.searchsorted(ends, first[low] + SLICE, "right")))
        yield slice(low, high), first[low:high] - first[low], ends[low:high] - first[low:high], at[first[low] : ends[high - 1]].astype(np.int64)
        low = high


def _spread(held: np.ndarray, n: float) -> tuple[np.ndarray, np.ndarray]:
    """(mean, 1 / standard deviation or 0) of columns that so many of a fit's ``n`` rows hold."""
    held = held.astype(np.float64)
    deviation = np.sqrt(held * (n - held) / (n * max(n - 1, 1.0)))
    return held / n, np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)


def _by_group(cells: DataFrame, tasks: int, vectors: DataFrame, each, schema: str) -> DataFrame:
    """``each(cells, vectors)`` for the groups of columns of every task and part of the fits,
    with all rows' numbers of that part: ``vectors`` has (chunk, part, ...)."""

    def task(cell: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(cell) or not len(q):
            return pd.DataFrame({name.split()[0]: [] for name in schema.split(", ")})
        return each(cell.sort_values("group"), q.sort_values("chunk"))

    sent = vectors.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    return cells.groupBy("task", "part").cogroup(sent.groupBy("task", "part")).applyInPandas(task, schema)


def _with_held(cells: DataFrame, groups: int, chunks: DataFrame, left_out: list[int | None], wide: int) -> DataFrame:
    """Groups of columns with ``held``: how many rows hold a column, without each fold of
    ``left_out``."""

    def each(cell: pd.Series, q: pd.DataFrame) -> pd.DataFrame:
        fold = np.concatenate([np.frombuffer(b, np.int32).reshape(-1, wide)[:, -1] for b in q["known"]])
        _, first, at = _columns(cell)
        held = np.empty((len(left_out), len(first)), np.int32)
        for own, starts, _, rows in _slices(first, at):
            folds = fold[rows]
            for k, f in enumerate(left_out):
                held[k, own] = np.add.reduceat(folds != (-1 if f is None else f), starts, dtype=np.int32)
        return pd.DataFrame({c: [cell[c]] for c in ("group", "idx", "first", "at")} | {"held": [held.tobytes()]})

    one = lambda df: df.withColumn("part", F.lit(0))
    return _by_group(one(cells).withColumn("task", F.col("group")), groups, one(chunks), lambda cell, q: pd.concat([each(c, q) for _, c in cell.iterrows()]), "group int, idx binary, first binary, at binary, held binary")


@dataclass
class Fitted:
    """``fits`` and their tables: (idx, weights: an array with a number a fit), and
    (pos, margins) of every training row, of those left out too."""

    fits: list[Fit]
    weights: DataFrame
    intercepts: list[float]
    margins: DataFrame


def fit_all(rows: DataFrame, entries: DataFrame, fits: list[Fit], max_iter: int) -> Fitted:
    """All ``fits`` on ``rows`` (pos, labels as 0/1, fold) and ``entries`` (pos, idx)."""
    labels = [f.name for f in rows.schema.fields if f.name not in ("pos", "fold")]
    rows = rows.select("pos", *labels, "fold")
    by_fold = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in labels]).collect()  # a row a fold
    for f in fits:
        mine = [r for r in by_fold if r["fold"] != f.left_out]
        f.n, f.ones = sum(r["n"] for r in mine), int(sum(r[f.label] for r in mine))
        if not f.n:
            raise ValueError(f"no rows to fit {f.label} on without fold {f.left_out}")
    chunks, cells = matrix(rows, entries)
    # Groups come of a hash, so one may be empty; it gets no numbers back.
    groups = cells.agg(F.max("group")).first()[0] + 1
    width, label_at = len(fits), [labels.index(f.label) for f in fits]
    wide = len(labels) + 1
    left_out = list(dict.fromkeys(f.left_out for f in fits))
    apart = [left_out.index(f.left_out) for f in fits]
    packed = materialize(_with_held(cells, groups, chunks, left_out, wide), "fit-held")
    drop_table(cells)
    # Fits a task: as many as what it is sent allows, one at least.
    most = max(1, SENT // (8 * max(1, sum(r["n"] for r in by_fold))))
    parts_of = [list(range(at, min(at + most, width))) for at in range(0, width, most)]
    # Dealt once: the numbers of each evaluation come to where a group lies.
    parted = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = max(1, min(TOGETHER, groups // TASKS))
    tasks = -(-groups // together)
    cells = packed.withColumn("task", F.floor(F.col("group") / together).cast("int"))
    cells = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(len(parts_of) - 1)))).repartition(parted, "task", "part").persist()

    def split(blob: np.ndarray) -> list[bytes]:
        """(rows, fits) as a (fits, rows) piece a part."""
        return [np.ascontiguousarray(blob[:, own].T).tobytes() for own in parts_of]

    def by_part(df: DataFrame) -> DataFrame:
        return df.select("chunk", F.posexplode("by_part").alias("part", "error"))

    def joined(q: pd.DataFrame, count: int) -> tuple[np.ndarray, np.ndarray]:
        """All rows' numbers, (fits, rows), and the ends of their chunks."""
        pieces = [np.frombuffer(b).reshape(count, -1) for b in q["error"]]
        return np.concatenate(pieces, axis=1), np.cumsum([p.shape[1] for p in pieces])

    def held_by(cell: pd.Series, i: int) -> tuple[np.ndarray, np.ndarray]:
        return _spread(np.frombuffer(cell["held"], np.int32).reshape(len(left_out), -1)[apart[i]], fits[i].n)

    def unpack(blob: bytes) -> np.ndarray:
        return np.frombuffer(blob, np.int32).reshape(-1, wide)

    def errors(state: DataFrame, points: list[Point | None], beta: np.ndarray, coef: np.ndarray) -> DataFrame:
        """(chunk, known, error, by_part, sums): errors at each fit's point, and sums of the
        losses, the errors and their products with the images so far."""
        active = np.array([p is not None for p in points])

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                made = []
                for known, images in zip(pdf["known"], pdf["images"]):
                    known = unpack(known)
                    images = [np.frombuffer(z).reshape(-1, width) for z in images]
                    margin = np.broadcast_to(beta, (len(known), width)).copy()
                    for k, z in enumerate(images):
                        margin += coef[k] * z
                    y = known[:, label_at].astype(np.float64)
                    use = _taking_part(known, fits) & active
                    loss = np.where(use, np.logaddexp(0.0, margin) - y * margin, 0.0)
                    error = np.where(use, 1.0 / (1.0 + np.exp(-margin)) - y, 0.0)
                    sums = [loss.sum(axis=0), error.sum(axis=0), *[(z * error).sum(axis=0) for z in images]]
                    made.append((error.tobytes(), np.stack(sums).tobytes(), split(error)))
                yield pd.DataFrame({"chunk": pdf["chunk"], "known": pdf["known"], "error": [m[0] for m in made], "by_part": [m[2] for m in made], "sums": [m[1] for m in made]})

        return state.select("chunk", "known", "images").mapInPandas(each, "chunk long, known binary, error binary, by_part array<binary>, sums binary")

    def there_and_back(cell: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        part, task = int(cell["part"].iloc[0]), int(cell["task"].iloc[0])
        own = parts_of[part]
        error, ends = joined(q, len(own))
        out, total = np.zeros_like(error), error.sum(axis=1)
        on = [k for k in range(len(own)) if total[k] or error[k].any()]  # fits that go on
        for _, c in cell.iterrows():
            _, first, at = _columns(c)
            spreads = [held_by(c, i) for i in own]
            for columns, starts, counts, rows in _slices(first, at):
                for k in on:
                    mean, scale = (s[columns] for s in spreads[k])
                    t = (np.add.reduceat(error[k].take(rows), starts) * scale - mean * scale * total[k]) * scale
                    out[k] += np.bincount(rows, np.repeat(t, counts), out.shape[1]) - (mean * t).sum()
        z = [np.ascontiguousarray(p).tobytes() for p in np.split(out, ends[:-1], axis=1)]
        return pd.DataFrame({"chunk": q["chunk"].to_numpy(), "part": part, "task": task, "z": z})

    def grown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for error, parts in zip(pdf["error"], pdf["parts"]):
                error = np.frombuffer(error).reshape(-1, width)
                z = np.zeros_like(error)
                for p in parts:
                    z[:, parts_of[p["part"]]] += np.frombuffer(p["z"]).reshape(-1, len(error)).T
                own = (z * error).sum(axis=0)
                made.append((z.tobytes(), own.tobytes()))
            yield pd.DataFrame({
                "chunk": pdf["chunk"], "known": pdf["known"], "own": [m[1] for m in made],
                "images": [[*i, m[0]] for i, m in zip(pdf["images"], made)],
            })

    state = chunks.select("chunk", "known", F.array().cast("array<binary>").alias("images"))
    last: list[DataFrame] = []
    evaluated: list[DataFrame] = []
    running = [f.steps(max_iter) if f.known() else None for f in fits]
    points = [next(r) if r else None for r in running]
    done = 0
    while any(p is not None for p in points):
        beta = np.array([p.b if p else 0.0 for p in points])
        coef = np.zeros((done, width))
        for i, p in enumerate(points):
            if p:
                coef[: len(p.a), i] = p.a
        made = materialize(errors(state, points, beta, coef), "fit-errors")
        sums = np.stack([np.frombuffer(r["sums"]).reshape(-1, width) for r in made.select("chunk", "sums").orderBy("chunk").collect()]).sum(axis=0)
        parts = _by_group(cells, tasks, by_part(made), there_and_back, "chunk long, part int, task int, z binary")
        parts = parts.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "task", "z"))).alias("parts"))
        both = made.select("chunk", "known", "error").join(state.select("chunk", "images"), "chunk").join(parts, "chunk")
        state = materialize(both.mapInPandas(grown, "chunk long, known binary, own binary, images array<binary>"), "fit-state")
        own = np.stack([np.frombuffer(r["own"]) for r in state.select("chunk", "own").orderBy("chunk").collect()]).sum(axis=0)
        for old in last:
            drop_table(old)
        last = [state]
        evaluated.append(made)
        for i, f in enumerate(fits):
            wider = np.zeros((done + 1, done + 1))
            wider[:done, :done] = f.products
            wider[done, :done] = wider[:done, done] = sums[2:, i]
            wider[done, done] = own[i]
            f.products = wider
        for i, r in enumerate(running):
            if points[i] is not None:
                try:
                    points[i] = r.send((done, float(sums[0, i]), float(sums[1, i])))
                except StopIteration:
                    points[i] = None
        done += 1
        if done % RELEASE == 0:
            release_shuffles(rows.sparkSession)

    # Each fit's numbers a row, from which its weights and the margins follow.
    final = np.zeros((done, width))
    beta = np.zeros(width)
    for i, f in enumerate(fits):
        final[: len(f.end.a), i] = f.end.a
        beta[i] = f.end.b if f.known() else (np.inf if f.ones else -np.inf)

    def ended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for known, images, errs in zip(pdf["known"], pdf["images"], pdf["errors"]):
                size = (len(unpack(known)), width)
                numbers, margin = np.zeros(size), np.zeros(size)
                for k in range(done):
                    numbers += final[k] * np.frombuffer(errs[k]).reshape(size)
                    margin += final[k] * np.frombuffer(images[k]).reshape(size)
                made.append((split(numbers), (margin + beta).tobytes()))
            yield pd.DataFrame({"chunk": pdf["chunk"], "by_part": [m[0] for m in made], "margin": [m[1] for m in made]})

    end = state.select("chunk", "known", "images").withColumn("errors", F.array().cast("array<binary>"))
    if evaluated:
        listed = [t.select("chunk", F.struct(F.lit(k).alias("k"), "error").alias("e")) for k, t in enumerate(evaluated)]
        listed = reduce(DataFrame.unionByName, listed).groupBy("chunk").agg(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["error"]).alias("errors"))
        end = state.select("chunk", "known", "images").join(listed, "chunk")
    end = materialize(end.mapInPandas(ended, "chunk long, by_part array<binary>, margin binary"), "fit-end")

    def weights(cell: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        part = int(cell["part"].iloc[0])
        own, made = parts_of[part], []
        number, _ = joined(q, len(own))
        total = number.sum(axis=1)
        for _, c in cell.iterrows():
            idx, first, at = _columns(c)
            out, shift = np.empty((len(idx), len(own))), np.zeros(len(own))
            spreads = [held_by(c, i) for i in own]
            for columns, starts, _, rows in _slices(first, at):
                for k in range(len(own)):
                    mean, scale = (s[columns] for s in spreads[k])
                    out[columns, k] = (np.add.reduceat(number[k].take(rows), starts) * scale - mean * scale * total[k]) * scale
                    shift[k] += (out[columns, k] * mean).sum()
            made.append({"group": int(c["group"]), "part": part, "idx": c["idx"], "made": out.tobytes(), "shift": shift.tobytes()})
        return pd.DataFrame(made)

    def listed_weights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for group, idx, found in zip(pdf["group"], pdf["idx"], pdf["found"]):
                idx = np.frombuffer(idx, np.int32)
                made = [np.frombuffer(p["made"]).reshape(len(idx), -1) for p in found]
                for at in range(0, len(idx), CHUNK):
                    yield pd.DataFrame({"idx": idx[at : at + CHUNK], "weights": list(np.concatenate([m[at : at + CHUNK] for m in made], axis=1))})
                # The group's part of the intercept comes after its columns, under a number below 0.
                yield pd.DataFrame({"idx": [-1 - group], "weights": [np.concatenate([np.frombuffer(p["shift"]) for p in found])]})

    made = _by_group(cells, tasks, by_part(end), weights, "group int, part int, idx binary, made binary, shift binary")
    made = made.groupBy("group").agg(F.first("idx").alias("idx"), F.sort_array(F.collect_list(F.struct("part", "made", "shift"))).alias("found"))
    table = materialize(made.mapInPandas(listed_weights, "idx int, weights array<double>"), "fit-weights")
    shifts = table.where("idx < 0").orderBy(F.desc("idx")).collect()  # a row a group
    intercepts = beta - np.sum([r["weights"] for r in shifts], axis=0) if shifts else beta

    def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chunk, margin in zip(pdf["chunk"], pdf["margin"]):
                margin = np.frombuffer(margin).reshape(-1, width)
                yield pd.DataFrame({"pos": int(chunk) * CHUNK + np.arange(len(margin)), "margins": margin.tolist()})

    margins = materialize(end.select("chunk", "margin").mapInPandas(unpacked, "pos long, margins array<double>"), "fit-margins")
    cells.unpersist()
    for old in [*last, *evaluated, end, chunks, packed]:
        drop_table(old)
    release_shuffles(rows.sparkSession)
    return Fitted(fits, table.where("idx >= 0"), [float(b) for b in intercepts], margins)

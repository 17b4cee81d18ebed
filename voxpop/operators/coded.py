"""Gram lists as numbers, block by block.

A block is some rows of one task. Its distinct grams are listed once, numbered from 0 by
their place (the code), and its rows refer to them by code. So what is known of a gram
(document frequency, number, weight) is joined with the distinct grams of a block,
of which there are far fewer than of its rows, and no row's grams are shuffled as text.
Blocks are bounded in bytes, and the work within them is numpy's and Arrow's.

Most grams of a corpus are too rare to be in a vocabulary. A first pass counts 64-bit hashes
of grams, not the grams; equal hashes of different grams only add to a count, so a gram is no
more frequent than its hash. A second pass lists the grams whose hash may be frequent, by
a bitmap of bounded size, and these are counted as text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from voxpop.session import drop_table, materialize

#: Bytes of grams a block, about; a row is never cut.
BLOCK = 32 << 20
#: Grams that are sent to Spark at a time.
SENT = 100_000
#: Hashes that are counted at a time.
HASHES = 4_000_000
#: Bits of a bitmap for each hash, the most in all (64 MB), and of a piece of it. Where there
#: are more hashes than bits, more grams are listed that are then found rare, and no more.
BITS_EACH, BITS_MOST, BITS_PIECE = 16, 1 << 29, 1 << 20


@dataclass(frozen=True)
class Coded:
    """A written table of three kinds of rows, told apart by what is null: a block's
    grams, its rows' other columns, and its rows' codes."""

    table: DataFrame

    @property
    def grams(self) -> DataFrame:
        """(block, code, gram, freq): freq of the block's rows have the gram."""
        return self.table.where("gram IS NOT NULL").select("block", "code", "gram", "freq")

    @property
    def rows(self) -> DataFrame:
        """(block, row, the other columns): row rises with a block's rows."""
        return self.table.where("other IS NOT NULL").select("block", "other.*").withColumnRenamed("_row", "row")

    @property
    def cells(self) -> DataFrame:
        """(block, rows, starts, codes, counts): see ``Cells``."""
        return self.table.where("codes IS NOT NULL").select("block", "rows", "starts", "codes", "counts")

    def frequencies(self) -> DataFrame:
        """(gram, doc_freq) of all grams."""
        return self.grams.groupBy("gram").agg(F.sum("freq").cast("long").alias("doc_freq"))

    def each_block(self, known: DataFrame, each: Callable[[Cells, pd.DataFrame], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
        """``each(cells, known)`` of every block with rows: ``known`` has (block, ...)."""

        def task(cell: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
            names = [field.split()[0] for field in schema.split(", ")]
            return each(Cells.of(cell.iloc[0]), found) if len(cell) else pd.DataFrame({name: [] for name in names})

        # Renamed, as both sides may come from one table.
        return self.cells.groupBy("block").cogroup(known.withColumnRenamed("block", "_block").groupBy("_block")).applyInPandas(task, schema)

    def drop(self) -> None:
        drop_table(self.table)


@dataclass(frozen=True)
class Cells:
    """Of one block: the kept rows' numbers, where the codes of each start (and end), their
    distinct codes in ascending order, and how often a row has each."""

    rows: np.ndarray
    starts: np.ndarray
    codes: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(cell: pd.Series) -> Cells:
        return Cells(*(np.frombuffer(cell[c], kind) for c, kind in (("rows", np.int64), ("starts", np.int64), ("codes", np.int32), ("counts", np.int32))))

    def lookup(self, codes: np.ndarray, values: np.ndarray, missing) -> np.ndarray:
        """The value of each row's code, or ``missing``."""
        table = np.full(max(int(self.codes.max(initial=-1)), int(codes.max(initial=-1))) + 1, missing, values.dtype)
        table[codes] = values
        return table[self.codes]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """A row's sum of a number a code."""
        total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def by_code(self, values: np.ndarray) -> np.ndarray:
        """A number a row, for each of its codes."""
        return np.repeat(values, np.diff(self.starts))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number a byte, and the powers of an odd number and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64), np.multiply.accumulate(up), np.multiply.accumulate(down)


def hashes_of(texts: pa.Array) -> np.ndarray:
    """A 64-bit hash of each text's bytes: a sum of a number a byte times the power of its
    place. (As a higher-order function of the cleaned grams, Spark's hash takes its
    optimiser minutes.)"""
    out = []
    for at in range(0, len(texts), SENT):
        some = texts.slice(at, SENT)
        ends = np.frombuffer(some.buffers()[1], np.int32)[some.offset : some.offset + len(some) + 1].astype(np.int64)
        raw = np.frombuffer(some.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        number, up, down = _powers(1 << max(20, (len(raw) + 1).bit_length()))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(number[raw] * up[: len(raw)], out=sums[1:])
        ends -= ends[0]
        value = (sums[ends[1:]] - sums[ends[:-1]]) * down[ends[:-1]]
        value = (value ^ value >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        out.append((value ^ value >> np.uint64(32)).view(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def frequent_hashes(df: DataFrame, least: float, grams_col: str = "grams") -> DataFrame:
    """(hash) of the grams that ``least`` rows or more have. Tasks send sorted and counted
    runs of hashes, packed, to where a range of hashes is counted."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = np.array([((i << 64) // ranges) - (1 << 63) for i in range(1, ranges)], np.int64)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        found, freq = np.unique(np.concatenate(held), return_counts=True)
        freq, cuts = freq.astype(np.int32), np.searchsorted(found, starts)
        arrays = [pa.array(np.arange(ranges, dtype=np.int32)), *(pa.array([p.tobytes() for p in np.split(v, cuts)], pa.binary()) for v in (found, freq))]
        return pa.RecordBatch.from_arrays(arrays, names=["range", "hashes", "freq"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("g")), 0).to_numpy(zero_copy_only=False)
            hashes, ends = hashes_of(batch.column("g").flatten().cast(pa.string())), np.cumsum(lengths)
            for end, n in zip(ends.tolist(), lengths.tolist()):
                own = np.sort(hashes[end - n : end])
                held.append(own[np.r_[True, own[1:] != own[:-1]]] if n else own)
                size += len(held[-1])
                if size >= HASHES:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = np.concatenate([np.frombuffer(b, np.int64) for b in pdf["hashes"]])
        freq = np.concatenate([np.frombuffer(b, np.int32) for b in pdf["freq"]])
        order = np.argsort(hashes, kind="stable")  # of sorted runs
        hashes, freq = hashes[order], freq[order]
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
        total = np.add.reduceat(freq, first, dtype=np.int64) if len(first) else first
        return pd.DataFrame({"hash": hashes[first][total >= least]})

    made = df.select(F.col(grams_col).alias("g")).mapInArrow(each, "range int, hashes binary, freq binary")
    return made.groupBy("range").applyInPandas(summed, "hash long")


def hashes_in(grams: DataFrame) -> DataFrame:
    """(hash) of the column ``gram``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(hashes_of(batch.column("gram").cast(pa.string())))], names=["hash"])

    return grams.select("gram").mapInArrow(each, "hash long")


def bitmap(hashes: DataFrame) -> np.ndarray:
    """A bit for each ``hash`` of a written table, by its lowest bits: at most
    ``BITS_MOST`` bits come to the driver, in pieces."""
    size = 1 << max(10, min(BITS_EACH * hashes.count(), BITS_MOST).bit_length() - 1)
    own = min(size, BITS_PIECE)

    def piece(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(own, bool)
        bits[pdf["slot"].to_numpy() % own] = True
        return pd.DataFrame({"piece": pdf["piece"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    slots = hashes.select(F.col("hash").bitwiseAND(F.lit(size - 1)).alias("slot")).distinct()
    made = slots.withColumn("piece", F.floor(F.col("slot") / own)).groupBy("piece").applyInPandas(piece, "piece long, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for r in made.collect():  # at most BITS_MOST / BITS_PIECE rows
        out[r["piece"] * own // 8 : (r["piece"] + 1) * own // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def maybe_frequent(df: DataFrame, least: float, grams_col: str = "grams") -> np.ndarray | None:
    """The bitmap of all hashes that ``least`` rows or more have; None if that's all."""
    if least <= 1:
        return None
    found = materialize(frequent_hashes(df, least, grams_col), "frequent-hashes")
    out = bitmap(found)
    drop_table(found)
    return out


def coded(df: DataFrame, name: str, kept: Column | None = None, grams_col: str = "grams", keep_grams: bool = False, among: np.ndarray | None = None) -> Coded:
    """``df`` in blocks. Rows that aren't ``kept`` count in the frequencies, but their
    codes aren't listed. With ``among``, grams whose hash isn't in this bitmap are left out."""
    others = F.struct(F.monotonically_increasing_id().alias("_row"), *[F.col(f"`{c}`") for c in df.columns if keep_grams or c != grams_col])
    given = df.select(others.alias("other"), F.col(grams_col).alias("g"), (F.lit(True) if kept is None else F.coalesce(kept, F.lit(False))).alias("kept"))
    kinds = [("block", LongType()), ("code", IntegerType()), ("gram", StringType()), ("freq", IntegerType()), ("other", given.schema["other"].dataType)]
    kinds += [("rows", BinaryType()), ("starts", BinaryType()), ("codes", BinaryType()), ("counts", BinaryType())]
    schema = StructType([StructField(n, kind) for n, kind in kinds])
    arrow = {"block": pa.int64(), "code": pa.int32(), "gram": pa.string(), "freq": pa.int32()} | {c: pa.binary() for c in ("rows", "starts", "codes", "counts")}

    def out(n: int, kind: pa.DataType, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, arrow.get(c, kind)) for c, _ in kinds], names=[c for c, _ in kinds])

    def listed(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, pa.Array]:
        """A run of rows, how many grams each has, and these grams."""
        lengths = pc.fill_null(pc.list_value_length(batch.column("g")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        grams = batch.column("g").flatten().cast(pa.string())
        if among is not None:
            slot = hashes_of(grams) & (8 * len(among) - 1)
            mask = (among[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
            grams = grams.filter(pa.array(mask))
            lengths = np.bincount(np.repeat(np.arange(len(batch)), lengths)[mask], minlength=len(batch))
        return batch.select(["other", "kept"]), lengths, grams

    def block(held: list[tuple[pa.RecordBatch, np.ndarray, pa.Array]]) -> Iterator[pa.RecordBatch]:
        lengths = np.concatenate([n for _, n, _ in held])
        values = pa.concat_arrays([g for _, _, g in held]).dictionary_encode()
        held = [b for b, _, _ in held]
        other_kind = held[0].column("other").type
        number = held[0].column("other").field(0)[0].as_py()
        here = lambda n: pa.array(np.full(n, number, np.int64))
        for b in held:
            yield out(len(b), other_kind, block=here(len(b)), other=b.column("other"))
        grams, code = values.dictionary, pc.fill_null(values.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(grams):
            grams = pa.array([], pa.string())
        row = np.repeat(np.arange(len(lengths)), lengths)
        key, counts = np.unique((row * max(len(grams), 1) + code)[code >= 0], return_counts=True)
        row, code = np.divmod(key, max(len(grams), 1))
        freq = pa.array(np.bincount(code, minlength=len(grams)).astype(np.int32))
        for at in range(0, len(grams), SENT):
            n = min(SENT, len(grams) - at)
            yield out(n, other_kind, block=here(n), code=pa.array(np.arange(at, at + n, dtype=np.int32)), gram=grams.slice(at, n), freq=freq.slice(at, n))
        wanted = np.concatenate([b.column("kept").to_numpy(zero_copy_only=False) for b in held]).astype(bool)
        if wanted.any():
            numbers = np.concatenate([b.column("other").field(0).to_numpy() for b in held])[wanted].astype(np.int64)
            sizes = np.bincount(row, minlength=len(lengths))[wanted]
            mine = wanted[row]
            made = {"rows": numbers, "starts": np.r_[0, np.cumsum(sizes)].astype(np.int64), "codes": code[mine].astype(np.int32), "counts": counts[mine].astype(np.int32)}
            yield out(1, other_kind, block=here(1), **{c: pa.array([v.tobytes()], pa.binary()) for c, v in made.items()})

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Runs of rows of about a block's bytes at most."""
        lists = batch.column("g")
        sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(lists.flatten()), 0).to_numpy(zero_copy_only=False))])
        ends = sizes[np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + BLOCK, "right")))
            yield batch.slice(at, to - at)
            at = to

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in map(listed, pieces(batch) if len(batch) else ()):
                more = pc.sum(pc.binary_length(piece[2])).as_py() or 0
                if held and size + more > BLOCK:
                    yield from block(held)
                    held, size = [], 0
                held.append(piece)
                size += more
        if held:
            yield from block(held)

    return Coded(materialize(given.mapInArrow(each, schema), name))

"""Removal of byte strings that occur more than once, by refinement of shared intervals (operator 9).

Wanted are all starts of ``length``-byte strings that start anywhere else too. Sorting suffixes is
avoided: starts are held in intervals, and intervals with a common context meet by its digest.

1. Anchors. Of the ``GRAM``-byte grams inside a string the one of smallest hash is its anchor, so
   equal strings have equal anchors at the same distance. Anchors whose gram occurs once settle all
   their starts.
2. Refinement. Starts are cut into cells on a grid counted from their anchor. All strings that start
   in a cell share its core (their intersection) and lie in its hull (their union). A cell whose core
   occurs once holds no repeated string; a cell whose hull occurs twice holds only repeated ones;
   any other is cut into smaller cells, down to single starts. Of equal hulls one stands for all in
   the next round. Each round reads only what the round before left open.

Digests of cores and hulls have 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import PLACE, addressable, bounded_batches, carried, join_by_weight, text_of, worker_store
from bramble.session import materialise

LENGTH = 400
GRAM = 128
#: starts per cell in the rounds of refinement; each divides the one before, the last is 1
CELLS = (64, 8, 1)
#: bytes of a text that are hashed at a time; positions in such a part fit into SPOT
PART = 1 << 22
SPOT = np.uint64((1 << 23) - 1)
_STEP = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and of its inverse; the worker keeps the longest so far."""
    kept = worker_store("powers")
    if len(kept.get("up", ())) < n:
        size = max(n, 1 << 17)
        up, down = np.full(size, _STEP, np.uint64), np.full(size, pow(_STEP, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        kept["up"], kept["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return kept["up"][:n], kept["down"][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mix((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_STEP))


def _sliding_min(q: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks forwards and backwards."""
    n = len(q)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = q
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n - width + 1], forward[width - 1:n])


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``position, key, first, last``: each anchor, its gram's hash and the starts that it is the anchor of."""
    found: list[tuple[np.ndarray, ...]] = []
    starts = len(data) - length + 1
    for base in range(0, max(starts, 0), PART):
        part = np.frombuffer(data, np.uint8, min(PART + length - 1, len(data) - base), base)
        n = len(part)
        up, down = _powers(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[part] * up, dtype=np.uint64)])
        keys = _mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1])
        placed = (keys & ~SPOT) | np.arange(len(keys), dtype=np.uint64)
        where = (_sliding_min(placed, length - gram + 1) & SPOT).astype(np.int64)
        turn = np.flatnonzero(np.diff(where)) + 1
        first = np.concatenate([[0], turn])
        last = np.concatenate([turn, [len(where)]]) - 1
        at = where[first]
        found.append((at + base, keys[at].view(np.int64), first + base, last + base))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found))


def cells_of(anchor: int, first: int, last: int, size: int) -> range:
    """Lowest starts of the grid cells below an anchor that hold any of the starts first..last."""
    nearest, furthest = (anchor - last) // size, (anchor - first) // size
    return range(anchor - furthest * size - size + 1, anchor - nearest * size - size + 2, size)


def digests(data: bytes, lows: list[int], size: int, length: int = LENGTH) -> tuple[list, list]:
    """Core and hull digest of each cell; the hull is null where a cell reaches beyond the text."""
    from xxhash import xxh3_128_digest
    n = len(data)
    cores = [xxh3_128_digest(data[lo + size - 1:lo + length]) for lo in lows]
    if size == 1:
        return cores, cores
    return cores, [xxh3_128_digest(data[lo:lo + size - 1 + length]) if lo >= 0 and lo + size - 1 + length <= n
                   else None for lo in lows]


def remove(data: bytes, cells: list[tuple[int, int]], length: int = LENGTH) -> tuple[bytes, int, int]:
    """What is left, the bytes removed and their runs; ``cells`` are (lowest start, number of starts)."""
    edges = np.zeros(len(data) + 1, np.int64)
    spans = np.array(cells, np.int64).reshape(-1, 2)
    np.add.at(edges, spans[:, 0], 1)
    np.add.at(edges, spans[:, 0] + spans[:, 1] - 1 + length, -1)
    gone = np.cumsum(edges[:-1]) > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])) if len(gone) else 0
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _bytes_of(value) -> bytes:
    return value.encode("utf-8", "surrogatepass") if isinstance(value, str) else b""


def _scan(content: DataFrame, doc_id: str, text: str, length: int, gram: int) -> DataFrame:
    """One row per document with its anchors; ``uid`` numbers the rows of the written table."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = [_bytes_of(t) for t in batch["text"]]
            found = [anchors(d, length, gram) for d in data]
            yield batch[["doc_id", *PLACE]].assign(
                n_bytes=[len(d) for d in data], sha=[hashlib.sha256(d).hexdigest() for d in data],
                **{name: [f[i] for f in found] for i, name in enumerate(("at", "key", "first", "last"))})

    rows = content.select(carried(doc_id), *PLACE, text_of(text).alias("text")).mapInPandas(
        look, f"doc_id string, {PLACE[0]} string, {PLACE[1]} long, n_bytes long, sha string, at array<long>, "
              "key array<long>, first array<long>, last array<long>")
    return materialise(rows.withColumn("doc_id", F.col("doc_id").cast(content.schema[doc_id].dataType))
                       .withColumn("uid", F.monotonically_increasing_id()), "scan")


def _cells(texts: DataFrame, lows: DataFrame, size: int, length: int) -> DataFrame:
    """``uid, low, core, hull`` of the cells ``(uid, low)``."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: tuple[list, ...] = ([], [], [], [])

        def rows() -> pd.DataFrame:
            made = pd.DataFrame(dict(zip(("uid", "low", "core", "hull"), out)))
            for column in out:
                column.clear()
            return made

        for batch in batches:
            for uid, data, held in zip(batch["uid"], batch["data"], batch["lows"]):
                mine = sorted(set(held.tolist()))
                for lo in range(0, len(mine), 20_000):
                    some = mine[lo:lo + 20_000]
                    for column, values in zip(out, ([uid] * len(some), some, *digests(data, some, size, length))):
                        column.extend(values)
                    if len(out[0]) >= 20_000:
                        yield rows()
        if out[0]:
            yield rows()

    per_text = lows.groupBy("uid").agg(F.collect_list("low").alias("lows"))
    return materialise(texts.join(per_text, "uid").select("uid", "data", "lows").mapInPandas(
        measure, "uid long, low long, core binary, hull binary"), "cells")


def repeated_cells(texts: DataFrame, lows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``uid, low, starts``: cells in which every string is repeated, over all rounds of refinement."""
    found = None
    for size, finer in zip(CELLS, (*CELLS[1:], None)):
        cells = _cells(texts, lows, size, length)
        classes = materialise(cells.groupBy("core", "hull").agg(
            F.count("*").alias("n"), F.min(F.struct("uid", "low")).alias("one")), "classes")
        settled = classes.where("hull is not null and n > 1")
        mine = join_by_weight(cells, settled.select("core", "hull", "n"), ["core", "hull"], "n", cells.count()) \
            .select("uid", "low", F.lit(size).alias("starts"))
        found = mine if found is None else found.unionByName(mine)
        if finer is None:
            break
        open_cores = classes.groupBy("core").agg(
            F.sum("n").alias("members"), F.count("*").alias("kinds"),
            F.max((F.col("hull").isNull() | (F.col("n") == 1)).cast("int")).alias("open")) \
            .where("members > 1 and open = 1")
        kinds = classes.select("core", "hull", "one")
        meeting = materialise(join_by_weight(kinds, open_cores.select("core", "kinds"), "core", "kinds",
                                             classes.count()), "meeting")
        whole = meeting.where("hull is not null").select("one.uid", "one.low")
        cut = cells.where("hull is null").join(meeting.where("hull is null").select("core"), "core") \
            .select("uid", "low")
        step = F.explode(F.sequence(F.lit(0), F.lit(size - finer), F.lit(finer)))
        lows = whole.unionByName(cut).select("uid", "low", step.alias("step")) \
            .select("uid", (F.col("low") + F.col("step")).alias("low"))
        # a cell at the end of its text may have no string left in a part of it
        ends = texts.select("uid", (F.length("data") - length).alias("end"))
        lows = lows.join(ends, "uid").where((F.col("low") <= F.col("end")) & (F.col("low") + finer > 0)) \
            .select("uid", "low")
    return found


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                    gram: int = GRAM, stored: bool = False, with_bytes: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row, and ``kept`` if asked for.

    A byte goes if a ``length``-byte string that also starts elsewhere covers it; overlapping
    occurrences count, strings do not cross documents, and null texts are empty. Repeated rows are
    documents of their own, so they remove each other's strings.
    """
    bounded_batches(docs.sparkSession, rows=500)
    content = addressable(docs, stored=stored)
    scan = _scan(content, doc_id, text, length, gram)
    spots = scan.select("uid", F.explode(F.arrays_zip("at", "key", "first", "last")).alias("a")).select("uid", "a.*")
    twice = spots.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    held = join_by_weight(spots, materialise(twice, "keys"), "key", "n", spots.count())

    def grid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = zip(*(batch[c].tolist() for c in ("uid", "at", "first", "last")))
            rows = [(u, lo) for u, a, f, e in columns for lo in cells_of(a, f, e, CELLS[0])]
            yield pd.DataFrame(rows, columns=["uid", "low"])

    lows = materialise(held.select("uid", "at", "first", "last").mapInPandas(grid, "uid long, low long"), "lows")
    where = scan.select("uid", *PLACE).join(lows.select("uid").distinct(), "uid")
    texts = materialise(content.select(*PLACE, F.encode(text_of(text), "utf-8").alias("data"))
                        .join(where, list(PLACE)).select("uid", "data"), "texts")
    flagged = repeated_cells(texts, lows, length).groupBy("uid") \
        .agg(F.collect_list(F.struct("low", "starts")).alias("cells"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left = [remove(d, [(c["low"], c["starts"]) for c in cells], length)
                    for d, cells in zip(batch["data"], batch["cells"])]
            out = {"uid": batch["uid"], "removed": [x[1] for x in left], "spans": [x[2] for x in left],
                   "rest": [hashlib.sha256(x[0]).hexdigest() for x in left]}
            if with_bytes:
                out["kept"] = [x[0] for x in left]
            yield pd.DataFrame(out)

    shape = "uid long, removed long, spans long, rest string" + (", kept binary" if with_bytes else "")
    changed = texts.join(flagged, "uid").select("uid", "data", "cells").mapInPandas(cut, shape)
    out = scan.select("uid", "doc_id", "n_bytes", "sha", *(PLACE if with_bytes else [])) \
        .join(changed, "uid", "left")
    columns = ["doc_id", "n_bytes", F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
               F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
               F.coalesce("rest", "sha").alias("kept_sha256")]
    if with_bytes:
        whole = content.select(*PLACE, F.encode(text_of(text), "utf-8").alias("_whole"))
        out = out.join(whole, list(PLACE))
        columns.append(F.coalesce("kept", "_whole").alias("kept"))
    return out.select(*columns)

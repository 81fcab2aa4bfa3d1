"""Near-duplicates by many universal hash minima, banding and exact verification (operator 11).

1. A document is its set of distinct word shingles, each a 64-bit hash. Equal sets are one point.
2. A point's signature holds the minima of HASHES universal hash functions over the set. ROWS minima
   form a band; points with an equal band meet in its bucket. A pair of similarity 0.85 misses all
   of the 24 bands of four with a probability of 2e-8.
3. Hubs. In every bucket the best-connected member (most bucket mates over all its buckets) is
   paired with each other member: one pair per member, however large the bucket. Signatures that
   agree too little are refused; the rest is confirmed on the full sets, and components are
   joined. That settles families of copies of one text.
4. Remainders. Buckets that still hold several components are searched completely. Their members
   meet block by block; the signatures tell which members have an open partner, one in another
   component that agrees enough. Only those fetch their full sets and are compared in the same
   blocks, many sets at a time, and a block hands on a spanning forest of its confirmed links. No
   pair is dropped: what is not compared is in one component already or refused by its signature.
5. Components come from alternating large-star and small-star rounds.

A signature is refused when fewer than ``threshold - MARGIN`` of its minima agree, more than five
standard deviations below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import PLACE, addressable, bounded_batches, carried, join_by_weight, worker_store
from bramble.llm.simhash import FEW, shingle_hashes
from bramble.session import materialise

WIDTH, PERCENT = 3, 85
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
MARGIN, SEED = 0.2, 42
#: shingles hashed to minima at a time
BLOCK = 2048
#: members of a bucket that are compared as one block, and shingles that one block holds about
MEMBERS, SHINGLES = 1024, 1_000_000
#: proposals that are compared with one replica of their hub
PER_REPLICA = 512


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and summands of the functions x -> (a x + b) mod 2^64 >> 32 of 32-bit x, a odd."""
    rng = np.random.default_rng(SEED)
    a, b = rng.integers(0, 1 << 64, (2, HASHES), np.uint64)
    return a | np.uint64(1), b


TIMES, PLUS = _functions()


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word shingles (fewer words: of them all); A-Z are lowered."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not words:
        return np.array([], np.uint64)
    return np.unique(np.concatenate([block.ravel() for block in shingle_hashes(words, width)]))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of all functions over a set that is not empty."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    x = shingles >> np.uint64(32)
    for lo in range(0, len(x), BLOCK):
        np.minimum(least, (x[lo:lo + BLOCK, None] * TIMES + PLUS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def bands(minima: np.ndarray) -> list[int]:
    """One 64-bit key per band; different bands have different seeds."""
    from xxhash import xxh64_intdigest
    data = minima.astype("<u4").tobytes()
    keys = [xxh64_intdigest(data[4 * ROWS * k:4 * ROWS * (k + 1)], k) for k in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _sets(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``doc_id, PLACE, same, n, keys, least``: digest, size, bands and lowest bytes of the minima of each set."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest
        worker_store("minhash")  # lets go of what the worker remembers for other operators
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch["_text"]]
            minima = [signature(s) if len(s) else None for s in sets]
            yield batch[["doc_id", *PLACE]].assign(
                n=[len(s) for s in sets], same=[xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                keys=[None if m is None else bands(m) for m in minima],
                least=[None if m is None else (m & np.uint32(255)).astype(np.uint8).tobytes() for m in minima])

    return docs.select(carried(doc_id), *PLACE, F.col(text).alias("_text")).mapInPandas(
        score, f"doc_id string, {PLACE[0]} string, {PLACE[1]} long, n long, same binary, keys array<long>, least binary") \
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def star_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` of every node of the edges ``(a, b)``; label is the component's smallest node.

    Large-star links each node's larger neighbours to the smallest node around it, small-star does
    so with the smaller ones and the node itself; both keep components. They alternate until the
    edges are stars around the smallest nodes, that is until no round changes them.
    """
    links = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    state = None
    while True:
        both = materialise(links.union(links.select("b", "a")), "both")
        around = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"),
                                                   F.count("*").alias("degree")), "around")
        total = both.count()
        large = join_by_weight(both, around, "a", "degree", total).where("b > a") \
            .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = materialise(large, "large")  # a is the larger end
        least = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("degree"))
        least = materialise(least, "least")
        small = join_by_weight(large, least, "a", "degree", large.count()).select(F.col("b").alias("a"), F.col("low").alias("b")) \
            .union(least.select("a", F.col("low").alias("b"))).where("a <> b").distinct()
        links = materialise(small, "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())
        if now == state:
            break
        state = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return materialise(links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots), "labels")


def _agreement(least: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (least == other).sum(axis=-1)


def _enough(percent: int) -> int:
    return int(np.ceil((percent / 100 - MARGIN) * HASHES))


def _proposals(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """``hub, id``: each member with the best-connected member of each of its buckets, once."""
    held = materialise(join_by_weight(members, sizes, "key", "size", members.count()), "held")
    mates = held.groupBy("id").agg(F.sum("size").alias("mates"))
    best = held.join(mates, "id").groupBy("key").agg(F.max(F.struct("mates", "id")).alias("best"), F.count("*").alias("size"))
    best = materialise(best.select("key", "size", F.col("best.id").alias("hub")), "hubs")
    return join_by_weight(members, best, "key", "size", members.count()).where("id <> hub").select("hub", "id").distinct()


def _with_replicas(pairs: DataFrame, points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``hub, replica, id`` and the columns of the point ``id``; each replica also has a row of the hub itself.

    A hub's proposals are dealt to replicas of PER_REPLICA pairs, so no key is large.
    """
    weight = pairs.groupBy("hub").agg(F.count("*").alias("pairs"))
    weight = materialise(weight.withColumn("replicas", F.ceil(F.col("pairs") / PER_REPLICA).cast("int")), "weights")
    dealt = join_by_weight(pairs, weight, "hub", "pairs", pairs.count()) \
        .select("hub", "id", F.pmod(F.xxhash64("id"), F.col("replicas")).cast("int").alias("replica"))
    own = weight.select("hub", F.col("hub").alias("id"), F.explode(F.sequence(F.lit(0), F.col("replicas") - 1)).alias("replica"))
    return dealt.unionByName(own).join(points.select("id", *columns), "id")


def _at_hubs(rows: DataFrame, passes, columns: Sequence[str]) -> DataFrame:
    """Pairs ``hub, id`` for which ``passes(hub's values, member's values)``; rows as from ``_with_replicas``."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, values = None, None
        for batch in batches:
            found = []
            for h, i, *value in zip(batch["hub"], batch["id"], *(batch[c] for c in columns)):
                if h == i:  # sorts first in its replica
                    hub, values = h, value
                elif h == hub and passes(values, value):
                    found.append((h, i))
            yield pd.DataFrame(found, columns=["hub", "id"]).astype("int64")

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "hub", "replica") \
        .sortWithinPartitions("hub", "replica", F.col("id") != F.col("hub")).mapInPandas(compare, "hub long, id long")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _fetched(content: DataFrame, points: DataFrame, ids: DataFrame, text: str, width: int) -> DataFrame:
    """Written ``id, shingles`` of the points in ``ids``: their texts are read again by place.

    Few places are broadcast, so that no text is shuffled; more meet their texts in a shuffle.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["id"]].assign(shingles=[shingle_set(t, width).tobytes() for t in batch["_text"]])

    chosen = materialise(points.join(ids.select("id").distinct(), "id").select("id", *PLACE), "chosen")
    few = chosen.count() <= FEW
    texts = content.select(*PLACE, F.col(text).alias("_text")) \
        .join(F.broadcast(chosen) if few else chosen, list(PLACE)).select("id", "_text")
    return materialise(texts.mapInPandas(cut, "id long, shingles binary"), "shingles")


def hub_links(content: DataFrame, points: DataFrame, members: DataFrame, sizes: DataFrame, text: str, width: int,
              percent: int) -> DataFrame:
    """Confirmed pairs ``hub, id`` of the members of each bucket and its hub."""
    enough = _enough(percent)

    def alike(a, b) -> bool:
        return 100 * min(a[0], b[0]) >= percent * max(a[0], b[0]) and _agreement(
            np.frombuffer(a[1], np.uint8), np.frombuffer(b[1], np.uint8)) >= enough

    pairs = materialise(_proposals(members, sizes), "proposals")
    passed = materialise(_at_hubs(_with_replicas(pairs, points, ["n", "least"]), alike, ["n", "least"]), "alike")
    ids = passed.select("id").union(passed.select("hub")).distinct()
    sets = _fetched(content, points, ids, text, width)

    def linked(a, b) -> bool:
        return _linked(np.frombuffer(a[0], np.uint64), np.frombuffer(b[0], np.uint64), percent)

    return materialise(_at_hubs(_with_replicas(passed, sets, ["shingles"]), linked, ["shingles"]), "confirmed")


def _open_members(rows: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Ids with a partner in another component whose signature and size allow the similarity."""
    probe, label, n, least, ids = (rows[c] for c in ("probe", "label", "n", "least", "id"))
    members, probes = np.flatnonzero(~probe), np.flatnonzero(probe)
    if not len(members) or not len(probes):
        return ids[:0]
    enough, involved = _enough(percent), np.zeros(len(ids), bool)
    labels, sizes, minima = label[members], n[members], least[members]
    for i in probes:
        near = (labels != label[i]) & (100 * np.minimum(sizes, n[i]) >= percent * np.maximum(sizes, n[i]))
        at = np.flatnonzero(near)
        at = at[_agreement(minima[at], least[i]) >= enough]
        if len(at):
            involved[i] = True
            involved[members[at]] = True
    return np.unique(ids[involved])


def block_links(probes: list[tuple], members: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Spanning links ``(a, b)`` between the components of rows ``(id, label, sorted shingles)``.

    Every probe is compared with every member of another component, all members at once. A link
    joins the components, so at most one per component is handed on.
    """
    if not probes or not members:
        return []
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    sets = [m[2] for m in members]
    known, places = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    labels = np.array([find(m[1]) for m in members])
    links = []
    for i, label, own in probes:
        if (labels == find(label)).all():
            continue
        marked = np.zeros(len(known) + 1, bool)
        at = np.searchsorted(known, own)
        inside = at < len(known)
        at = at[inside][known[at[inside]] == own[inside]]
        marked[at] = True
        both = np.add.reduceat(marked[places], starts, dtype=np.int64)
        for j in np.flatnonzero(100 * both >= percent * (sizes + len(own) - both)):
            a, b = find(label), find(members[j][1])
            if a != b:
                root[max(a, b)] = min(a, b)
                labels[labels == max(a, b)] = min(a, b)
                links.append((i, members[j][0]))
    return links


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The rows of each (key, block, part), which come together, as arrays by column; binary columns as objects."""
    def columns(table: pa.Table) -> dict[str, np.ndarray]:
        return {c: table[c].to_numpy() for c in table.column_names}

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        rows = columns(table)
        turns = np.flatnonzero((np.diff(rows["key"]) != 0) | (np.diff(rows["block"]) != 0) | (np.diff(rows["part"]) != 0)) + 1
        for lo, hi in zip([0, *turns[:-1]], turns):
            yield {c: v[lo:hi] for c, v in rows.items()}
        held = table.slice(turns[-1] if len(turns) else 0)
    if held is not None:
        yield columns(held)


def _dealt(members: DataFrame, volume: Column, limit: int) -> DataFrame:
    """Members ``key, id, label`` to comparisons ``key, block, part, probe`` so that every pair of labels meets.

    The component with most rows of a bucket needs no comparison inside itself: the others are
    probes. All members are dealt to blocks, probes to parts, and every block meets every part.
    """
    kinds = members.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum(volume).alias("volume"))
    keys = materialise(kinds.groupBy("key").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("kinds"),
                                                F.sum("n").alias("rows"), F.sum("volume").alias("volume")), "kinds")
    mixed = keys.where("kinds > 1").select("key", "rows", F.col("most.label").alias("main"),
                                           F.ceil(F.col("volume") / limit).cast("int").alias("blocks"))
    held = join_by_weight(members, mixed, "key", "rows", members.count())
    spot = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    probes = held.where("label <> main").withColumn("part", spot).withColumn("block", every).withColumn("probe", F.lit(True))
    # members meet the parts that have probes
    parts = probes.select("key", "part").distinct().groupBy("key").agg(F.collect_set("part").alias("parts"))
    alone = held.join(parts, "key").withColumn("block", spot).withColumn("part", F.explode("parts")) \
        .withColumn("probe", F.lit(False))
    columns = [*members.columns, "block", "part", "probe"]
    return probes.select(columns).unionByName(alone.select(columns))


def remaining_links(content: DataFrame, points: DataFrame, members: DataFrame, labels: DataFrame, text: str, width: int,
                    percent: int) -> DataFrame:
    """Links ``a, b`` between the components in ``labels`` that join all that the buckets still hold."""
    spark = points.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = points.select("id", "n", "least").join(labels.withColumnRenamed("node", "id"), "id", "left") \
        .withColumn("label", F.coalesce("label", "id"))
    known = materialise(known, "known")
    placed = materialise(members.join(known.select("id", "label", "n"), "id"), "placed")
    dealt = _dealt(placed, F.lit(1), MEMBERS).drop("n", "label")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            rows["least"] = np.frombuffer(b"".join(rows["least"]), np.uint8).reshape(len(rows["id"]), -1)
            found = _open_members(rows, percent)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), rows["key"][0])), pa.array(found)], ["key", "id"])

    rows = dealt.join(known, "id").repartition(parts, "key", "block", "part").sortWithinPartitions("key", "block", "part")
    involved = rows.select("key", "block", "part", "probe", "id", "label", "n", "least") \
        .mapInArrow(look, "key long, id long").distinct()
    involved = materialise(involved.join(known.select("id", "label", "n"), "id"), "involved")
    sets = _fetched(content, points, involved, text, width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            listed = [(int(i), int(c), np.frombuffer(s, np.uint64)) for i, c, s in zip(rows["id"], rows["label"], rows["shingles"])]
            found = block_links([r for r, p in zip(listed, rows["probe"]) if p],
                                [r for r, p in zip(listed, rows["probe"]) if not p], percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    again = _dealt(involved, F.col("n"), SHINGLES).drop("n")
    rows = again.join(sets, "id").repartition(parts, "key", "block", "part").sortWithinPartitions("key", "block", "part")
    return rows.select("key", "block", "part", "probe", "id", "label", "shingles") \
        .mapInArrow(search, "a long, b long")


def near_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                    percent: int = PERCENT, stored: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Rows link when the sets of their word shingles have ``100 * intersection >= percent * union``;
    a component has the smallest non-null id in it, null if it has none, and the rows of that id
    are kept. Rows without words link with nothing and are their own component. Repeated rows give
    repeated rows; null ids are kept only in a component without any other; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    content = addressable(docs, stored=stored)
    rows = materialise(_sets(content, doc_id, text, width), "sets")
    first = rows.where("n > 0").groupBy("same").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("keys").alias("keys"), F.first("least").alias("least"), F.min(F.struct(*PLACE)).alias("place"))
    points = materialise(first.select("same", "first_id", "copies", "n", "keys", "least", "place.*")
                         .withColumn("id", F.monotonically_increasing_id()), "points")
    filed = points.select("id", F.explode("keys").alias("key"))
    sizes = materialise(filed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    members = materialise(join_by_weight(filed, sizes, "key", "size", points.count() * BANDS)
                          .select("key", "id"), "members")
    links = hub_links(content, points, members, sizes, text, width, percent).select(F.col("hub").alias("a"), F.col("id").alias("b"))
    labels = star_components(links)
    rest = materialise(remaining_links(content, points, members, labels, text, width, percent), "rest")
    if not rest.isEmpty():
        labels = star_components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(rest))
    named = points.select("id", "same", "first_id", "copies").join(labels.withColumnRenamed("node", "id"), "id", "left") \
        .withColumn("label", F.coalesce("label", "id"))
    lowest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    table = materialise(named.join(lowest, "label").select("same", "copies", "component_id"), "components")
    placed = join_by_weight(rows.where("n > 0"), table, "same", "copies", rows.count()).select("doc_id", "n", "component_id")
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return placed.unionByName(empty).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

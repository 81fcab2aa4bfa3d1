"""Hierarchical residual packing of tokenised documents into fixed-length sequences (operator 10).

Round one runs where the documents are read: a task tokenises its documents, cuts only those longer
than a sequence, and packs the pieces best-fit. Nearly full sequences are final. The others become
items of the next round, in which several partitions meet in one (the tree) and whole underfull
sequences are packed best-fit again. A round has so many partitions that none holds more than a
fixed number of items, so no task ever sees the whole input; rounds end when a partition of that
size could hold everything left, or when a round no longer saves sequences.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import bounded_batches, carried, worker_store
from bramble.session import materialise

CAPACITY = 2048
#: a sequence with at most this many free places is final
SLACK = 4
#: items that one task packs at a time
ITEMS = 50_000
#: partitions that meet in one per round
FAN_IN = 8

PIECE = "doc_id string, piece int, start long, length long, ids_crc32 long"
BIN = f"fill int, final boolean, pieces array<struct<{PIECE.replace(' ', ':').replace(',:', ',')}>>"

#: words that a worker remembers
_CACHE = 600_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Ids of each text as little-endian unsigned 32-bit numbers, exactly as encoding it whole.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    words in turn; words are lower-cased (as the tokenizer does) and looked up in a table that the
    worker keeps. New words of letters only are encoded many at a time and told apart by the
    vocabulary's word-end marks. A text that may hold a special token's string is encoded whole.
    """
    import numpy as np
    from tokenizers import Tokenizer
    kept = worker_store(f"tokens:{path}")
    if "tokenizer" not in kept:
        tok = Tokenizer.from_file(path)
        ends = np.zeros(tok.get_vocab_size(), bool)
        for token, number in tok.get_vocab().items():
            ends[number] = token.endswith("</w>")
        kept.update(tokenizer=tok, ids={}, ends=ends)
    tok, ids, ends = kept["tokenizer"], kept["ids"], kept["ends"]

    def packed(texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(words: list[bytes]) -> None:
        """Fill the table: a word with one comma or stop behind it is the word and the mark."""
        plain, other, tailed = {}, {}, []
        for w in words:
            core = w[:-1] if w[-1] in b".," and len(w) > 1 and 97 <= w[-2] <= 122 else w
            if core is not w:
                tailed.append(w)
            if core not in ids:
                s = core.decode("utf-8", "surrogatepass")
                (plain if s.isalpha() else other)[core] = s
        keys, texts = list(plain), list(plain.values())
        blocks = range(0, len(keys), 256)
        for lo, e in zip(blocks, tok.encode_batch_fast([" ".join(texts[lo:lo + 256]) for lo in blocks],
                                                       add_special_tokens=False)):
            found = np.asarray(e.ids, "<u4")
            stops = np.flatnonzero(ends[found]) + 1
            block = keys[lo:lo + 256]
            if len(stops) != len(block):
                other.update((k, plain[k]) for k in block)
                continue
            data, edges = found.tobytes(), [0, *(4 * stops).tolist()]
            ids.update((k, data[i:j]) for k, i, j in zip(block, edges, edges[1:]))
        marks = {b".": ".", b",": ","}
        other.update((k, v) for k, v in marks.items() if k not in ids)
        ids.update(zip(other, packed(list(other.values()))))
        ids.update((w, ids[w[:-1]] + ids[w[-1:]]) for w in tailed)

    def encode(texts: list[str]) -> list[bytes]:
        if len(ids) > _CACHE:
            ids.clear()
        out: list = [None] * len(texts)
        later, fresh, special = [], set(), []
        for k, text in enumerate(texts):
            data = text.encode("utf-8", "surrogatepass")
            if b"<|" in data:
                special.append(k)
                continue
            words = data.lower().split()
            found = list(map(ids.get, words))
            if None in found:
                gaps = [at for at, f in enumerate(found) if f is None]
                later.append((k, words, found, gaps))
                fresh.update([words[at] for at in gaps])
            else:
                out[k] = b"".join(found)
        learn(list(fresh))
        for k, words, found, gaps in later:
            for at in gaps:
                found[at] = ids[words[at]]
            out[k] = b"".join(found)
        for k, e in zip(special, packed([texts[k] for k in special])):
            out[k] = e
        return out

    return encode


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """Bin number of each length: each goes, longest first, to the fullest bin that still has room."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, place, bins = 0, [0] * len(lengths), 0
    for i in order:
        size = lengths[i]
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = heapq.heappop(by_room[room])
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, chosen, bins = capacity, bins, bins + 1
        place[i] = chosen
        if room > size:
            heapq.heappush(by_room[room - size], chosen)
            open_rooms |= 1 << (room - size)
    return place


def _packed(items: list[tuple[int, list]], capacity: int, slack: int) -> pd.DataFrame:
    """Items ``(length, pieces)`` to rows of BIN; the order of items decides nothing but ties."""
    items.sort(key=lambda x: (-x[0], x[1][0][0] or "", x[1][0][1:]))
    bins: dict[int, list] = {}
    for item, b in zip(items, best_fit([x[0] for x in items], capacity)):
        bins.setdefault(b, []).append(item)
    fills = [sum(x[0] for x in b) for b in bins.values()]
    return pd.DataFrame({"fill": fills, "final": [f >= capacity - slack for f in fills],
                         "pieces": [[p for x in b for p in x[1]] for b in bins.values()]},
                        columns=["fill", "final", "pieces"])


def pieces_of(encoded: bytes, doc_id, capacity: int, end_id: int = 0) -> list[tuple]:
    """Cut one document's ids (its end mark included) into pieces of at most ``capacity``."""
    data = encoded + end_id.to_bytes(4, "little")
    n = len(data) // 4
    return [(doc_id, k, start, min(capacity, n - start),
             zlib.crc32(data[4 * start:4 * (start + capacity)]))
            for k, start in enumerate(range(0, n, capacity))]


def pack_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                   capacity: int = CAPACITY, slack: int = SLACK, items: int = ITEMS, fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every piece and its place.

    Null and empty texts are documents of the end mark alone; repeated rows are packed each; null
    ids stay null; other columns are ignored. Offsets in a sequence are gapless from 0. Sequence
    ids are distinct but not consecutive. Every round is a written table, so a lost executor
    never mixes two packings.
    """
    bounded_batches(docs.sparkSession)
    path = tokenizer or tokenizer_path()

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, held = word_encoder(path), []
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            ids = [i if isinstance(i, str) else None for i in batch["doc_id"]]
            for i, encoded in zip(ids, encode(texts)):
                parts = pieces_of(encoded, i, capacity)
                held.extend((p[3], [p]) for p in parts)
            if len(held) >= items:
                yield from _chunks(held, capacity, slack)
                held = []
        yield from _chunks(held, capacity, slack)

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for batch in batches:
            held.extend((int(f), [tuple(p.values()) if isinstance(p, dict) else tuple(p) for p in ps])
                        for f, ps in zip(batch["fill"], batch["pieces"]))
            if len(held) >= items:
                yield from _chunks(held, capacity, slack)
                held = []
        yield from _chunks(held, capacity, slack)

    source = docs.select(carried(doc_id), F.col(text).alias("text"))
    level = materialise(source.mapInPandas(first, BIN), "bins")
    rounds = [level.where("final")]
    rest = level.where("not final")
    open_bins, parts = rest.count(), max(1, source.rdd.getNumPartitions())
    while open_bins > 1 and parts > 1:
        parts = max(-(-parts // fan_in), -(-open_bins // items))
        level = materialise(_dealt(rest, parts).mapInPandas(again, BIN), "bins")
        rounds.append(level.where("final"))
        rest = level.where("not final")
        made = level.count()
        if made == open_bins and parts == -(-open_bins // items):
            break
        open_bins = rest.count()
    rounds.append(rest)
    packed = rounds[0]
    for done in rounds[1:]:
        packed = packed.unionByName(done)
    numbered = packed.select(F.monotonically_increasing_id().alias("sequence_id"), "pieces")
    before = F.aggregate(F.slice("pieces", 1, F.col("pos")), F.lit(0).cast("long"), lambda a, p: a + p["length"])
    return numbered.select("sequence_id", "pieces", F.posexplode("pieces").alias("pos", "p")) \
        .select(F.col("p.doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"), "p.piece", "p.start", "p.length",
                "p.ids_crc32", "sequence_id", before.alias("offset"))


def _chunks(held: list, capacity: int, slack: int) -> Iterator[pd.DataFrame]:
    """Pack what is held and hand it over in small batches."""
    if held:
        made = _packed(held, capacity, slack)
        for lo in range(0, len(made), 2000):
            yield made.iloc[lo:lo + 2000]


def _dealt(rest: DataFrame, parts: int) -> DataFrame:
    """Several partitions into one; equal first pieces of many rows spread by the other columns."""
    return rest.repartition(parts, F.xxhash64("fill", "pieces"))


def token_sequences(placed: DataFrame, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids``: the packed sequences as token ids, for documents with unique ids.

    Documents are tokenised again and meet their places by id, so packing carries no ids around.
    """
    bounded_batches(docs.sparkSession)
    path = tokenizer or tokenizer_path()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        encode = word_encoder(path)
        for batch in batches:
            rows = []
            for i, e in zip(batch["doc_id"], encode([t if isinstance(t, str) else "" for t in batch["text"]])):
                ids = np.append(np.frombuffer(e, "<u4"), 0).astype("int32")
                rows.extend((i, k, ids[s:s + capacity]) for k, s in enumerate(range(0, len(ids), capacity)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "ids"])

    tokens = docs.select(carried(doc_id), F.col(text).alias("text")) \
        .mapInPandas(cut, "doc_id string, piece int, ids array<int>") \
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
    held = placed.select("doc_id", "piece", "sequence_id", "offset").join(tokens, ["doc_id", "piece"])
    return held.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")) \
        .select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))

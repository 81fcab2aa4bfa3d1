"""Periodic runs of words by an online sparse diagonal DP (operator 12).

A run is a maximal stretch of words with smallest period q and a length of at least
``max(SHORTEST, TURNS * q)``. Word i matches on the diagonal of lag q if it equals word i - q; a
stretch of period q is a stretch of matches on that diagonal, q words shorter. A document is read
once, word by word: the active lags' match lengths grow by one or the lag ends, and a lag that ends
with sufficient length emits its run. The earlier occurrences of the word open new lags.

Not every earlier occurrence needs to. Let 2^k <= q < 2^(k+1). A run has at least 3q matches in a
row, among them a word number divisible by 2^(k+1) with q // 2 matches on both sides. So word i opens
only lags below the largest power of two that divides it, and only those with such a neighbourhood;
the matches before i are then counted backwards. Word numbers with large powers are rare: a text of
n words looks at n log n earlier occurrences at most, however often a word is repeated.

A lag whose last q words have already a period that divides q holds no run of smallest period q as
long as it goes on, so it is closed, and few lags are active at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.llm.common import bounded_batches, carried

SHORTEST, TURNS = 6, 4

Run = tuple[int, int, int]


def _divided(q: int) -> list[int]:
    """q over each of its prime factors: every proper divisor of q divides one of these."""
    found, rest, prime = [], q, 2
    while prime * prime <= rest:
        if rest % prime == 0:
            found.append(q // prime)
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return found + [q // rest] if rest > 1 else found


def _shorter_period(words: Sequence, start: int, q: int) -> bool:
    """Whether a stretch of period q has a smaller one: of 2q words or more, only a divisor of q can be."""
    return any(words[start + d:start + q] == words[start:start + q - d] for d in _divided(q))


def _matches(words: Sequence, i: int, q: int, half: int) -> bool:
    """Whether the words up to ``half`` places before and after word i all match at lag q; near ones are tried first."""
    done, size = 0, 4
    while done <= half:
        upto = min(done + size, half + 1)
        if words[i + done:i + upto] != words[i + done - q:i + upto - q] \
                or words[i - upto + 1:i - done + 1] != words[i - upto + 1 - q:i - done + 1 - q]:
            return False
        done, size = upto, 8 * size
    return True


def periodic_runs(words: Sequence) -> list[Run]:
    """``(start, length, period)`` of every run, by start, then period."""
    n, last, runs = len(words), {}, []
    before = [-1] * n  # the previous occurrence of each word
    active: dict[int, int] = {}  # lag: matches in a row so far

    def end(q: int, length: int, stop: int) -> None:
        whole = length + q
        if whole >= SHORTEST and whole >= TURNS * q and not _shorter_period(words, stop - whole, q):
            runs.append((stop - whole, whole, q))

    for i, word in enumerate(words):
        if active:
            for q in [q for q in active if words[i - q] != word]:
                end(q, active.pop(q), i)
            for q in active:
                active[q] += 1
        j = last.get(word, -1)
        last[word] = i
        if j < 0:
            continue
        before[i] = j
        reach = i & -i
        while 0 <= j and i - j < reach:
            q, j = i - j, before[j]
            if q in active:
                continue
            half = q // 2
            if i - half < q or i + half >= n or any(q % d == 0 and held >= q - d for d, held in active.items()):
                continue
            if not _matches(words, i, q, half):
                continue
            length = half + 1
            while i - length >= q and words[i - length] == words[i - length - q]:
                length += 1
            active[q] = length
            for longer in [m for m in active if m > q and m % q == 0 and length >= m - q]:
                del active[longer]
    for q, length in active.items():
        end(q, length, n)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words outside every run's part after its first period."""
    if not runs:
        return list(words)
    kept, at = [], 0
    for lo, hi in sorted((start + q, start + length) for start, length, q in runs):
        if hi > at:
            kept.extend(words[at:max(at, lo)])
            at = hi
    return kept + list(words[at:])


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else []


def run_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", with_text: bool = False,
               change: Callable[[str | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """The runs of every row: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256``, and ``runs`` and ``collapsed_text`` if asked for.

    The four numbers describe the longest run (then the first, then the one of smallest period) and
    are null without one. Null and empty texts have no words. Repeated rows are reported each, null
    ids stay null, other columns are ignored. ``change`` maps a row's id (as text) and words to the
    words that are searched.
    """
    bounded_batches(docs.sparkSession)

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, value in zip(batch["doc_id"], batch["_text"]):
                i = i if isinstance(i, str) else None
                words = words_of(value)
                if change:
                    words = change(i, words)
                runs = periodic_runs(words)
                best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
                listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
                left = b" ".join(collapsed(words, runs))
                row = [i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                       hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()]
                rows.append(row + [runs, left.decode("utf-8", "surrogatepass")] if with_text else row)
            yield pd.DataFrame(rows, columns=names, dtype=object)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    shape = "doc_id string, n_runs long, start long, length long, period long, exponent_milli long, " \
            "runs_sha256 string, collapsed_sha256 string"
    if with_text:
        names += ["runs", "collapsed_text"]
        shape += ", runs array<struct<start:long,length:long,period:long>>, collapsed_text string"
    return docs.select(carried(doc_id), F.col(text).alias("_text")).mapInPandas(report, shape) \
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def planted_tail(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents get a periodic tail that the crc32 of the id determines; without an id none."""
    import zlib
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(doc_id.encode()), len(words)
    if h % 10:
        return words
    a, g = h // 10 % n, h // 10
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]

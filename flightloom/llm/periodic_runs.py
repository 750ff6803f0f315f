"""Stretches of words that repeat with a period, found by minimizers at several scales."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import whole_text

LEAST_WORDS = 24  # a run has at least so many words
LEAST_REPEATS = 3  # and at least so many periods
SCANNED = 16  # periods up to this one are found by comparing the words at each lag
CHUNK_WORDS = 1 << 18  # words that are searched together; a longer text is searched alone

FOUND = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "strongest struct<start: long, length: long, period: long>, collapsed binary"
)
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)),
        ("strongest", _RUN), ("collapsed", pa.binary()),
    ]
)

Run = tuple[int, int, int]  # start, length, period


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each ordered pair."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(values: np.ndarray, width: int, smaller) -> np.ndarray:
    """The extreme of every ``width`` neighbours, from extremes of 1, 2, 4 ... neighbours."""
    reach, out = 1, values
    while reach * 2 <= width:
        out = smaller(out[:-reach], out[reach:])
        reach *= 2
    return out if reach == width else smaller(out[: len(out) - (width - reach)], out[width - reach :])


def _selected(names: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least name of at least one window of ``width`` places."""
    if len(names) < width:
        return np.empty(0, dtype=np.int64)
    least = _sliding(names, width, np.minimum)
    edge = np.zeros(width - 1, dtype=names.dtype)
    highest = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(highest == names)


def _stretch(codes: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The places around ``at`` whose word equals the word ``lag`` further on: [first, end)."""
    end, step, last = at, 64, len(codes) - lag
    while end < last:
        other = codes[end : min(end + step, last)] != codes[end + lag : min(end + step, last) + lag]
        if other.any():
            end += int(other.argmax())
            break
        end, step = end + len(other), step * 2
    first, step = at, 64
    while first > 0:
        low = max(first - step, 0)
        other = codes[low:first] != codes[low + lag : first + lag]
        if other.any():
            first -= int(other[::-1].argmax())
            break
        first, step = low, step * 2
    return first, end


def _scanned(codes: np.ndarray, lag: int, need: int) -> Iterator[Run]:
    """Runs of one short period: ``need`` words in all."""
    differ = np.flatnonzero(codes[lag:] != codes[:-lag])
    bounds = np.concatenate([[-1], differ, [len(codes) - lag]])
    same = np.diff(bounds) - 1
    for i in np.flatnonzero(same >= need - lag):
        yield int(bounds[i]) + 1, int(same[i]) + lag, lag


def _seeded(codes: np.ndarray, names: dict, low: int, high: int) -> Iterator[Run]:
    """Stretches of a period in (low, high], grown from equal minimizers.

    Inside a run of period q the names of q or more words recur at distance q and at no shorter one. A
    run of three periods holds two windows q apart, and both have their least name at the same place:
    two neighbouring selected places of one name, q apart.
    """
    width = 2 * low + 3 - high
    reach = 1 << (high.bit_length() - 1)
    while reach not in names:
        known = max(names)
        names[known * 2] = _mixed(names[known][:-known], names[known][known:])
        del names[known]
    part = names[reach]
    grams = part if reach == high else _mixed(part[: len(part) - (high - reach)], part[high - reach :])
    places = _selected(grams, width)
    order = np.argsort(grams[places], kind="stable")
    places = places[order]
    lags = np.diff(places)
    near = np.flatnonzero((grams[places[1:]] == grams[places[:-1]]) & (lags > low) & (lags <= high))
    seeds = sorted(zip(lags[near].tolist(), places[:-1][near].tolist()))
    done = (0, 0)  # lag and end of the stretch before
    for lag, at in seeds:
        if done[0] == lag and at < done[1]:
            continue
        first, end = _stretch(codes, at, lag)
        done = (lag, end)
        yield first, end - first + lag, lag


def runs_of(codes: np.ndarray, longest: int, least_words: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> list[Run]:
    """All runs among word numbers; ``longest`` is the length of the longest text among them.

    A stretch that also repeats with a shorter period counts with that period only: the shorter one is
    found as well, as a stretch with the same bounds.
    """
    found: dict[tuple[int, int], int] = {}

    def note(runs: Iterator[Run]) -> None:
        for start, length, period in runs:
            if length >= max(least_words, repeats * period):
                found[start, length] = min(period, found.get((start, length), period))

    for lag in range(1, min(SCANNED, longest // repeats) + 1):
        note(_scanned(codes, lag, max(least_words, repeats * lag)))
    names = {1: _mixed(codes.astype(np.uint64), np.uint64(1))}
    low = SCANNED
    while repeats * (low + 1) <= longest and longest >= least_words:
        high = low + low // 2
        if high > len(codes):
            high = len(codes)
        note(_seeded(codes, names, low, high))
        low = high
    return sorted((start, length, period) for (start, length), period in found.items())


def _chunks(texts: list[list[bytes]]) -> Iterator[list[int]]:
    """Numbers of texts of similar length that are searched together."""
    chunk: list[int] = []
    size = 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if chunk and size + len(texts[i]) > CHUNK_WORDS:
            yield chunk
            chunk, size = [], 0
        chunk.append(i)
        size += len(texts[i]) + 1
    if chunk:
        yield chunk


def _search(texts: list[list[bytes]], chunk: list[int], least_words: int, repeats: int) -> dict[int, list[Run]]:
    """Runs of each text of a chunk. Between two texts stands a word number that occurs once."""
    words = [w for i in chunk for w in texts[i]]
    numbers, different = pd.factorize(np.fromiter(words, dtype=object, count=len(words)))
    lengths = np.array([len(texts[i]) for i in chunk])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    codes = np.empty(starts[-1], dtype=np.int64)
    codes[starts[1:] - 1] = len(different) + np.arange(len(chunk))
    inside = np.ones(len(codes), dtype=bool)
    inside[starts[1:] - 1] = False
    codes[inside] = numbers
    found: dict[int, list[Run]] = {}
    for start, length, period in runs_of(codes, int(lengths.max(initial=0)), least_words, repeats):
        k = int(np.searchsorted(starts, start, side="right")) - 1
        found.setdefault(chunk[k], []).append((start - int(starts[k]), length, period))
    return found


def _collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those after the first period of a run, joined by one space."""
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def find_runs(docs: DataFrame, least_words: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> DataFrame:
    """For every row of ``docs``: doc_id, n_words, runs, strongest, collapsed.

    Words are what stands between ASCII blanks. A run is a stretch of words with smallest period q and
    at least ``least_words`` words and ``repeats`` (three or more) periods, that no neighbouring word
    extends. ``strongest`` has the greatest length / period, compared exactly; ties take the smallest start, then
    period; null without runs. ``collapsed`` keeps one period of each run.

    A null or empty text has no words, no runs and an empty collapsed text. Rows that repeat and null
    ids are treated like any row; extra columns are ignored; an empty table gives an empty result. A
    text is searched whole, however long, in time about n log n; nothing is shuffled.
    """
    if repeats < LEAST_REPEATS:
        raise ValueError("the windows hold for three or more periods")

    def search(batches):
        for batch in batches:
            texts = [t.split() for t in batch.column("text").to_pylist()]
            runs: dict[int, list[Run]] = {}
            for chunk in _chunks(texts):
                runs |= _search(texts, chunk, least_words, repeats)
            rows = [
                {
                    "n_words": len(words),
                    "runs": [dict(zip(("start", "length", "period"), r)) for r in runs.get(i, [])],
                    "strongest": None,
                    "collapsed": _collapsed(words, runs[i]) if i in runs else b" ".join(words),
                }
                for i, words in enumerate(texts)
            ]
            for i in runs:
                rows[i]["strongest"] = min(
                    rows[i]["runs"], key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"])
                )
            columns = [pa.array([r[f.name] for r in rows], f.type) for f in list(_FOUND)[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=_FOUND)

    rows = docs.select(F.col("doc_id").cast("long"), whole_text().cast("binary").alias("text"))
    return rows.mapInArrow(search, FOUND).withColumn("collapsed", F.col("collapsed").cast("string"))

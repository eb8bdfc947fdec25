"""Removal of repeated byte strings by a distributed merge sort of suffixes that knows common prefixes.

A window is ``length`` consecutive bytes.  Every window has one anchor, the leftmost of its ``gram``-byte strings with the smallest hash, so
equal windows have anchors at the same offset.  An anchor stands for the stretch of neighbouring windows that share it: the
suffix that begins at the anchor, up to the end of the last window, and before it the bytes from the first window on, read backwards.  Only anchors
whose gram occurs more than once can hold a repeated window; their suffixes are sorted.

Each task sorts its suffixes into runs and front-codes them (length of the prefix shared with the one before, then the rest).  The runs are cut
into ranges of the gram's hash (of its low bits) and exchanged.  A range's runs are merged by a loser tree that keeps, for every head, the length of
its common prefix with the last winner: heads are compared beyond it only, and not at all where these lengths differ.  The merge hands on
each suffix with its prefix shared with the suffix before; equal suffixes become one entry with many places.

Entries of one gram stand together in that order.  A window is repeated if another entry of the gram (or another place of the same one) shares its
bytes after the anchor and before it.  Shared lengths after the anchor are minima of those the merge found.  Grams with more than
``hot`` different suffixes are left out of the runs; their windows are counted by digest instead, which any number of tasks share.
"""

from __future__ import annotations

from collections import Counter
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import discard, join_same, materialize, ship, small

LENGTH, GRAM, HOT, RANGE_PLACES, RUN_BYTES, CHUNK = 400, 100, 50_000, 40_000, 24_000_000, 1 << 20
#: Grams with up to this many entries are compared entry by entry, larger ones offset by offset.
FEW = 24
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2 ** 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_BYTES = _powers(0xD1342543DE82EF95, 257)[1:] ^ _powers(0xBF58476D1CE4E5B9, 257)[1:]
_UP, _DOWN = _powers(_BASE, CHUNK + 4096), _powers(_INVERSE, CHUNK + 4096)


def _anchors(b: np.ndarray, length: int, gram: int):
    """(anchor, first window, last window, gram hash) for the windows of at most CHUNK + length bytes."""
    n = len(b) - gram + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTES[b] * _UP[:len(b)], out=sums[1:])
        h = (sums[gram:] - sums[:n]) * _DOWN[:n]
        h ^= h >> np.uint64(31)
        h *= _MIX
    # the smallest hash, then the leftmost place, over all grams of a window
    low = (h & _HIGH) | np.arange(n, dtype=np.uint64)
    width, w = 1, length - gram + 1
    while 2 * width <= w:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if w > width:
        low = np.minimum(low[:width - w], low[w - width:])
    at = (low & _LOW).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], first, np.append(first[1:], len(at)) - 1, h[at[first]].view(np.int64)


def anchors(data: bytes, length: int, gram: int):
    """(anchor, first window, last window, gram hash) for all windows of a text; long texts go piece by piece."""
    b = np.frombuffer(data, np.uint8)
    parts = []
    for lo in range(0, len(b) - length + 1, CHUNK):
        at, first, last, h = _anchors(b[lo:lo + CHUNK + length - 1], length, gram)
        parts.append((at + lo, first + lo, last + lo, h))
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two strings whose first ``at`` bytes are known to be equal."""
    n, step = min(len(a), len(b)), 32
    while at < n:
        x, y = a[at:at + step], b[at:at + step]
        if x != y:
            m = min(len(x), len(y))
            diff = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
            return at + m - (diff.bit_length() + 7) // 8
        at += step
        step *= 4
    return n


class Run:
    """A sorted run being read: its head, and what comes after it."""

    __slots__ = ("keys", "shared", "values", "i", "head", "known")

    def __init__(self, keys, shared, values):
        self.keys, self.shared, self.values, self.i, self.known = keys, shared, values, 0, 0
        self.head = keys[0] if keys else None


def merge(runs: list[Run]):
    """(shared, key, value) of all entries in order of their keys; ``shared`` is the common prefix with the key before.

    A loser tree: inner node k has the loser of the match between its children; ``known`` of a head is its common prefix with the last
    winner, and a loser keeps its common prefix with the one that beat it."""
    size = 1
    while size < len(runs):
        size *= 2
    entrants = runs + [Run([], [], [])] * (size - len(runs))

    def play(a: Run, b: Run):
        """(winner, loser)"""
        if b.head is None:
            return a, b
        if a.head is None:
            return b, a
        if a.known != b.known:  # the longer one is closer to the last winner, which is smaller than both
            return (a, b) if a.known > b.known else (b, a)
        m = common(a.head, b.head, a.known)
        x, y = a.head[m:m + 1], b.head[m:m + 1]
        if x <= y:
            b.known = m
            return a, b
        a.known = m
        return b, a

    losers: list[Run] = [None] * size
    level = entrants
    while len(level) > 1:
        half = len(level) // 2
        won = []
        for k in range(half):
            w, losers[half + k] = play(level[2 * k], level[2 * k + 1])
            won.append(w)
        level = won
    best = level[0]
    place = {id(r): k for k, r in enumerate(entrants) if r.keys}
    while best.head is not None:
        yield best.known, best.head, best.values[best.i]
        best.i += 1
        if best.i < len(best.keys):
            best.head, best.known = best.keys[best.i], best.shared[best.i]
        else:
            best.head = None
        k = (place[id(best)] + size) // 2
        while k:
            best, losers[k] = play(best, losers[k])
            k //= 2


def encode(keys: list[bytes], after: list[int], places: list[list[tuple[bytes, int, int, int]]]) -> bytes:
    """A front-coded run: sorted keys, the length of each part after the anchor, and the (ref, anchor, first, last) of its places."""
    shared = [0, *(common(a, b, 0) for a, b in zip(keys, keys[1:], strict=False))][:len(keys)]
    flat = [p for ps in places for p in ps]
    head = np.array([len(keys), len(flat)], np.int64).tobytes()
    counts = np.array([shared, [len(k) for k in keys], after, [len(ps) for ps in places]], np.int32).tobytes()
    spots = np.array([p[1:] for p in flat], np.int64).tobytes()
    rest = b"".join(k[s:] for k, s in zip(keys, shared, strict=True))
    return zstandard.ZstdCompressor(level=1).compress(head + counts + spots + b"".join(p[0] for p in flat) + rest)


def decode(blob: bytes) -> Run:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(data, np.int64, 2).tolist()
    shared, sizes, after, counts = (x.tolist() for x in np.frombuffer(data, np.int32, 4 * n, 16).reshape(4, n))
    at = 16 + 16 * n
    spots = np.frombuffer(data, np.int64, 3 * m, at).reshape(m, 3).tolist()
    at += 24 * m
    refs = [data[at + 16 * k:at + 16 * k + 16] for k in range(m)]
    at += 16 * m
    keys, values, last, k = [], [], b"", 0
    for s, size, a, c in zip(shared, sizes, after, counts, strict=True):
        last = last[:s] + data[at:at + size - s]
        at += size - s
        keys.append(last)
        values.append((a, [(refs[j], *spots[j]) for j in range(k, k + c)]))
        k += c
    return Run(keys, shared, values)


class Entry:
    """A suffix of one gram: the bytes after the anchor, those before it (backwards), its places."""

    __slots__ = ("after", "before", "places", "shared", "low", "high", "found")

    def __init__(self, key: bytes, after: int, places, shared: int, length: int):
        self.after, self.before = key[8:8 + after], key[8 + after:]
        self.places, self.shared = list(places), shared  # shared: bytes that the entry before begins with too
        self.low, self.high = length - len(self.after), len(self.before)  # offsets of the windows
        self.found: set[int] = set()  # offsets of windows that another entry has


def mark(entries: list[Entry], length: int) -> None:
    """Find the offsets o at which a window of an entry, o bytes before the anchor and length - o after it, stands in another entry.
    Entries with several places need none."""
    open_ones = [e for e in entries if len(e.places) == 1]
    if not open_ones:
        return
    if len(entries) <= FEW:
        for i, a in enumerate(entries):
            shared = 1 << 30
            for b in entries[i + 1:]:
                shared = min(shared, b.shared)
                if length - shared > a.high:
                    break
                if len(a.places) > 1 < len(b.places):
                    continue
                low, high = length - min(shared, len(a.after), len(b.after)), common(a.before, b.before, 0)
                for e in (a, b):
                    e.found.update(range(max(low, e.low), min(high, e.high) + 1))
        return
    for o in range(min(e.low for e in open_ones), max(e.high for e in open_ones) + 1):
        able = [e for e in entries if len(e.before) >= o and len(e.after) >= length - o]
        windows = [(hash(e.after[:length - o]), hash(e.before[:o])) for e in able]
        often = Counter(windows)
        same: dict[tuple, list[Entry]] = {}
        for e, w in zip(able, windows, strict=True):
            if often[w] > 1:
                same.setdefault((e.after[:length - o], e.before[:o]), []).append(e)
        for es in same.values():
            if len(es) > 1:
                for e in es:
                    if e.low <= o <= e.high:
                        e.found.add(o)


def stretches(e: Entry):
    """Maximal runs (lowest, highest) of the offsets of repeated windows."""
    if len(e.places) > 1:
        return [(e.low, e.high)]
    out = []
    for o in sorted(e.found):
        if out and out[-1][1] == o - 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    return out


def spans_of(blobs, length: int):
    """(ref, lo, hi): the bytes of repeated windows, by place, from the runs of one range."""
    def gram(entries):
        mark(entries, length)
        for e in entries:
            for lo, hi in stretches(e):
                for ref, anchor, _, _ in e.places:
                    yield ref, anchor - hi, anchor - lo + length

    entries: list[Entry] = []
    last = None
    for shared, key, (after, places) in merge([decode(b) for b in blobs]):
        if last is not None and shared == len(key) == len(last) and len(entries[-1].after) == after:
            entries[-1].places += places
            continue
        if entries and shared < 8:  # another gram
            yield from gram(entries)
            entries = []
        entries.append(Entry(key, after, places, shared - 8, length))
        last = key
    if entries:
        yield from gram(entries)


def _ref(text: Column) -> Column:
    return F.unhex(F.md5(text))


def distinct_rows(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """(ref, text) of the first document of every text."""
    d = docs.select(F.col("doc_id").alias("_id"), _ref(F.coalesce("text", F.lit(""))).alias("ref"), "text")
    out = d.join(small(repeated.select(F.col("ref").alias("_ref"), "first")), F.col("ref") == F.col("_ref"), "left")
    return out.where(F.col("_ref").isNull() | F.col("_id").eqNullSafe(F.col("first"))).select("ref", "text")


def joined(spans) -> list[list[int]]:
    """Maximal runs of the union of (lo, hi)."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def all_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(ref, h, same, anchor, first, last) of the anchors of ``texts`` (ref, text); ``same`` is a hash of the anchor's whole stretch.

    Stretches that occur more than once in a text (the many of a periodic one, say) are repeated already: the first of them stands for
    all, and rows without ``h`` hold the bytes that they cover, from ``first`` up to ``last``."""
    def run(batches):
        for b in batches:
            parts = []
            for i, text in enumerate(b.column(1)):
                data = (text.as_py() or "").encode()
                at, first, last, h = anchors(data, length, gram)
                if not len(at):
                    continue
                same = np.array([xxhash.xxh3_64_intdigest(data[x:y]) for x, y in zip(first.tolist(), (last + length).tolist(), strict=True)],
                                np.uint64).view(np.int64)
                _, lead, group, often = np.unique(same, return_index=True, return_inverse=True, return_counts=True)
                if len(lead) < len(at):
                    own = np.flatnonzero(often[group] > 1)
                    spans = np.array(joined(zip(first[own].tolist(), (last[own] + length).tolist(), strict=True)), np.int64)
                    none = np.zeros(len(spans), np.int64)
                    parts.append((np.full(len(spans), i), np.ones(len(spans), bool), none, none, none, spans[:, 0], spans[:, 1]))
                    keep = np.sort(lead)
                    at, first, last, h, same = (x[keep] for x in (at, first, last, h, same))
                parts.append((np.full(len(at), i), np.zeros(len(at), bool), h, same, at, first, last))
            if parts:
                row, no, *cols = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.record_batch([b.column(0).take(pa.array(row)), *[pa.array(c, mask=no if k < 3 else None) for k, c in enumerate(cols)]],
                                      ["ref", "h", "same", "anchor", "first", "last"])

    return texts.mapInArrow(run, "ref binary, h bigint, same bigint, anchor bigint, first bigint, last bigint")


def runs(texts: DataFrame, length: int, ranges: int) -> DataFrame:
    """(range, run): front-coded sorted runs of the suffixes of ``texts`` (ref, text, spots)."""
    def cut(entries: dict):
        by_range: dict[int, list] = {}
        for key in sorted(entries):
            # the low bits: the high ones are small, as anchors are minima
            by_range.setdefault(int.from_bytes(key[0][4:8], "big") * ranges >> 32, []).append(key)
        for r, keys in by_range.items():
            yield r, encode([k for k, _ in keys], [a for _, a in keys], [entries[k] for k in keys])

    def run(batches):
        entries: dict[tuple[bytes, int], list] = {}
        held = 0

        def flush():
            rows = list(cut(entries))
            return pa.record_batch([pa.array([r for r, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["range", "run"])

        for b in batches:
            ends = b.column(2).offsets.to_numpy()
            fields = [x.to_numpy(zero_copy_only=False) for x in b.column(2).values.flatten()]
            for i, (ref, text) in enumerate(zip(b.column(0), b.column(1), strict=True)):
                data, ref = (text.as_py() or "").encode(), ref.as_py()
                for h, at, first, last in zip(*(x[ends[i]:ends[i + 1]].tolist() for x in fields), strict=True):
                    end = last + length
                    key = (h % 2 ** 64).to_bytes(8, "big") + data[at:end] + data[first:at][::-1]
                    mine = entries.setdefault((key, end - at), [])
                    held += 40 + (len(key) if not mine else 0)
                    mine.append((ref, at, first, last))
                    if held > RUN_BYTES:
                        yield flush()
                        entries, held = {}, 0
        if entries:
            yield flush()

    return texts.select("ref", "text", "spots").mapInArrow(run, "range int, run binary")


def hot_windows(texts: DataFrame, length: int) -> DataFrame:
    """(ref, lo, hi) of the repeated windows at the spots of ``texts`` (ref, text, spots), by counting digests."""
    def run(batches):
        for b in batches:
            for ref, text, spots in zip(*(b.column(i) for i in range(3)), strict=True):
                data, ref = (text.as_py() or "").encode(), ref.as_py()
                for s in spots.as_py():
                    at = list(range(s["first"], s["last"] + 1))
                    yield pa.record_batch([pa.array([blake2b(data[i:i + length], digest_size=16).digest() for i in at], pa.binary()),
                                           pa.array([ref] * len(at), pa.binary()), pa.array(at, pa.int64())], ["w", "ref", "lo"])

    rows = materialize(texts.select("ref", "text", "spots").mapInArrow(run, "w binary, ref binary, lo bigint"))
    often = materialize(rows.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w"))
    return rows.join(small(often), "w").select("ref", "lo", (F.col("lo") + length).alias("hi"))


def repeated_spans(docs: DataFrame, repeated: DataFrame, length: int, gram: int, hot: int):
    """((ref, lo, hi) of the repeated bytes of every distinct text, overlapping and in any order; the tables that it reads)."""
    found = materialize(all_anchors(distinct_rows(docs, repeated), length, gram))
    out = found.where("h IS NULL").select("ref", F.col("first").alias("lo"), F.col("last").alias("hi"))
    stretches = found.where("h IS NOT NULL")
    grams = stretches.groupBy("h", "same").agg(F.count("*").alias("n")).groupBy("h").agg(
        F.sum("n").alias("n"), F.count("*").alias("entries")).where("n > 1")
    grams = materialize(grams.select("h", (F.col("entries") > hot).alias("hot"), "n"))
    total = grams.agg(F.sum("n"), F.max("hot")).first()
    if not total[0]:
        return out, [found, grams]
    ranges = max(1, -(-total[0] // RANGE_PLACES))
    spots = materialize(stretches.join(small(grams, 1_000_000), "h").groupBy(F.col("ref").alias("_ref"), "hot").agg(
        F.collect_list(F.struct("h", "anchor", "first", "last")).alias("spots")))
    both = distinct_rows(docs, repeated).join(small(spots), F.col("ref") == F.col("_ref")).select("ref", "text", "spots", "hot")

    def merged(pdf):
        import pandas as pd

        return pd.DataFrame(list(spans_of([bytes(x) for x in pdf["run"]], length)), columns=["ref", "lo", "hi"])

    out = out.unionByName(runs(both.where("NOT hot"), length, ranges).groupBy("range").applyInPandas(merged, "ref binary, lo bigint, hi bigint"))
    return out.unionByName(hot_windows(both.where("hot"), length)) if total[1] else out, [found, grams, spots]


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, texts: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, any others) with ``kept`` (the bytes that stay), n_bytes, n_removed, n_spans and kept_sha256 added; they
    replace columns of those names, whatever their case.  ``texts=False`` leaves out ``text`` and ``kept``.

    Bytes covered by a string of ``length`` bytes that also starts anywhere else go, also where the two overlap or stand in one
    document; none is the first that stays.  Null texts are empty.  Every row is a document of its own: repeated rows, of one id or of
    several, go whole if they are long enough.  Texts are bytes, so a span may cut a character.  Very long texts are read whole, by pieces
    of windows.  An empty table gives no rows."""
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    repeated = materialize(docs.where(F.octet_length("text") >= length).groupBy(_ref(text).alias("ref")).agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    spans, used = repeated_spans(docs, repeated, length, gram, hot)
    own = repeated.select("ref", F.lit(True).alias("whole"), F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>").alias("spans"))
    some = spans.groupBy("ref").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    some = some.join(small(repeated.select("ref")), "ref", "left_anti")
    gone = materialize(own.unionByName(some.select("ref", F.lit(False).alias("whole"), "spans")))
    discard(repeated, *used)
    new = ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    keep = [c for c in docs.columns if c.lower() not in (*new, "text")]
    rows = docs.select(F.struct(*keep).alias("row"), _ref(text).alias("ref"), "text")
    rows = join_same(rows, small(gone.withColumnRenamed("ref", "of")), {"ref": "of"}, "left").select("row", "text", "whole", "spans")

    def cut(batches):
        for b in batches:
            kept, digests, figures = [], [], []
            for text, whole, spans in zip(*(b.column(i) for i in (1, 2, 3)), strict=True):
                data = (text.as_py() or "").encode()
                pieces, at, removed, n = [], 0, 0, 0
                for lo, hi in [(0, len(data))] if whole.as_py() else joined((s["lo"], s["hi"]) for s in spans.as_py() or []):
                    pieces.append(data[at:lo])
                    at, removed, n = hi, removed + hi - lo, n + 1
                left = b"".join([*pieces, data[at:]]) if n else data
                digests.append(sha256(left).hexdigest())
                figures.append((len(data), removed, n))
                if texts:
                    kept.append(left)
            yield pa.record_batch([
                b.column(0), *([b.column(1), pa.array(kept, pa.binary())] if texts else []),
                *[pa.array([f[k] for f in figures], pa.int64()) for k in range(3)], pa.array(digests, pa.string())],
                ["row", *(["text", "kept"] if texts else []), *new[1:]])

    kind = rows.schema["row"].dataType.simpleString()
    more = "text string, kept binary, " if texts else ""
    out = rows.mapInArrow(cut, f"row {kind}, {more}n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.select("row.*", *(["text", "kept"] if texts else []), *new[1:])


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), texts=False)

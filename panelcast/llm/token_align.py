"""Alignment of two tokenizers over the same text.

Tokenizer A reads space + text, tokenizer B the text (it adds the space), so the tokens of both spell the same bytes.  The ends of the
tokens of many parts stand in one ascending array for either side; a search of A's ends (and starts) in B's tells which tokens end
together, which cuts both into groups, and from which B token to which an A token is linked.

Neither tokenizer joins anything across the place before a single space that stands between other characters, so a text is a chain of chunks
that begin there; a chunk is cut again after letters whose next character no piece of B has behind a letter, and after single line ends.
Each task aligns a part once, thousands of new parts at a time, and keeps parts and chunks in tables of bounded size; a document is
the sum of its chunks.
The documents of every id pair are counted by task first, then by Spark; the counts come back by a join on the pair.
"""

from __future__ import annotations

import gc
import os
import re
from hashlib import sha256
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import discard, materialize, ship, small
from panelcast.llm.token_counts import tokenizer_path

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
CACHE_CHUNKS, PAIR_BATCH, PAIR_ROWS = 300_000, 2_000_000, 1_000_000
#: Parts that are aligned at a time.
PARTS = 16_384
#: White space by any of the libraries.
_SPACE = r"\s\x1c-\x1f\x85"
_CUT = re.compile(rf"(?<=[^ ]) (?=[^{_SPACE}])")
_UNEVEN = re.compile(rf" (?:[{_SPACE}]|$)|^[{_SPACE}]")
#: Characters that may begin a part behind an ASCII letter, if B's pieces allow it.
_BREAKS = "\n!\"#$%&()*+,-./:;<=?@[]^_`{|}~"


def byte_alphabet() -> dict[str, int]:
    """Characters of the byte-level alphabet: visible Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Ids of both tokenizers, and the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(alphabet[c] for c in piece) for piece, i in vocabulary.items()
                        if all(c in alphabet for c in piece)}
        self.a_ids = self._by_ranks(a_path, vocabulary) or (
            lambda parts: [x.ids for x in self.a.encode_batch(parts, add_special_tokens=False)])
        self.b_size = self.b.get_piece_size()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i in range(self.b_size) for p in [self.b.id_to_piece(i)]]
        a_size = max(self.a_bytes) + 1
        self.a_long = np.array([len(self.a_bytes.get(i, b"")) for i in range(a_size)], np.int64)
        self.b_long = np.array([len(x) for x in self.b_bytes], np.int64)
        # an id as it is shown inside a group and at the end of its side, for A, then for B
        self.names = [np.array([f"{i}{c}" for c in ends for i in range(n)], object) for ends, n in ((",|", a_size), (",;", self.b_size))]
        self.name_long = [np.array([len(x) for x in names], np.int64) for names in self.names]

        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        held = {y for p in pieces for x, y in zip(p, p[1:], strict=False) if x.isascii() and x.isalpha()}
        breaks = "".join(re.escape(c) for c in _BREAKS if c not in held)
        self._part = re.compile(rf"(?<=[A-Za-z])(?=[{breaks}])|(?<=[^{_SPACE}]\n)(?=[A-Za-z])")
        # what stands before a part that does not begin with a space, and its tokens, which are cut off again
        self._lead = [(x, len(self.b.encode(x))) for x in ("a", "\n")]

    def _by_ranks(self, path: str, vocabulary: dict[str, int]):
        """A's ids of parts by the faster library, where ids are ranks: its file lists the merges in the order of the ids they make, after
        256 bytes, and cuts texts by the byte-level pattern without a space of its own.  None otherwise."""
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        cut = told["pre_tokenizer"] or {}
        if (cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or told["normalizer"]
                or [vocabulary.get(x + y) for x, y in merges] != list(range(256, 256 + len(merges)))):
            return None
        ranks = {word: i for i, word in self.a_bytes.items() if i < 256 + len(merges)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda parts: [fast.encode_ordinary(p) for p in parts]

    def parts(self, chunk: str) -> list[str]:
        """A chunk (without its first space) cut where neither tokenizer joins anything; the first part gets the space back."""
        if chunk.isalpha():
            return [" " + chunk]
        first, *rest = self._part.split(chunk)
        return [" " + first, *rest]

    def encode(self, parts: list[str]):
        """(A's ids, B's ids) of all parts, each with the number of ids of every part."""
        a = self.a_ids(parts)
        lead = [("", 0) if p[0] == " " else self._lead[p[0].isalpha()] for p in parts]
        b = self.b.encode([x + p if x else p[1:] for p, (x, _) in zip(parts, lead, strict=True)], num_threads=1)
        return [_flat(a), _flat([y[n:] if n else y for y, (_, n) in zip(b, lead, strict=True)])]


def _flat(lists: list[list[int]]):
    """All numbers of the lists in order, and the lists' lengths."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the first n[0] values, the next n[1], and so on; 0 of none."""
    upto, end = np.concatenate([[0], np.cumsum(values)]), np.cumsum(n)
    return upto[end] - upto[end - n]


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] numbers), then the same for the next."""
    return np.arange(n.sum()) + np.repeat(start - np.cumsum(n) + n, n)


def spelt(ids: np.ndarray, n: np.ndarray, tokens, long: np.ndarray, whole: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Which of the strings ``whole`` the tokens of their n[i] ids spell; ``long`` are the lengths of ``tokens``."""
    right = _sums(long[ids], n) == sizes
    told = b"".join(map(tokens.__getitem__, ids[np.repeat(right, n)].tolist()))
    same = b"".join(compress(whole, right.tolist()))
    if told != same:
        other = np.flatnonzero(np.frombuffer(told, np.uint8) != np.frombuffer(same, np.uint8))
        right[np.flatnonzero(right)[np.searchsorted(np.cumsum(sizes[right]), other, "right")]] = False
    return right


def align(of: Tokenizers, parts: list[str]):
    """(shown, figures, pairs): of every part its groups with a ; behind each, and n_a, n_b, n_groups, n_links and 1, or "" and zeros where
    the tokens of a side do not spell it; then the linked id pairs of all parts in order, as a * size of B + b."""
    whole = [p.encode() for p in parts]
    sizes = np.fromiter(map(len, whole), np.int64, len(whole))
    (a, n_a), (b, n_b) = of.encode(parts)
    alike = spelt(a, n_a, of.a_bytes, of.a_long, whole, sizes) & spelt(b, n_b, of.b_bytes, of.b_long, whole, sizes)
    a, b, n_a, n_b = a[np.repeat(alike, n_a)], b[np.repeat(alike, n_b)], n_a[alike], n_b[alike]
    # both sides spell the same bytes, part after part: ends are places in all of them
    a_end, b_end = np.cumsum(of.a_long[a]), np.cumsum(of.b_long[b])
    first, last = np.searchsorted(b_end, a_end - of.a_long[a], "right"), np.searchsorted(b_end, a_end)
    n = last - first + 1
    pairs = np.repeat(a, n) * of.b_size + b[_ranges(first, n)]
    a_cut, b_cut = b_end[last] == a_end, np.zeros(len(b), bool)
    b_cut[last[a_cut]] = True
    figures = np.zeros((len(parts), 5), np.int64)
    figures[alike] = np.stack([n_a, n_b, _sums(a_cut, n_a), _sums(n, n_a), np.ones(len(n_a), np.int64)], 1)
    # a group's A tokens stand behind the B tokens of the groups before, its B tokens behind the A tokens of its own too
    a_upto, b_upto = (np.concatenate([[0], np.flatnonzero(cut) + 1]) for cut in (a_cut, b_cut))
    a_at = np.arange(len(a)) + b_upto[np.cumsum(a_cut) - a_cut]
    b_at = np.arange(len(b)) + a_upto[np.cumsum(b_cut) - b_cut + 1]
    names, long = np.empty(len(a) + len(b), object), np.empty(len(a) + len(b), np.int64)
    for k, (at, ids, cut) in enumerate(((a_at, a, a_cut), (b_at, b, b_cut))):
        code = ids + cut * (len(of.names[k]) // 2)
        names[at], long[at] = of.names[k][code], of.name_long[k][code]
    text, ends = "".join(names.tolist()), np.zeros(len(parts), np.int64)
    ends[alike] = _sums(long, n_a + n_b)
    ends = np.cumsum(ends).tolist()
    return [text[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)], figures, pairs


def chunks_of(text: str) -> list[str]:
    """The chunks of space + text, each without its first space."""
    return _CUT.split(text) if _UNEVEN.search(text) else text.split(" ")


class Table:
    """Aligned parts, and chunks by number with what they hold."""

    def __init__(self, tokenizers: Tokenizers):
        self.of = tokenizers
        self.clear()

    def clear(self):
        # what is shown, figures and pairs as align() gives them: of the parts, then of the chunks
        self.part: dict[str, int] = {}
        self.part_shown: list[str] = []
        self.part_figures, self.part_pairs = np.zeros((0, 5), np.int64), np.zeros(0, np.int64)
        self.number: dict[str, int] = {}
        self.shown: list[str] = []
        self.figures, self.pairs = np.zeros((0, 5), np.int64), np.zeros(0, np.int64)

    def add(self, chunks):
        """Align the chunks that are not in the table yet.  The many small lists make no cycles: looking for them would take half the time."""
        gc.disable()
        try:
            self._add(list(set(chunks).difference(self.number)))
        finally:
            gc.enable()

    def _add(self, chunks: list[str]):
        if not chunks:
            return
        cut = list(map(self.of.parts, chunks))
        parts = list(set(chain.from_iterable(cut)).difference(self.part))
        found = [align(self.of, parts[lo:lo + PARTS]) for lo in range(0, len(parts), PARTS)]
        self.part.update(zip(parts, range(len(self.part), len(self.part) + len(parts)), strict=True))
        self.part_shown += chain.from_iterable(f[0] for f in found)
        self.part_figures = np.concatenate([self.part_figures, *(f[1] for f in found)])
        self.part_pairs = np.concatenate([self.part_pairs, *(f[2] for f in found)])

        own, n = _flat([[self.part[p] for p in c] for c in cut])
        self.number.update(zip(chunks, range(len(self.number), len(self.number) + len(chunks)), strict=True))
        shown, at = list(map(self.part_shown.__getitem__, own.tolist())), 0
        for k in n.tolist():
            self.shown.append(shown[at] if k == 1 else "".join(shown[at:at + k]))
            at += k
        of_parts, sizes = self.part_figures[own], self.part_figures[:, 3]
        figures = np.add.reduceat(of_parts, np.cumsum(n) - n)
        figures[:, 4] = figures[:, 4] == n
        self.figures = np.concatenate([self.figures, figures])
        self.pairs = np.concatenate([self.pairs, self.part_pairs[_ranges((np.cumsum(sizes) - sizes)[own], of_parts[:, 3])]])


def _summed(keys: np.ndarray, values: np.ndarray):
    """Distinct keys, sorted, with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


_tables: dict[tuple[str, str], Table] = {}


def table(a_file: str, b_file: str) -> Table:
    key = (a_file, b_file)
    if key not in _tables:
        _tables[key] = Table(Tokenizers(tokenizer_path(a_file), tokenizer_path(b_file)))
    return _tables[key]


def aligned(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row of ``docs`` (doc_id, text): ``pairs`` are
    the linked id pairs as a * size of B + b, ``times`` their links."""

    def run(batches):
        t = table(a_file, b_file)
        for batch in batches:
            if max(len(t.shown), len(t.part)) > CACHE_CHUNKS:
                t.clear()
            out = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")}
            texts, lo = batch.column(1), 0
            while lo < len(texts):
                # pieces of a batch, so that few chunks wait at a time
                part, held, hi = [], 0, lo
                while hi < len(texts) and (held < 4_000_000 or hi == lo):
                    text = texts[hi].as_py()
                    part.append([] if not text or MARK in text else chunks_of(text))
                    held += len(text or "")
                    hi += 1
                lo = hi
                t.add(set().union(*part))
                figures, sizes, flat = t.figures, t.figures[:, 3], t.pairs
                start = np.cumsum(sizes) - sizes
                for chunks in part:
                    numbers = list(map(t.number.__getitem__, chunks))
                    own, often = np.unique(np.array(numbers, np.int64), return_counts=True)
                    if not len(own) or not figures[own, 4].all():
                        row = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
                    else:
                        n = sizes[own]
                        shown = sha256("".join(map(t.shown.__getitem__, numbers))[:-1].encode()).hexdigest()
                        row = (*(often @ figures[own, :4]).tolist(), shown, *_summed(flat[_ranges(start[own], n)], np.repeat(often, n)))
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in out["pairs"]])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*out[c], np.zeros(0, np.int64)]).astype(kind)))
                     for c, kind in (("pairs", np.int64), ("times", np.int32))]
            yield pa.record_batch([batch.column(0), *[pa.array(out[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                                   pa.array(out["groups_sha256"], pa.string()), *lists], ["doc_id", *out])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, (
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count) over ``rows`` (pairs, distinct in a row): the number of rows that hold each.  Tasks add up their own rows first."""
    def run(batches):
        waiting, n = [], 0

        def summed():
            pairs, docs = np.unique(np.concatenate([w[0] for w in waiting]), return_inverse=True)
            return pairs, np.bincount(docs, np.concatenate([w[1] for w in waiting]), len(pairs)).astype(np.int64)

        for b in batches:
            flat = b.column(0).flatten().to_numpy(zero_copy_only=False)
            if len(flat):
                waiting.append(np.unique(flat, return_counts=True))
                n += len(waiting[-1][0])
            if n > PAIR_BATCH:
                waiting = [summed()]
                n = len(waiting[0][0])
                if n > PAIR_BATCH // 2:
                    yield pa.record_batch([pa.array(waiting[0][0]), pa.array(waiting[0][1])], ["pair", "count"])
                    waiting, n = [], 0
        if n:
            pairs, docs = summed()
            yield pa.record_batch([pa.array(pairs), pa.array(docs)], ["pair", "count"])

    parts = rows.select("pairs").mapInArrow(run, "pair bigint, count bigint")
    return parts.groupBy("pair").agg(F.sum("count").alias("count"))


def alignments(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (doc_id, text; others are ignored).

    Texts that are null or empty, or whose tokens of either side do not spell space + text (those that hold U+2581, or what B
    normalises), have no tokens: zeros and an empty ``groups_sha256``.  Every row is a document of its own in the counts, also rows
    with equal ids or texts; ties for the highest count of an A id are all best.  Texts of any length are aligned whole.  An
    empty table gives no rows.  The counts are broadcast up to 1,000,000 pairs, joined by shuffle above."""
    import sentencepiece

    ship(docs.sparkSession)
    b_size = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(b_file)).get_piece_size()
    rows = materialize(aligned(docs, a_file, b_file).withColumn("row", F.monotonically_increasing_id()))
    counts = materialize(pair_counts(rows))
    a_id = F.expr(f"pair div {b_size}")
    best = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("top"))
    marked = materialize(counts.withColumn("a", a_id).join(best, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best")))
    discard(counts)
    links = rows.where("n_links > 0").select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    per = links.join(small(marked, PAIR_ROWS), F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("bigint").alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    return rows.join(per, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"), "groups_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    return alignments(spark.read.parquet(f"{sf_dir}/documents.parquet"))

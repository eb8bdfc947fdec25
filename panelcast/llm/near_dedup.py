"""Near-duplicate classes by ProbMinHash.

A text is its runs of five lower-case words, weighted by how often they occur.  Every run sends out exponential
arrivals at a rate equal to its weight, each to a random register; a register keeps the run that arrives
first, and a text is done as soon as no later arrival can win (early termination).  Two texts agree in a register with
the probability Jaccard similarity of their weighted runs.  Bands of registers propose candidates, and exact
probability Jaccard similarity on whole texts verifies them.

Texts with equal words are one node.  In a bucket all members are compared with one leader and links become
classes, so that a group of n copies takes about n comparisons.  Then the members outside the bucket's largest
class are compared with all members of other classes, pairs of small buckets as rows and large buckets block by block,
where only links that join classes come out as rows.  Both ways are exact: every candidate pair that could join two
classes is compared, or ruled out by a bound on its similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import join_same, let, materialize, passing, ship, small, words

SHINGLE, THRESHOLD, BANDS, ROWS, SEED, BLOCK_WORDS = 5, 0.8, 20, 5, 11, 400_000
#: Buckets up to this size are joined row by row; rows of a block.
SMALL_BUCKET, BLOCK_ROWS = 16, 256
#: A run of words is known by this many bits of its hash; the rest of 64 number the texts of a block.
RUN_BITS = 48
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _scramble(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + _MIX[0] * np.uint64(salt + 1)
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


def shingles(word_hashes: np.ndarray, lengths: np.ndarray, n: int = SHINGLE):
    """(text, run, weight) of every distinct run of ``n`` words of texts given one after the other, sorted; a
    shorter text is one run."""
    start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    runs = np.where(lengths >= n, lengths - n + 1, np.minimum(lengths, 1))
    text = np.repeat(np.arange(len(lengths)), runs)
    first = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(start, runs)
    size = np.minimum(lengths, n)[text]
    w = _scramble(word_hashes.astype(np.int64, copy=False).view(np.uint64), 0)
    h = np.zeros(len(first), np.uint64)
    for i in range(n):
        with np.errstate(over="ignore"):
            more = h * _MIX[1] + w[np.minimum(first + i, len(w) - 1)]
        h = np.where(i < size, more, h)
    # sorted by text, then by run: the text in the high bits, RUN_BITS of the run's hash below
    key = np.sort((text.astype(np.uint64) << np.uint64(RUN_BITS)) | (_scramble(h, n) >> np.uint64(64 - RUN_BITS)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key = key[at]
    return ((key >> np.uint64(RUN_BITS)).astype(np.int64), key & np.uint64(2 ** RUN_BITS - 1), np.diff(np.append(at, len(new))))


def signatures(text: np.ndarray, run: np.ndarray, weight: np.ndarray, n_texts: int, registers: int) -> np.ndarray:
    """The winning run of every register of every text; texts without runs keep zeros."""
    best = np.full(n_texts * registers, np.inf)
    winner = np.zeros(n_texts * registers, np.uint64)
    time = np.zeros(len(run))
    alive, limit, turn = np.arange(len(run)), np.full(n_texts, np.inf), 0
    while len(alive):
        bits = _scramble(run[alive], SEED + 2 * turn)
        gap = -np.log1p(-(bits >> np.uint64(11)).astype(float) / 2 ** 53)
        time[alive] += gap / weight[alive]
        register = (_scramble(bits, SEED + 2 * turn + 1) % np.uint64(registers)).astype(np.int64)
        slot = text[alive] * registers + register
        np.minimum.at(best, slot, time[alive])
        won = best[slot] == time[alive]
        winner[slot[won]] = run[alive[won]]
        touched = np.unique(text[alive])
        limit[touched] = best.reshape(n_texts, registers)[touched].max(1)
        alive = alive[time[alive] < limit[text[alive]]]
        turn += 1
    return winner.reshape(n_texts, registers)


def band_keys(winners: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(winners), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(winners), b, np.uint64)
        for r in range(rows):
            h = _scramble(h ^ winners[:, b * rows + r], b)
        keys[:, b] = h
    return keys.view(np.int64)


def probability_jaccard(run_a, weight_a, run_b, weight_b) -> float:
    """Exact probability Jaccard similarity of two weighted sets given as sorted runs and weights."""
    _, ia, ib = np.intersect1d(run_a, run_b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    wa, wb = np.asarray(weight_a, float), np.asarray(weight_b, float)
    x, y = wa[ia], wb[ib]
    only_a, only_b, total = wa.sum() - x.sum(), wb.sum() - y.sum(), 0.0
    for ratio in np.unique(x / y):
        mine = x / y == ratio
        total += (x[mine] / (only_a + ratio * only_b + np.maximum(x, ratio * y).sum())).sum()
    return float(total)


def _pieces(lengths: np.ndarray, most: int):
    """Slices of consecutive texts with about ``most`` words each."""
    group = np.cumsum(lengths + most / 2 ** (64 - RUN_BITS)) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    return zip([0, *cuts], [*cuts, len(lengths)], strict=True)


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _digest(hashes: Column) -> Column:
    """16 bytes that stand for the sequence of words."""
    return F.unhex(F.md5(F.array_join(F.transform(hashes, lambda h: h.cast("string")), " ")))


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, raw, node, n_words, keys) of every row of ``docs`` (doc_id, text)."""
    def run(batches):
        for b in batches:
            lists = b.column(b.schema.get_field_index("hs"))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            ends, out = np.cumsum(lengths), []
            for lo, hi in _pieces(lengths, BLOCK_WORDS):
                first = ends[lo] - lengths[lo]
                t, h, w = shingles(flat[first:ends[hi - 1]], lengths[lo:hi])
                out.append(band_keys(signatures(t, h, w, hi - lo, bands * rows), bands, rows))
            keys = np.concatenate(out) if out else np.empty((0, bands), np.int64)
            offsets = np.arange(len(keys) + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), pa.ListArray.from_arrays(offsets, keys.ravel())],
                ["doc_id", "raw", "node", "n_words", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    d = docs.select("doc_id", F.xxhash64("text").alias("raw"),
                    F.explode(F.array(let(_word_hashes(F.col("text")), lambda h: F.struct(
                        _digest(h).alias("node"), h.alias("hs"))))).alias("s"))
    d = d.select("doc_id", "raw", "s.node", F.size("s.hs").alias("n_words"), "s.hs")
    return d.mapInArrow(run, f"doc_id {kind}, raw bigint, node binary, n_words int, keys array<bigint>")


def _weighted(texts: DataFrame) -> DataFrame:
    """(node, runs, weights) from (node, text)."""
    def run(batches):
        for b in batches:
            lists = b.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            ends = np.cumsum(lengths)
            for lo, hi in _pieces(lengths, BLOCK_WORDS):
                t, h, w = shingles(flat[ends[lo] - lengths[lo]:ends[hi - 1]], lengths[lo:hi])
                offsets = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=hi - lo))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(offsets, h.view(np.int64)),
                     pa.ListArray.from_arrays(offsets, w.astype(np.int32))], ["node", "runs", "weights"])

    return texts.select("node", _word_hashes(F.col("text")).alias("hs")).mapInArrow(
        run, "node binary, runs array<bigint>, weights array<int>")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts reach the threshold."""
    def run(batches):
        for batch in batches:
            cols = [batch.column(i) for i in range(6)]
            good = []
            for i in range(batch.num_rows):
                ra, wa, rb, wb = (cols[k][i].values.to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
                ra, rb = ra.view(np.uint64), rb.view(np.uint64)
                good.append(probability_jaccard(ra, wa, rb, wb) >= threshold - 1e-12)
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([cols[0].filter(keep), cols[1].filter(keep)], ["a", "b"])

    # the member's text first: it moves once; then the leaders', many pairs to one text
    b = texts.select(F.col("node").alias("b"), F.col("runs").alias("rb"), F.col("weights").alias("wb"))
    a = texts.select(F.col("node").alias("a"), F.col("runs").alias("ra"), F.col("weights").alias("wa"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "ra", "wa", "rb", "wb")
    return both.mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the smallest node it is linked to over any number of steps.

    Contraction: every label takes the smallest label next to it, until no link joins two labels."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.where("a != b").distinct())
    labels = materialize(edges.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")))
    while not edges.isEmpty():
        step = small(materialize(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))))
        labels = materialize(labels.join(step.withColumnRenamed("a", "label"), "label", "left")
                             .select("node", F.coalesce("to", "label").alias("label")))
        left = edges.join(step, "a").select(F.col("to").alias("x"), F.col("b").alias("a"))
        edges = materialize(left.join(step, "a").select(F.col("x").alias("a"), F.col("to").alias("b"))
                            .where("a != b").distinct())
    return labels


def block_links(a: dict, b: dict, threshold: float, columns: int = 8192):
    """(i, j) of the links between two lists of texts, each a dict of lists ``label``, ``runs``, ``weights``; pairs of one
    label are left out.

    Products of matrices give for all pairs the weight of the common runs on either side.  Its smaller share of the
    text's whole weight is an upper bound of the similarity, as no run adds more than its share of either text; pairs whose
    bound reaches the threshold are compared exactly.  Where every run occurs once, the products themselves
    give the similarity, |a & b| / |a | b|."""
    least = threshold - 1e-12
    _, labels = np.unique(np.array([bytes(x) for x in (*a["label"], *b["label"])], dtype=object), return_inverse=True)
    apart = labels[:len(a["label"]), None] != labels[None, len(a["label"]):]
    sets = [[np.asarray(r) for r in x["runs"]] for x in (a, b)]
    weights = [[np.asarray(w, float) for w in x["weights"]] for x in (a, b)]
    whole = [np.array([w.sum() for w in side]) for side in weights]
    plain = [np.array([w.max(initial=1) == 1 for w in side]) for side in weights]
    rows = [np.repeat(np.arange(len(side)), [len(r) for r in side]) for side in sets]
    flat, heavy = [np.concatenate(side) for side in sets], [np.concatenate(side) for side in weights]
    common = np.intersect1d(*flat)
    held = [np.zeros(apart.shape), np.zeros(apart.shape)]
    for lo in range(0, len(common), columns):
        part, once, full = common[lo:lo + columns], [], []
        for values, row, w, side in zip(flat, rows, heavy, sets, strict=True):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[at] == values
            m = np.zeros((len(side), len(part)), np.float32)
            m[row[hit], at[hit]] = 1
            once.append(m)
            if w[hit].max(initial=1) == 1:
                full.append(m)
            else:
                full.append(m.copy())
                full[-1][row[hit], at[hit]] = w[hit]
        mine = full[0] @ once[1].T
        held[0] += mine
        held[1] += mine if full[0] is once[0] and full[1] is once[1] else once[0] @ full[1].T
    shares = np.minimum(held[0] / whole[0][:, None], held[1] / whole[1][None])
    maybe = apart & (shares >= least)
    both = plain[0][:, None] & plain[1][None]
    similar = held[0] / (whole[0][:, None] + whole[1][None] - held[0])
    return [(i, j) for i, j in np.argwhere(maybe & both & (similar >= least))] + [
        (i, j) for i, j in np.argwhere(maybe & ~both)
        if probability_jaccard(sets[0][i], weights[0][i], sets[1][j], weights[1][j]) >= least]


def _other_links(now: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between classes in ``now`` (key, node, label), the buckets with members of several classes."""
    per = now.groupBy("key", "label").agg(F.count("*").alias("n"))
    top = materialize(per.groupBy("key").agg(F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("top"),
                                             (F.sum("n") - F.max("n")).alias("minor")))
    m = now.join(top, "key")
    few = m.where(F.col("n") <= SMALL_BUCKET).select("key", "node", "label")
    pairs = few.join(few.select("key", F.col("node").alias("_node"), F.col("label").alias("_label")), "key").where(
        "label != _label AND node < _node").select(F.col("node").alias("a"), F.col("_node").alias("b")).distinct()
    many = m.where(F.col("n") > SMALL_BUCKET).select(
        "key", "node", "label", "top",
        F.ceil(F.col("minor") / BLOCK_ROWS).cast("int").alias("lefts"), F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("rights"))
    many = materialize(many.join(texts, "node"))
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sides = {"a": many.where("label != top").withColumn("l", block("lefts")).withColumn("r", each("rights")),
             "b": many.withColumn("l", each("lefts")).withColumn("r", block("rights"))}
    left, right = (df.select(*[F.col(c).alias(f"{side}_{c}") for c in ("key", "l", "r", "node", "label", "runs", "weights")])
                   for side, df in sides.items())

    def compare(x, y):
        import pandas as pd

        a, b = ({c: df[f"{side}_{c}"].to_list() for c in ("node", "label", "runs", "weights")} for side, df in (("a", x), ("b", y)))
        if not a["node"] or not b["node"]:
            return pd.DataFrame({"a": [], "b": []})
        # links that join what the block's earlier links have not joined yet
        joined: dict[bytes, bytes] = {}

        def root(c):
            while joined.get(c, c) != c:
                c = joined[c]
            return c

        found = []
        for i, j in block_links(a, b, threshold):
            x1, x2 = root(bytes(a["label"][i])), root(bytes(b["label"][j]))
            if x1 != x2:
                joined[max(x1, x2)] = min(x1, x2)
                found.append((bytes(a["node"][i]), bytes(b["node"][j])))
        return pd.DataFrame(found, columns=["a", "b"])

    big = left.groupBy("a_key", "a_l", "a_r").cogroup(right.groupBy("b_key", "b_l", "b_r")).applyInPandas(compare, "a binary, b binary")
    return _verified(pairs, texts, threshold).unionByName(big)


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, raw, class_id, class_size, kept) of every row of ``docs`` (doc_id, text; others are ignored);
    ``raw`` is the text's xxhash64.

    ``class_id`` is the smallest doc_id of the class, ``class_size`` its number of rows; ``kept`` marks the
    rows with that id.  Null, empty and wordless texts are classes of their own; a text of one to four words is one run of words.
    Repeated rows of an id and text come out alike.  A class whose ids are all null has a null
    ``class_id``.  An empty table gives no rows."""
    ship(docs.sparkSession)
    sketches = materialize(sketch(docs.select("doc_id", "text"), bands, rows))
    full = sketches.where("n_words > 0")
    nodes = materialize(full.groupBy("node").agg(F.min(F.struct("doc_id", "raw")).alias("rep"), F.first("keys").alias("keys")))
    spread = nodes.select("node", F.explode("keys").alias("key"))
    shared = spread.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("_last")).where("leader != _last")
    members = materialize(spread.join(shared.select("key", "leader"), "key"))
    texts = _candidate_texts(docs, nodes.join(members.select("node").distinct(), "node", "left_semi"))
    pairs = members.where("leader != node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(_verified(pairs, texts, threshold))
    labels = small(components(links))
    now = members.select("key", "node").join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label"))
    mixed = now.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo != _hi").select("key")
    now = materialize(now.join(mixed, "key", "left_semi"))
    more = _other_links(now, texts, threshold)
    labels = small(components(materialize(links.unionByName(more))))
    base = join_same(sketches, labels.withColumnRenamed("label", "_label"), ["node"], "left").select(
        "doc_id", "raw", "n_words", F.when(F.col("n_words") > 0, F.coalesce("_label", "node")).alias("class"))
    sums = base.where("n_words > 0").groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    own = base.where("n_words = 0").select("doc_id", "raw", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    out = base.where("n_words > 0").join(sums, "class").select("doc_id", "raw", "class_id", "class_size").unionByName(own)
    return out.select("*", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _candidate_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, runs, weights), one row per wanted node, from the text of its first document."""
    need = materialize(wanted.select("node", F.col("rep.doc_id").alias("_id"), F.col("rep.raw").alias("_raw")))
    d = docs.select("doc_id", F.xxhash64("text").alias("raw"), "text")
    mine = join_same(d, small(need), {"doc_id": "_id", "raw": "_raw"})
    return materialize(_weighted(mine.select("node", "text")).dropDuplicates(["node"]))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each class, the one with the smallest id; of repeated rows of it one.  Texts without words are
    classes of their own and stay; an empty table gives no rows; columns of any name are kept.  Only the choice stays in the shared folder."""
    with passing() as keep:
        chosen = keep(materialize(classes(docs).where("kept").groupBy("doc_id", "raw").agg(F.count("*").alias("rows"))))
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), "text")
    kept = join_same(own, small(chosen), {"id": "doc_id", "hash": "raw"})
    if chosen.where("rows > 1").isEmpty():
        return kept.select("row.*")
    once = kept.where("rows > 1").dropDuplicates(["id", "text"])
    return kept.where("rows = 1").unionByName(once).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("raw")

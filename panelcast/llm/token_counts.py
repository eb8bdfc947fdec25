"""Token counts by byte-pair merging with a heap and a linked list.

A vocabulary of scored pieces says which adjacent symbols may merge; the best-scored (lowest-ranked) pair
anywhere merges first, leftmost among equals, until none is left.  The count is the number of initial
symbols minus the merges, plus the extra bytes of characters that the vocabulary lacks; no token ids
are made.

No piece has a space mark behind another character, so nothing merges across the place before a space
mark: a text is the chain of its words (each with the space marks before it), and each task keeps the counts of the
words it has met in a table of bounded size.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import ship

MARK = "▁"
LIMIT, CACHE_WORDS, MODEL = 4096, 500_000, "piece_bpe_32k.model"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Ranks of the mergeable pieces of a piece model (0 merges first; equal scores share a rank)."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        rank = {s: n for n, s in enumerate(sorted({model.get_score(i) for i in ids}, reverse=True))}
        self.ranks = {model.id_to_piece(i): rank[model.get_score(i)] for i in ids}
        if any(MARK in piece.lstrip(MARK) for piece in self.ranks):
            raise ValueError("a piece goes on past the end of a word: texts can't be counted word by word")


def merge_count(symbols: str, ranks: dict[str, int]) -> int:
    """Number of tokens of one chain of characters."""
    n = len(symbols)
    piece, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(symbols[i:i + 2])) is not None]
    heapify(heap)
    merges = 0
    while heap:
        _, i, size = heappop(heap)
        j = after[i]
        # an entry is out of date if either side has merged since
        if not piece[i] or j >= n or len(piece[i]) + len(piece[j]) != size:
            continue
        piece[i] += piece[j]
        piece[j] = ""
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(piece[i] + piece[k])) is not None:
                heappush(heap, (r, i, len(piece[i]) + len(piece[k])))
        h = before[i]
        if h >= 0 and (r := ranks.get(piece[h] + piece[i])) is not None:
            heappush(heap, (r, h, len(piece[h]) + len(piece[i])))
    fallback = sum(len(p.encode()) - 1 for p in piece if len(p) == 1 and p not in ranks)
    return n - merges + fallback


class Counter(dict):
    """Tokens by word; words met for the first time are merged, and the table is emptied when full."""

    def __init__(self, ranks: dict[str, int], size: int = CACHE_WORDS):
        self.ranks, self.size = ranks, size

    def __missing__(self, word: str) -> int:
        if len(self) >= self.size:
            self.clear()
        n = merge_count(word, self.ranks)
        if len(word) <= 64:
            self[word] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        return sum(self[m[0]] for m in _WORD.finditer(marked)) if len(marked) > 1_000_000 else sum(
            map(self.__getitem__, _WORD.findall(marked)))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(Vocabulary(path).ranks)


def tokenizer_path(name: str = MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text; others are ignored).

    Null and empty texts have no bytes and no tokens; strings of special tokens are plain text; long
    texts are counted whole.  ``model`` names a file of the public tokenizers, found on each executor."""

    def run(batches):
        table = counter(tokenizer_path(model))
        for batch in batches:
            texts = batch.column(1)
            yield pa.record_batch([batch.column(0), pa.array([table.count(x.as_py()) for x in texts], pa.int64()),
                                   batch.column(2)], ["doc_id", "n_tokens", "n_bytes"])

    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, n_bytes bigint")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Ranked lexical search with the roles reversed: the queries are indexed, the documents stream by.

A block of items becomes an inverted index (term to the items that hold it), which every executor gets.
Documents pass it once: each one's term counts give its scores for all items of the block, and every task
keeps a heap of the best documents per item. The heaps are merged at the end, so no pair of a document
and an item leaves its task unless it is among that task's best.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.tables import arrow, saved

# What a term is, and the weights of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARE, SCALE = 75, 1_000_000_000

# Postings (different terms of items) of one index, about; items beyond it make further blocks.
POSTINGS = 500_000
# Scores and products that one step of a task holds.
CELLS = 2_000_000
# Bytes of text that are cut into terms at a time.
STRETCH = 1 << 20
# Tasks whose heaps meet in one group of the first merge.
MERGED = 512

# A byte that belongs to no term becomes a blank; bytes of longer characters belong to terms.
_BYTES = bytes(
    b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256)
)


@dataclass
class Index:
    """An inverted index of a block of items; ``weights`` come once the corpus is counted."""

    terms: list[bytes]
    starts: np.ndarray
    items: np.ndarray
    counts: np.ndarray
    item_ids: list[int | None]
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 0
    vocabulary: dict[bytes, int] = field(default_factory=dict)

    def numbers(self) -> dict[bytes, int]:
        if not self.vocabulary:
            self.vocabulary = {t: n for n, t in enumerate(self.terms)}
        return self.vocabulary

    def __getstate__(self):
        return self.__dict__ | {"vocabulary": {}}


def index_of(postings: pa.Table) -> Index:
    """``postings``: item_id, item (a digest of the whole item), term, count."""
    def numbered(column: str):
        coded = postings[column].combine_chunks().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    term, terms = numbered("term")
    item, digests = numbered("item")
    order = np.lexsort((item, term))
    ids = np.empty(len(digests), object)
    ids[item] = postings["item_id"].to_pylist()
    return Index(
        terms=[t.encode() for t in terms.to_pylist()],
        starts=np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))]),
        items=item[order],
        counts=postings["count"].to_numpy()[order].astype(np.int64),
        item_ids=ids.tolist(),
    )


def term_counts(text: bytes) -> tuple[int, Counter]:
    """How many terms a text has, and how often each."""
    if len(text) <= STRETCH:
        terms = text.translate(_BYTES).split()
        return len(terms), Counter(terms)
    n, counts, text, start = 0, Counter(), text.translate(_BYTES), 0
    while start < len(text):
        end = text.find(b" ", start + STRETCH)
        end = len(text) if end == -1 else end
        terms = text[start:end].split()
        n += len(terms)
        counts.update(terms)
        start = end
    return n, counts


def _counted(index) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = index.value.numbers()
        for batch in batches:
            lengths, ids, counts, ends, kept = [], [], [], [0], []
            for place, text in enumerate(batch["text"]):
                n, found = term_counts(text.as_py() or b"")
                if not n:
                    continue
                for term in numbers.keys() & found.keys():
                    ids.append(numbers[term])
                    counts.append(found[term])
                kept.append(place)
                lengths.append(n)
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(kept, pa.int64())), pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    return run


def _best(scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, floor: np.ndarray, most: int):
    """The best documents per item of a stretch: (document's place, item), best first within an item."""
    if len(scores) > most:
        floor = np.maximum(floor, np.partition(scores, -most, axis=0)[-most])
    doc, item = np.nonzero((scores >= floor) & (scores > 0))
    order = np.lexsort((ids[doc], missing[doc], -scores[doc, item], item))
    doc, item = doc[order], item[order]
    first = np.searchsorted(item, item, side="left")
    kept = np.arange(len(item)) - first < most
    return doc[kept], item[kept]


def _scored(index, most: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: Index = index.value
        width = len(x.item_ids)
        heaps: list[list[tuple]] = [[] for _ in range(width)]
        floor = np.zeros(width, np.int64)
        spread = np.diff(x.starts)
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = batch["terms"].offsets.to_numpy() - batch["terms"].offsets[0].as_py()
            terms = batch["terms"].flatten().to_numpy().astype(np.int64)
            found = batch["counts"].flatten().to_numpy().astype(np.int64)
            missing = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            ids = batch["doc_id"].fill_null(0).to_numpy()
            m = np.array([100 - SHARE + SHARE * n * x.documents // x.length for n in batch["n"].to_pylist()], np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            worth = x.weights[terms] * (SCALE * found // (1_000 * found + 8 * m[owner]))
            # Products up to each document, to cut the batch into stretches that fit.
            reach = np.concatenate([[0], np.cumsum(spread[terms])])[ends]
            start = 0
            while start < batch.num_rows:
                end = int(np.searchsorted(reach, reach[start] + CELLS, side="right")) - 1
                end = max(start + 1, min(end, start + max(1, CELLS // width), batch.num_rows))
                part = slice(ends[start], ends[end])
                often = spread[terms[part]]
                source = np.repeat(np.arange(len(often)), often)
                place = np.arange(len(source)) - np.repeat(np.cumsum(often) - often, often) + x.starts[terms[part]][source]
                scores = np.zeros((end - start) * width, np.int64)
                cell = (owner[part][source] - start) * width + x.items[place]
                np.add.at(scores, cell, worth[part][source] * x.counts[place])
                scores = scores.reshape(-1, width)
                for doc, item in zip(*_best(scores, ids[start:end], missing[start:end], floor, most)):
                    # Larger is better: a higher score, an id at all, a smaller id.
                    entry = (int(scores[doc, item]), not missing[start + doc], -int(ids[start + doc]))
                    heap = heaps[item]
                    if len(heap) < most:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == most:
                        floor[item] = heap[0][0]
                start = end
        rows = [
            (x.item_ids[item], item, -ident if known else None, score)
            for item, heap in enumerate(heaps) for score, known, ident in heap
        ]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "item", "doc_id", "score"])

    return run


def _postings(items: DataFrame) -> DataFrame:
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    item = items.select(F.col("item_id").cast("long"), F.sha2("text", 256).alias("item"), text.alias("text")).distinct()
    terms = item.select("item_id", "item", F.explode(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))).alias("term"))
    counted = terms.groupBy("item_id", "item", "term").agg(F.count(F.lit(1)).alias("count"))
    return counted.withColumn("item", F.concat_ws(":", F.coalesce(F.col("item_id").cast("string"), F.lit("")), "item"))


def _top(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _search(docs: DataFrame, postings: pa.Table, most: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    index = index_of(postings)
    counts = saved(
        arrow(docs, _counted(context.broadcast(index)), "doc_id long, n long, terms array<int>, counts array<int>"),
        "search-counts",
    )
    found = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect())
    total = counts.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    index.documents, index.length = total["documents"], total["length"]
    index.weights = np.array(
        [math.floor(1_000 * math.log((2 * index.documents + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(index.terms))],
        np.int64,
    )
    index.terms = []
    best = arrow(counts, _scored(context.broadcast(index), most), "item_id long, item int, doc_id long, score long")
    grouped = best.withColumn("tasks", F.floor(F.spark_partition_id() / MERGED))
    merged = _top(_top(grouped, ["item", "tasks"], most), ["item"], most)
    return merged.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, most: int = 10, block: int = POSTINGS) -> DataFrame:
    """The ``most`` documents of highest score per item: item_id, rank (from 1), doc_id, score.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored. Terms are runs of
    ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased. Equal scores go by ascending
    doc_id, documents without an id last; rows that repeat an id are documents of their own. A null or empty
    text has no terms, is no document for the statistics and never ranks. Equal items are one; an item id
    with several texts gives the ranking of each. Items without a term, empty tables and corpora without a
    term give no rows.

    Each block of items costs two passes: the first cuts the texts and writes their counts of the block's
    terms, which also give the terms' document counts; the second scores from what was written. Scores are
    64-bit integers throughout. The driver handles one block's postings (some ``block``; a single item of
    more makes a block alone) and their document counts, nothing of the documents.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    postings = saved(_postings(items), "search-postings")
    blocks = -(-postings.count() // block)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        own = postings.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()
        if own.num_rows:
            found = _search(read, own, most)
            out = found if blocks == 1 else out.union(found)
    return out

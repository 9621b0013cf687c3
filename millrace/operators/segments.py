"""Dictionary segmentation: words of a text that is written without blanks.

The dictionary words that occur in a text are the edges of a lattice over its letters; the best path has the least
cost, where a word costs the logarithm of how rare it is. The dictionary is sent to the tasks as a trie in two arrays; all
letters of a step walk down it side by side, and the path is dynamic programming over the words that they meet. Letters
and edges stay in the task: only the runs themselves go through an exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# What ends a run of letters; blanks don't.
NOT_RUN = "[^\\p{L}\\p{N}\\s]+"
# A letter that is no word costs what a word would that is so many times rarer than the rarest.
UNKNOWN = 10
# Letters that walk down the trie side by side. A longer run takes several steps.
STEP = 16_384
# Letters of all runs that one task cuts.
TASK_LETTERS = 1_000_000
# Bits of a letter in a trie's key, what stands behind a run, and the cost of a node where no word ends.
LETTER_BITS, END, NO_WORD = 21, 0x110000, np.iinfo(np.int64).max


def runs(text: Column) -> Column:
    """Lower-case runs of letters and digits, without the blanks in between; empty ones dropped."""
    joined = F.transform(F.split(F.lower(text), NOT_RUN), lambda r: F.regexp_replace(r, "\\s+", ""))
    return F.filter(joined, lambda r: r != "")


def dictionary(words: DataFrame, word: str = "word") -> DataFrame:
    """(word, size, cost) of the different words of a column of tokens; a word counts as often as it stands there.

    Cost is a thousand times the natural logarithm of total by count, rounded down.
    """
    counted = words.where(F.length(word) > 0).groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("n")).scalar()
    return counted.select(
        "word", F.length("word").alias("size"), F.floor(1000 * F.log(total / F.col("n"))).cast("bigint").alias("cost"),
        F.floor(1000 * F.log(total * F.lit(UNKNOWN))).cast("bigint").alias("unknown"),
    )


def _trie(words: list[str], costs: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The words as a trie: where each level of nodes begins, each node's key and the cost of the word that ends there.

    A key is the parent's number and the letter. Nodes are numbered from 1 by level and key, so a level's keys are sorted
    and a node's number follows from where its key stands; 0 is the root.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(sizes) - sizes
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    at, node = np.arange(len(words)), np.zeros(len(words), np.int64)
    bounds, keys, ends = [0], [], []
    while (more := sizes[at] >= len(bounds)).any():
        at, node = at[more], node[more]
        level, place = np.unique(node << LETTER_BITS | letters[first[at] + len(bounds) - 1], return_inverse=True)
        here = np.full(len(level), NO_WORD)
        ended = sizes[at] == len(bounds)
        np.minimum.at(here, place[ended], costs[at[ended]])
        node = bounds[-1] + place + 1
        keys.append(level)
        ends.append(here)
        bounds.append(bounds[-1] + len(level))
    nothing = np.empty(0, np.int64)
    return bounds, np.concatenate([nothing, *keys]), np.concatenate([nothing, *ends])


def _cutter(trie, unknown: int, step: int):
    """The function that cuts batches of runs. All that it needs is inside it, so executors don't import this package."""
    bits, end_mark, no_word = LETTER_BITS, END, NO_WORD

    def edges(codes: np.ndarray, low: int, high: int):
        """(start, end, cost) of the words and lone letters that start from ``low`` to ``high``, by start."""
        bounds, keys, costs = trie.value
        at = low + np.flatnonzero(codes[low:high] != end_mark)
        starts, ends, prices = [at], [at + 1], [np.full(len(at), unknown, np.int64)]
        node = np.zeros(len(at), np.int64)
        for size, (first, last) in enumerate(zip(bounds, bounds[1:]), 1):
            key = node << bits | codes[at + size - 1]
            place = first + np.searchsorted(keys[first:last], key)
            place[place == last] = first
            known = keys[place] == key
            at, place = at[known], place[known]
            if not len(at):
                break
            price, node = costs[place], place + 1
            word = price != no_word
            starts.append(at[word])
            ends.append(at[word] + size)
            prices.append(price[word])
        start = np.concatenate(starts)
        order = np.argsort(start, kind="stable")
        return start[order].tolist(), np.concatenate(ends)[order].tolist(), np.concatenate(prices)[order].tolist()

    def cut(runs: list[str]) -> list[list[str]]:
        """Of paths of equal cost the one with fewer words counts, then the one whose last word is longer."""
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        # A run's letters have a place each, and the mark behind them one more, where the run's paths end.
        firsts = np.cumsum(sizes + 1) - sizes - 1
        codes = np.full(int(sizes.sum()) + len(runs), end_mark, np.int64)
        letters = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)
        codes[np.arange(len(letters)) + np.repeat(np.arange(len(runs)), sizes)] = letters
        cost, count, back = [None] * len(codes), [0] * len(codes), [0] * len(codes)
        for first in firsts.tolist():
            cost[first] = 0
        # Edges come by their start, so what a path costs up to there is settled, and of two to one end the longer comes first.
        for low in range(0, len(codes), step):
            for start, end, price in zip(*edges(codes, low, low + step)):
                price += cost[start]
                least = cost[end]
                if least is None or price < least or (price == least and count[start] + 1 < count[end]):
                    cost[end], count[end], back[end] = price, count[start] + 1, start
        found = []
        for run, first in zip(runs, firsts.tolist()):
            words, end = [], first + len(run)
            while end > first:
                start = back[end]
                words.append(run[start - first : end - first])
                end = start
            found.append(words[::-1])
        return found

    def batches(stream):
        for batch in stream:
            runs, letters = [], 0
            for n, run in enumerate(batch.column(0).to_pylist(), 1):
                runs.append(run)
                letters += len(run)
                if letters >= step or n == batch.num_rows:
                    columns = [pa.array(runs, pa.string()), pa.array(cut(runs), pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, ["run", "words"])
                    runs, letters = [], 0

    return batches


def segmented(texts: DataFrame, words: DataFrame, run: str = "run") -> DataFrame:
    """(run, words): each different run of letters cut into words of :func:`dictionary`.

    ``words`` in the result is an array in order of the text. Letters that belong to no word stand alone. Null and
    empty runs have no row. The dictionary is collected and sent to the tasks as a trie of 16 bytes a node, so it must fit in
    memory there; the texts needn't. The path takes time and memory in proportion to the run. The texts' letters are counted
    first, and there are as many tasks as they ask for. As the dictionary and the letters are known before the plan is, it
    takes batch frames only.
    """
    known = words.select("word", "cost", "unknown").where(F.length("word") > 0).toArrow()
    unknown = max((n for n in known["unknown"].unique().to_pylist() if n is not None), default=1)
    trie = _trie(known["word"].to_pylist(), known["cost"].to_numpy())
    distinct = texts.select(F.col(run).alias("run")).where(F.length("run") > 0).distinct()
    # Of few bytes is much work made, so partitions aren't merged by their size.
    letters = texts.agg(F.coalesce(F.sum(F.length(F.col(run)).cast("bigint")), F.lit(0))).first()[0]
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-letters // TASK_LETTERS))
    dealt = distinct.withColumn("__id", F.xxhash64("run")).repartition(tasks, "__id").select("run")
    cutter = _cutter(texts.sparkSession.sparkContext.broadcast(trie), unknown, STEP)
    return dealt.mapInArrow(cutter, "run string, words array<string>")

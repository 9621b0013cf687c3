"""The most searched queries as a changelog, on a stream.

Queries are dealt over parts; each part keeps its counts in map state and passes its own list on when it changed. One
more state merges the parts' lists, which hold n entries each whatever the number of queries.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from millrace.streaming import jobs

PARTS = 32

PART_LIST = "part bigint, query string, total bigint, window_ts timestamp"
CHANGES = ["window_end", "query", "change", "rank", "previous_rank", "query_count"]
CHANGE_TYPES = "window_end bigint, query string, change string, rank bigint, previous_rank bigint, query_count bigint"


def _best(entries, n: int) -> list[tuple[str, int]]:
    return sorted(entries, key=lambda e: (-e[1], e[0]))[:n]


class PartList(StatefulProcessor):
    """Counts of a part's queries, and the part's list after each window that changed it."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle):
        self.counts = handle.getMapState("counts", "query string", "total bigint")
        self.top = handle.getListState("top", "query string, total bigint")

    def handleInputRows(self, key, rows, timerValues):
        frames = list(rows)
        if not frames:
            return
        top = dict(self.top.get()) if self.top.exists() else {}
        out = []
        for ts, group in pd.concat(frames).groupby("window_ts", sort=True):
            changed = False
            for query, count in zip(group["query"], group["query_count"]):
                total = int(count) + (self.counts.getValue((query,))[0] if self.counts.containsKey((query,)) else 0)
                self.counts.updateValue((query,), (total,))
                listed = dict(_best([*(e for e in top.items() if e[0] != query), (query, total)], self.n))
                changed |= listed != top
                top = listed
            if changed:
                out += [(key[0], query, total, ts) for query, total in top.items()]
        self.top.put(list(top.items()))
        if out:
            yield pd.DataFrame(out, columns=["part", "query", "total", "window_ts"])

    def close(self) -> None:
        pass


class MergedList(StatefulProcessor):
    """The list over all parts, and what changed in it."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle):
        self.parts = handle.getListState("parts", "part bigint, query string, total bigint")
        self.listed = handle.getListState("listed", "query string, total bigint")

    def handleInputRows(self, key, rows, timerValues):
        frames = list(rows)
        if not frames:
            return
        parts: dict[int, list[tuple[str, int]]] = {}
        for part, query, total in self.parts.get() if self.parts.exists() else []:
            parts.setdefault(part, []).append((query, total))
        listed = [tuple(e) for e in self.listed.get()] if self.listed.exists() else []
        out = []
        for ts, window in pd.concat(frames).groupby("window_ts", sort=True):
            for part, group in window.groupby("part"):
                parts[int(part)] = [(q, int(t)) for q, t in zip(group["query"], group["total"])]
            now = _best([e for entries in parts.values() for e in entries], self.n)
            before = {q: (rank, t) for rank, (q, t) in enumerate(listed, start=1)}
            after = {q: (rank, t) for rank, (q, t) in enumerate(now, start=1)}
            for query in before.keys() | after.keys():
                was, rank = before.get(query, (0, 0))[0], after.get(query, (0, 0))[0]
                if was != rank:
                    kind = "entered" if not was else "moved" if rank else "left"
                    out.append((int(ts.timestamp() * 1000), query, kind, rank, was, (after.get(query) or before[query])[1]))
            listed = now
        self.parts.put([(p, q, t) for p, entries in parts.items() for q, t in entries])
        self.listed.put(listed)
        if out:
            yield pd.DataFrame(out, columns=CHANGES)

    def close(self) -> None:
        pass


def hot_query_changes(searches: DataFrame, n: int = 10, width: str = "3 seconds", delay: str = jobs.LOG_DELAY) -> DataFrame:
    """Stream form of :func:`millrace.operators.search.hot_query_changes`, from searches (query, ts).

    A window is counted once, when the watermark has passed it; then it meets the parts and their merged list in the
    same micro-batch.
    """
    counted = jobs.query_count_window(searches, width, delay)
    placed = counted.select(
        F.pmod(F.xxhash64("query"), F.lit(PARTS)).alias("part"), "query", "query_count", F.col("window.end").cast("timestamp").alias("window_ts")
    )
    lists = placed.groupBy("part").transformWithStateInPandas(
        statefulProcessor=PartList(n), outputStructType=PART_LIST, outputMode="Append", timeMode="None"
    )
    return lists.withColumn("all", F.lit(0)).groupBy("all").transformWithStateInPandas(
        statefulProcessor=MergedList(n), outputStructType=CHANGE_TYPES, outputMode="Append", timeMode="None"
    )

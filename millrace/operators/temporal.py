"""Values as of a time, hand-over from a snapshot to its log, and rows held until it is quiet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.running import Running, latest_per_key, running


def lookup_as_of(
    facts: DataFrame, versions: DataFrame, on: dict[str, str], ts: str, version_ts: str, order: list[str],
    take: dict[str, str], slice_by: Column, deleted: Column | None = None,
) -> DataFrame:
    """Facts with columns of the version that was valid at their time.

    Versions and facts go into one union in order of time and the last version is carried along, within slices of
    time first, so no version meets more than the facts that follow it. ``on`` maps fact columns to version
    keys, ``take`` version columns to output names. ``slice_by`` is an expression over a column ``ts`` that doesn't
    decrease with it.

    A version of the fact's own time counts. Of several at one time the last in ``order`` counts, and a row that
    is ``deleted`` (an expression over the versions) ends the earlier ones. Facts before the first version, behind
    a deletion, without a time or without a key get nulls. Every fact is returned once; no fact is left out.
    """
    keys = [f"__k{n}" for n in range(len(on))]
    value = F.struct(*[F.col(c).alias(name) for c, name in take.items()])
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    ranked = versions.where(F.col(version_ts).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(on.values(), keys)],
        F.col(version_ts).alias("ts"),
        F.struct(*order).alias("__order"),
        F.struct(F.when(~gone, value).alias("v")).alias("__version"),
    )
    # One version per key and time, so that the order of the union is total.
    ranked = latest_per_key(ranked, [*keys, "ts"], ["__order"]).drop("__order").withColumn("__fact", F.lit(0))
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in facts.columns])
    placed = facts.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)], F.col(ts).alias("ts"), whole.alias("__row"), F.lit(1).alias("__fact")
    )
    timed = placed.where(F.greatest(*[F.col(k).isNull() for k in keys], F.col("ts").isNull()) == F.lit(False))
    others = placed.where(F.greatest(*[F.col(k).isNull() for k in keys], F.col("ts").isNull()))
    together = ranked.unionByName(timed, allowMissingColumns=True)
    carried = running(together, keys, ["ts", "__fact"], slice_by, [Running("__seen", "last", F.col("__version"))], dealt_once=True)
    found = carried.where(F.col("__fact") == 1).select("__row", F.col("__seen.v").alias("v"))
    nothing = others.select("__row", F.lit(None).cast(found.schema["v"].dataType).alias("v"))
    return found.unionByName(nothing).select(
        *[F.col("__row")[c].alias(c) for c in facts.columns], *[F.col("v")[name].alias(name) for name in take.values()]
    )


def snapshot_handover(snapshot: DataFrame, log: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """A table's rows and its further changes, each once, from a snapshot read in chunks beside a running log.

    ``snapshot`` has chunk, the key and a map ``row``, as read some time between its chunk's marks. ``marks`` has
    chunk, low and high: the log's position before and after the chunk was read. ``log`` has chunk (of its key),
    the key, seq (growing along the log and different within a key), op (c, u, d) and a map ``after``.

    Changes up to the low mark are in the snapshot already and go. Those above low up to high may be in it or
    not: the last of them per key replaces the key's snapshot row, or removes it. Those above high pass. The
    result has op (``r`` for rows of the snapshot), the key, seq (the chunk's high mark for ``r``) and after. Changes
    of a chunk that has no marks pass whole, as nothing was read there.

    The last change per key is an aggregate with a map-side half, so a hot key costs one row a task; snapshot and
    log meet their chunk's marks, which are few, by a join that the optimizer chooses.
    """
    window = marks.select("chunk", F.col("low").alias("__low"), F.col("high").alias("__high"))
    marked = log.join(window, "chunk", "left")
    passing = marked.where(F.col("__high").isNull() | (F.col("seq") > F.col("__high"))).select("op", key, "seq", "after")
    inside = marked.where((F.col("seq") > F.col("__low")) & (F.col("seq") <= F.col("__high")))
    last = inside.groupBy(key).agg(
        F.max_by(F.struct("op", "after"), "seq").alias("__change"), F.first("__high").alias("__to")
    )
    read = snapshot.join(window, "chunk", "left").select(key, F.col("row").alias("__read"), F.col("__high").alias("__at"))
    both = read.join(last, key, "full_outer")
    changed = F.col("__change").isNotNull()
    kept = both.where(~changed | (F.col("__change.op") != "d")).select(
        F.lit("r").alias("op"), key, F.coalesce("__to", "__at").alias("seq"),
        F.when(changed, F.col("__change.after")).otherwise(F.col("__read")).alias("after"),
    )
    return kept.unionByName(passing)


def emissions_after_quiet(df: DataFrame, key: str, ts: str, order: list[str], quiet: int, slice_by: Column) -> DataFrame:
    """One row per spell of a key: the last version, emitted when nothing came for ``quiet`` seconds.

    A row belongs to the spell before it if it is at most ``quiet`` seconds younger than its last row. ``emit_ts`` is
    the last row's time plus the wait. ``order`` starts with ``ts`` and orders a key's rows up to equal ones. Rows
    without a key or time are left out. A spell ends at a row whose follower, in its slice or at the start of the key's
    next one, is further away. Rows are dealt once, by (key, slice), so a key with many rows is many tasks.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("__slice", slice_by)
    micros = F.unix_micros(F.col(ts))
    within = Window.partitionBy(key, "__slice").orderBy(*order)
    gap = F.unix_micros(F.lead(ts).over(within)) - micros
    # Closed by the next row of the slice, or open until the key's next slice.
    ends = rows.withColumns({"__gap": gap}).where(F.col("__gap").isNull() | (F.col("__gap") > quiet * 1_000_000))
    starts = rows.groupBy(key, "__slice").agg(F.min(ts).alias("__start"))
    further = starts.select(key, "__slice", F.lead("__start").over(Window.partitionBy(key).orderBy("__slice")).alias("__then"))
    goes_on = further.where(F.col("__then").isNotNull())
    linked = ends.join(goes_on, [key, "__slice"], "left")
    apart = F.col("__gap").isNotNull() | F.col("__then").isNull() | (F.unix_micros("__then") - micros > quiet * 1_000_000)
    return linked.where(apart).select(*df.columns, F.timestamp_micros(micros + quiet * 1_000_000).alias("emit_ts"))

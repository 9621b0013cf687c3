"""Dictionary segmentation against plain dynamic programming."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import segments


def plain(run: str, costs: dict[str, int], unknown: int) -> list[str]:
    best = [(0, 0, 0)]
    for end in range(1, len(run) + 1):
        tried = [(best[end - 1][0] + unknown, best[end - 1][1] + 1, -1)]
        for word, cost in costs.items():
            if run[:end].endswith(word):
                before = best[end - len(word)]
                tried.append((before[0] + cost, before[1] + 1, -len(word)))
        best.append(min(tried))
    out, end = [], len(run)
    while end:
        out.append(run[end + best[end][2] : end])
        end += best[end][2]
    return out[::-1]


@pytest.mark.parametrize("step", [1, 5, 256])
def test_segments_by_plain_programming(spark, monkeypatch, step):
    monkeypatch.setattr(segments, "STEP", step)
    rng = random.Random(step)
    tokens = ["ab", "abc", "b", "cab", "bca", "小米", "手机", "小", "aaaaaaaaa", "é", "𠀀𠀁"]
    counted = [t for t in tokens for _ in range(rng.randrange(1, 40))]
    words = segments.dictionary(spark.createDataFrame([(t,) for t in [*counted, "", None]], "word string"))
    total = len(counted)
    costs = {t: math.floor(1000 * math.log(total / n)) for t, n in Counter(counted).items()}
    assert {r.word: r.cost for r in words.collect()} == costs
    texts = ["".join(rng.choices([*tokens, "x", "手", "c"], k=rng.randrange(1, 30))) for _ in range(60)] + ["x", "é", "𠀀𠀁𠀀", "abcab" * 200]
    frame = spark.createDataFrame([(t,) for t in [*texts, *texts, "", None]], "run string")
    got = {r.run: list(r.words) for r in segments.segmented(frame, words).collect()}
    unknown = math.floor(1000 * math.log(total * segments.UNKNOWN))
    assert got == {t: plain(t, costs, unknown) for t in texts}


def test_runs_and_an_empty_dictionary(spark):
    cut = lambda t: spark.createDataFrame([(t,)], "t string").select(segments.runs(F.col("t"))).first()[0]
    assert cut("The  quick\n fox, ran! ") == ["thequickfox", "ran"]
    assert cut("...") == [] and cut("") == [] and cut(None) is None
    none = segments.dictionary(spark.createDataFrame([], "word string"))
    one = spark.createDataFrame([("abc",)], "run string")
    assert segments.segmented(one, none).first().words == ["a", "b", "c"]
    assert segments.segmented(one.where("false"), none).isEmpty()


def test_a_long_run_takes_time_in_proportion(spark):
    words = segments.dictionary(spark.createDataFrame([("ab",), ("abc",), ("ca",)], "word string"))
    run = "abcab" * 20_000
    assert "".join(segments.segmented(spark.createDataFrame([(run,)], "run string"), words).first().words) == run


def test_tasks_grow_with_the_letters(spark, monkeypatch):
    monkeypatch.setattr(segments, "TASK_LETTERS", 5)
    words = segments.dictionary(spark.createDataFrame([("ab",), ("c",)], "word string"))
    runs = spark.createDataFrame([(f"ab{n}c" * 10,) for n in range(10)], "run string")
    cut = segments.segmented(runs, words)
    assert "hashpartitioning(__id" in (plan := cut._jdf.queryExecution().executedPlan().toString())
    assert ", 80), REPARTITION_BY_NUM" in plan
    assert {"".join(r.words) for r in cut.collect()} == {r.run for r in runs.collect()}


def test_letters_stay_in_their_task_whatever_the_dictionary(spark):
    """With more words than a broadcast join takes, only the runs are moved: no row per letter or edge goes through an exchange."""
    words = spark.range(200_001).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    runs = spark.createDataFrame([("w12w200000xw7",), ("w12w200000xw7",), ("yw00",)], "run string")
    cut = segments.segmented(runs, segments.dictionary(words))
    moved = [line for line in cut._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert moved and all("(run#" in line or "(__id#" in line for line in moved)
    assert {r.run: r.words for r in cut.collect()} == {"w12w200000xw7": ["w12", "w200000", "x", "w7"], "yw00": ["y", "w0", "0"]}


@pytest.mark.parametrize("step", [1, 7])
def test_runs_of_many_steps_and_a_word_as_long_as_the_run(spark, monkeypatch, step):
    monkeypatch.setattr(segments, "STEP", step)
    long = "ab" * 40
    words = segments.dictionary(spark.createDataFrame([(w,) for w in (long, "ab", "b", "aba")], "word string"))
    runs = spark.createDataFrame([(long,), (long + "x",), ("x" + long + long,), ("ab\U0010ffffb",)], "run string")
    got = {r.run: r.words for r in segments.segmented(runs, words).collect()}
    assert got == {long: [long], long + "x": [long, "x"], "x" + long + long: ["x", long, long], "ab\U0010ffffb": ["ab", "\U0010ffff", "b"]}

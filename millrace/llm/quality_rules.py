"""Document quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Everything here is column expressions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import let, saved

SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
GOOD, BAD = 1, -1
ROUNDS = 25
# Start of the fit: share of good documents, and what a vote of the right, the wrong and no side counts
# before any document is seen. It says only that rules are better than chance.
PRIOR_GOOD = 0.8
PSEUDO = 50.0
KEEP_FROM = 0.5


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but the characters 20 and 09-0D."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a 3-word window found twice or more in the text.

    Texts whose windows all have different hashes, the most, have none. In the others the windows themselves
    are sorted with their positions, so that equal ones are neighbours; the positions of those are then put
    in order and the words they cover are added up, each once. Time n log n, memory n.
    """
    hashes = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        1, F.greatest(F.size(words) - 2, F.lit(0)),
    )
    windows = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i"))),
        lambda s: s.c.isNotNull(),
    )

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x.a == y.a) & (x.b == y.b) & (x.c == y.c), F.lit(False))

    def positions(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda s, i: same(s, F.get(ordered, i + 1)) | same(s, F.get(ordered, i - 1)))
        return F.sort_array(F.transform(twice, lambda s: s.i))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        let(F.sort_array(windows), positions),
        start,
        lambda acc, p: F.struct(p.alias("last"), (acc.n + F.least(F.lit(3), p - acc["last"])).alias("n")),
    )
    some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(some, covered.n).otherwise(F.lit(0).cast("long"))


def _count(text: Column, kind: str) -> Column:
    """How many characters of a kind (a character class) a text has."""
    return (F.size(F.split(text, kind)) - 1).cast("long")


def _signals(text: Column) -> Column:
    """The counts that the rules read, as one struct. A null or empty text has no words; every count is 0."""

    def measured(t: Column, words: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _count(t, SYMBOLS).alias("n_symbols"),
            let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            _count(t, "\\p{Lu}").alias("n_upper"),
            _count(t, "[.!?]").alias("n_ends"),
            _count(t, "!").alias("n_shouts"),
        )

    return let(F.coalesce(text, F.lit("")), lambda t: let(words_of(t), lambda words: measured(t, words)))


def signals(docs: DataFrame) -> DataFrame:
    """One narrow row per document: doc_id and the counts. Texts are read whole."""
    return docs.select("doc_id", _signals(F.col("text")).alias("s")).select("doc_id", "s.*")


def _base_failed(of=F.col) -> Column:
    return (of("n_words") < LEAST_WORDS) | (100 * of("n_repeat_words") > MOST_REPEAT_PERCENT * of("n_words"))


def _votes(of=F.col) -> Column:
    return F.array(*[vote.cast("int") for vote in rules(of).values()])


def rules(of=F.col) -> dict[str, Column]:
    """Each rule's vote over the counts of :func:`signals`, which ``of`` gives by name: 1 good, -1 bad, 0 abstains.

    The first seven look for one fault each and vote bad or abstain; the others look for a sign of prose and
    vote good, bad or abstain. Three of those read words and sentences, so they don't call a text good that
    is dense with symbols: there they can't tell.
    """

    def percent(part: str, whole: str, least: int) -> Column:
        return 100 * of(part) >= least * of(whole)

    plain = ~percent("n_symbols", "n_words", 10)

    def bad(condition: Column) -> Column:
        return F.when(condition, BAD).otherwise(0)

    def either(good: Column, wrong: Column) -> Column:
        return F.when(good, GOOD).when(wrong, BAD).otherwise(0)

    return {
        "too_short": bad(of("n_words") < LEAST_WORDS),
        "repetitive": bad(percent("n_repeat_words", "n_words", 40)),
        "symbols": bad(percent("n_symbols", "n_words", 20)),
        "shouting": bad(percent("n_upper", "word_chars", 40)),
        "exclaiming": bad(percent("n_shouts", "n_words", 20)),
        "repeated_lines": bad((of("n_lines") >= 4) & percent("n_dup_lines", "n_lines", 40)),
        "word_length": bad(~of("word_chars").between(2 * of("n_words"), 14 * of("n_words"))),
        "sentences": either(
            plain & percent("n_ends", "n_words", 2) & ~percent("n_ends", "n_words", 34),
            ~percent("n_ends", "n_words", 1) | percent("n_ends", "n_words", 50),
        ),
        "plain_characters": either(~percent("n_symbols", "n_words", 3), percent("n_symbols", "n_words", 10)),
        "letter_case": either(plain & ~percent("n_upper", "word_chars", 12), percent("n_upper", "word_chars", 30)),
        "varied": either(plain & ~percent("n_repeat_words", "n_words", 12), percent("n_repeat_words", "n_words", 30)),
    }


def _fit(votes: int) -> Column:
    """The fitted model over ``patterns`` (array of struct(v array<int>, n long)), as one expression.

    Latent classes good and bad. For class y and rule j the model holds the chance of each vote
    (bad, none, good), so a rule's accuracy may differ between the classes and abstaining may say
    something, too. Each round takes the expectation (every pattern's posterior) and then the
    maximisation (weighted vote counts, with the start's pseudo-counts added).
    """
    size = F.lit(votes)

    def prior(j: Column, y: int, v: int) -> Column:
        return F.lit(PSEUDO * (0.5 if v == y else 0.1 if v == -y else 0.4))

    def rates(y: int, count) -> Column:
        def one(j: Column) -> Column:
            amounts = [prior(j, y, v) + count(j, v) for v in (BAD, 0, GOOD)]
            whole = amounts[0] + amounts[1] + amounts[2]
            return F.array(*[F.ln(a / whole) for a in amounts])

        return F.transform(F.sequence(F.lit(0), size - 1), one)

    def none(j: Column, v: int) -> Column:
        return F.lit(0.0)

    start = F.struct(
        F.lit(PRIOR_GOOD).alias("share"), rates(GOOD, none).alias("good"), rates(BAD, none).alias("bad")
    )

    def step(model: Column, _: Column) -> Column:
        weighed = F.transform(
            F.col("patterns"),
            lambda p: F.struct(p.v.alias("v"), (p.n * _posterior(model, p.v)).alias("g"), p.n.cast("double").alias("n")),
        )

        def maximise(ws: Column) -> Column:
            def total(value) -> Column:
                return F.aggregate(ws, F.lit(0.0), lambda acc, w: acc + value(w))

            def count(of):
                return lambda j, v: total(lambda w: F.when(F.get(w.v, j) == v, of(w)).otherwise(0.0))

            good = (total(lambda w: w.g) + PSEUDO * PRIOR_GOOD) / (total(lambda w: w.n) + PSEUDO)
            return F.struct(
                good.alias("share"),
                rates(GOOD, count(lambda w: w.g)).alias("good"),
                rates(BAD, count(lambda w: w.n - w.g)).alias("bad"),
            )

        return let(weighed, maximise)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _posterior(model: Column, v: Column) -> Column:
    """Probability that a document with these votes is good."""

    def evidence(side: Column) -> Column:
        logs = F.zip_with(side, v, lambda r, x: F.get(r, x + 1))
        return F.aggregate(logs, F.lit(0.0), lambda acc, x: acc + x)

    odds = F.ln(model.share) - F.ln(1 - model.share) + evidence(model.good) - evidence(model.bad)
    return 1 / (1 + F.exp(-odds))


def fitted(votes: DataFrame, n_rules: int) -> DataFrame:
    """(v, quality): each vote pattern that occurs and its posterior probability of being good.

    Documents enter as counts of vote patterns. Their number depends on the rules alone (at most 2^7 * 3^4
    for the rules here), so one row holds them all, whatever the size of the corpus.
    """
    return fitted_counts(votes.groupBy("v").count(), n_rules)


def fitted_counts(patterns: DataFrame, n_rules: int) -> DataFrame:
    """The same from (v, count)."""
    counts = patterns.select("v", F.col("count").alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct("v", "n")))
    model = counts.agg(ordered.alias("patterns")).select("patterns", _fit(n_rules).alias("model"))
    scored = model.select(
        F.explode(F.transform("patterns", lambda p: F.struct(p.v.alias("v"), _posterior(F.col("model"), p.v).alias("q"))))
    )
    return scored.select("col.v", F.col("col.q").alias("quality"))


def judged(docs: DataFrame) -> DataFrame:
    """Per document: the signals, base_failed, the votes' posterior ``quality`` and ``kept``.

    ``docs`` needs doc_id and text; other columns are ignored. ``base_failed`` marks fewer than 50 words or
    more than half of the words in repeated windows; those are not kept. The others are kept when their
    posterior is 0.5 or more. Documents that fail the base vote, too: they are what the bad class is learnt
    from. A null or empty text fails the base. Equal rows and null ids are judged row by row; an empty
    table gives no rows.
    """
    seen = saved(signals(docs).withColumn("v", _votes()), "quality-signals")
    # One row per pattern that occurs: a few thousand at most, by the number of rules.
    scores = F.broadcast(saved(fitted(seen, len(rules())), "quality-scores"))
    return (
        seen.join(scores, "v")
        .withColumn("base_failed", _base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that :func:`judged` keeps, row by row and with their columns as they are.

    The verdict needs a row's own counts and the fitted scores alone, so texts are read twice and never
    shuffled, and rows need no id of their own. The scores of all patterns are one value of the plan; each
    row's counts are one expression, so that no part of the plan computes them again.
    """

    def votes(s: Column) -> Column:
        return _votes(lambda name: s[name])

    patterns = saved(docs.select(let(_signals(F.col("text")), votes).alias("v")).groupBy("v").count(), "quality-votes")
    scores = saved(fitted_counts(patterns, len(rules())), "quality-scores")
    by_pattern = scores.agg(F.map_from_entries(F.collect_list(F.struct("v", "quality"))).alias("m"))
    passed = let(
        _signals(F.col("text")), lambda s: F.when(~_base_failed(lambda name: s[name]), votes(s))
    )
    return docs.where(F.try_element_at(by_pattern.scalar(), passed) >= KEEP_FROM)

"""Secrets in texts: wide candidate search, then a random forest that removes false findings.

Everything on the data is column expressions and Spark's own (JVM) random forest; no Python runs on executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import let, quoted, saved, whole_row

# What may be a secret wherever it stands: a run of key characters, 16 or more.
CORE = r"[A-Za-z0-9_+/\-]{16,}={0,2}"
# Names that stand before a secret, and starts that issuers give to theirs.
KEY_NAMES = r"(?i)(token|passw(or)?d|passwd|pwd|secret|api[_\-]?key|access[_\-]?key|auth|credential|bearer)"
ISSUED = r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|xox[abpr]-|sk-|sk_live_|eyJ|AIza|glpat-|npm_)"
# Values that may be one for what stands before them, however short: behind a name and a sign in the same word (three
# forms: in double or single quotes, or up to the next name), behind a name and a sign before the word, or behind
# a bare name, if they are more than letters; and whatever goes on from an issuer's start.
NAMED = KEY_NAMES + r"[A-Za-z0-9_\-]*[\"'`]?(=>|:=|[=:])"
IN_WORD = NAMED + r"""(?:\"([^\"]+)|'([^']+)|([^\"'`].*?)(?=[,;&][\"']?[A-Za-z0-9_\-]+[\"']?[=:]|$))"""
SIGN = r"^(=>|:=|[=:])[\"'`]?$"
BARE = KEY_NAMES + r"[A-Za-z0-9_\-]*[\"'`]?$"
BEARER, SCHEME = r"(?i)^[\"'`]?bearer$", r"(?i)^[\"'`]?(bearer|basic|digest)$"
MIXED = r"[A-Za-z].*[^A-Za-z\"'`,;.:!?)\]}>].*|[^A-Za-z\"'`(<{\[].*[A-Za-z]"
STARTED = r"(?<![A-Za-z0-9])(" + ISSUED[1:] + r"[^\"'`<>,;(){}\[\]]+)"
# Shorter secrets are masked as whole words only, and ones that could be any word only where a name or a sign stands before.
AS_WORDS, BY_PLACE = 16, 8
# A word that this many documents hold is in the dictionary.
DICTIONARY_DOCS = 5
# Labelled findings of each kind that the forest is fitted on at most, taken in the order of a hash.
TRAINING_ROWS = 10_000
TREES, DEPTH, SEED = 20, 6, 7
SECRET_FROM = 0.5
MASK = "<secret>"

FEATURES = [
    "length", "digits", "upper", "lower", "transitions", "vowels", "distinct", "dictionary", "slashes", "assigned",
    "key_before", "named", "issued", "known_before", "known_after",
]


def _bare(value: Column) -> Column:
    """A value without the brackets and quotes around it and the punctuation behind it."""
    opened = F.regexp_replace(value, "^[(<{\\[]+", "")
    quoted_ = F.regexp_extract(opened, "^[\"'`]([^\"'`]+)", 1)
    return F.when(quoted_ != "", quoted_).otherwise(F.regexp_replace(opened, "[,;.)\\]}>\"'`]+$", ""))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, at, word, core, before, before2, after, named): what may be a secret, with its neighbours.

    That is every run of 16 key characters or more, whatever it consists of and stands beside, and values of
    any length and characters that stand behind a key's name (``named``) or go on from an issuer's start. ``at``
    is the number of the word in the text. A value ends with its word. All rejection is left to the forest.
    """
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def behind(word: Column, before: Column, before2: Column) -> Column:
        """The word stands behind a name that ends the words before it."""
        signed = before.rlike(NAMED + "[\"'`]?$") | before.rlike(SIGN) & before2.rlike(BARE)
        named = signed | before.rlike(BEARER) | before.rlike(SCHEME) & before2.rlike(NAMED + "$") | before.rlike(BARE) & word.rlike(MIXED)
        return F.coalesce(named, F.lit(False)) & ~word.rlike(SIGN) & ~word.rlike(SCHEME)

    def hits(ws: Column) -> Column:
        around = F.transform(
            ws,
            lambda w, i: F.when(
                w.rlike(CORE) | w.rlike(NAMED + ".") | w.rlike(STARTED) | behind(w, F.get(ws, i - 1), F.get(ws, i - 2)),
                F.struct(
                    i.alias("at"), w.alias("word"), F.get(ws, i - 1).alias("before"), F.get(ws, i - 2).alias("before2"),
                    F.get(ws, i + 1).alias("after"),
                ),
            ),
        )
        return F.filter(around, lambda s: s.isNotNull())

    text = F.col("text")
    some = docs.where(text.rlike(CORE) | text.rlike(KEY_NAMES) | text.rlike(STARTED))
    found = some.select("doc_id", F.explode(let(words, hits)).alias("c")).select("doc_id", "c.*")
    word = F.col("word")
    within = F.concat(*[F.regexp_extract_all(word, F.lit(IN_WORD), F.lit(g)) for g in (4, 5, 6)])
    values = F.transform(
        F.concat(within, F.when(behind(word, F.col("before"), F.col("before2")), F.array(word)).otherwise(F.array().cast("array<string>"))),
        _bare,
    )
    runs = F.regexp_extract_all(word, F.lit(f"({CORE})"))
    started = F.transform(F.regexp_extract_all(word, F.lit(STARTED), F.lit(1)), lambda v: F.regexp_replace(v, "[.:!?]+$", ""))
    with_values = found.withColumn("values", F.filter(values, lambda v: v != ""))
    cores = with_values.select("*", F.explode(F.array_distinct(F.concat(runs, started, "values"))).alias("core")).where("core <> ''")
    return cores.withColumn("named", F.array_contains("values", F.col("core")).cast("double")).drop("values")


def dictionary(docs: DataFrame) -> DataFrame:
    """(term): words of four letters or more, in lower case, that at least DICTIONARY_DOCS documents hold."""
    terms = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}{4,})")))
    counted = docs.select(F.explode(terms).alias("term")).groupBy("term").count()
    return counted.where(F.col("count") >= DICTIONARY_DOCS).select("term")


def _share(text: Column, kind: str, whole: Column) -> Column:
    return (F.size(F.split(text, kind)) - 1) / whole


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates with the forest's features, one row each; ``known`` is the dictionary."""
    core = F.col("core")
    length = F.length(core).cast("double")
    kinds = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(core, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"
    )
    head = F.split_part(F.col("word"), core, F.lit(1))
    tail_words = F.concat_ws(" ", F.coalesce("before2", F.lit("")), F.coalesce("before", F.lit("")), head)
    letters = F.length(F.regexp_replace(core, "[^A-Za-z]", ""))
    own = found.withColumn("key", F.xxhash64("doc_id", "at", "core", "word", "before", "before2", "after")).select(
        "*",
        length.alias("length"),
        _share(core, "[0-9]", length).alias("digits"),
        _share(core, "[A-Z]", length).alias("upper"),
        _share(core, "[a-z]", length).alias("lower"),
        ((F.length(F.regexp_replace(kinds, "(.)\\1+", "$1")) - 1) / length).alias("transitions"),
        F.coalesce(_share(core, "[aeiouAEIOU]", F.when(letters > 0, letters)), F.lit(0.0)).alias("vowels"),
        (F.size(F.array_distinct(F.split(core, ""))) / length).alias("distinct"),
        _share(core, "/", length).alias("slashes"),
        head.rlike("[=:\"']$").cast("double").alias("assigned"),
        F.coalesce(tail_words.rlike(KEY_NAMES), F.lit(False)).cast("double").alias("key_before"),
        core.rlike(ISSUED).cast("double").alias("issued"),
    )
    # Letters of the candidate and neighbouring words that the dictionary knows, by one join.
    runs = F.regexp_extract_all(F.lower("core"), F.lit("(\\p{L}{4,})"))

    def clean(word: str) -> Column:
        return F.regexp_extract(F.lower(F.coalesce(F.col(word), F.lit(""))), "(\\p{L}{4,})", 1)

    asked = F.concat(
        F.transform(runs, lambda r: F.struct(r.alias("term"), F.lit("core").alias("place"))),
        F.array(
            F.struct(clean("before").alias("term"), F.lit("before").alias("place")),
            F.struct(clean("after").alias("term"), F.lit("after").alias("place")),
        ),
    )
    terms = own.select("key", F.explode(F.array_distinct(asked)).alias("t")).select("key", "t.*").where("term <> ''").distinct()
    hits = terms.join(known, "term").groupBy("key").agg(
        F.sum(F.when(F.col("place") == "core", F.length("term")).otherwise(0)).alias("covered"),
        F.max((F.col("place") == "before").cast("double")).alias("known_before"),
        F.max((F.col("place") == "after").cast("double")).alias("known_after"),
    )
    return own.join(hits, "key", "left").select(
        "doc_id", "at", "core", *[c for c in FEATURES if c not in ("dictionary", "known_before", "known_after")],
        F.least(F.coalesce("covered", F.lit(0)) / F.col("length"), F.lit(1.0)).alias("dictionary"),
        F.coalesce("known_before", F.lit(0.0)).alias("known_before"),
        F.coalesce("known_after", F.lit(0.0)).alias("known_after"),
    )


def _address() -> Column:
    return F.col("core").contains("://")


def _random_looking(rows_named: Column) -> Column:
    """A named value without a digit that no word is in: its case changes often, or it has hardly a vowel."""
    changes = (F.col("upper") > 0) & (F.col("lower") > 0) & (F.col("transitions") >= 0.4)
    return rows_named & (F.col("digits") == 0) & (F.col("dictionary") == 0) & (changes | (F.col("vowels") < 0.15) & (F.col("length") >= 8))


def labelled(rows: DataFrame) -> DataFrame:
    """Findings with a label where one is certain enough to learn from.

    1: an issuer's start and 20 characters or digits among letters, or a key's name and a value with digits and few
    changes back to words, or a named value that looks random. 0: digits alone, capitals alone, or a path, and nothing of a key beside
    it; letters that are not the value a name beside them gives, words of the dictionary or an address behind a
    name, and an issuer's start that goes on in a few small letters. The rest, the most, has none.
    """
    digits, key, issued = F.col("digits"), F.col("key_before") > 0, F.col("issued") > 0
    direct = F.col("named") > 0
    named = key & (digits > 0) & (digits < 1) & ~_address() & (direct | (F.col("length") >= AS_WORDS))
    begun = issued & ((F.col("length") >= 20) | (digits > 0) & (F.col("transitions") >= 0.3))
    secret = begun | named | _random_looking(direct)
    dull = (digits == 1) | (digits == 0) | (F.col("slashes") > 0.05) | (F.col("dictionary") > 0.3)
    plain = ~key & ~issued & dull
    words = ~issued & (digits == 0) & (key & ~direct | direct & (F.col("dictionary") > 0.3)) | direct & _address()
    started = issued & (F.col("length") < 20) & (digits == 0) & (F.col("upper") == 0)
    label = F.when(secret, 1.0).when(plain | words | started, 0.0)
    return rows.withColumn("label", label).where("label IS NOT NULL")


def training_rows(rows: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """At most ``most`` labelled findings of each kind, in the order of a hash: the same ones on every run."""
    known = labelled(rows)

    def some(label: float) -> DataFrame:
        order = [F.xxhash64("core", "doc_id", "at"), F.col("core"), F.col("doc_id"), F.col("at")]
        return known.where(F.col("label") == label).orderBy(*order).limit(most)

    return saved(some(1.0).union(some(0.0)).select(*FEATURES, "label").coalesce(1), "findings")


def fit(findings: DataFrame):
    """A random forest over labelled findings (FEATURES and label), or None without both kinds."""
    if findings.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="vector", labelCol="label")
    return forest.fit(_vectors(findings))


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows)


def scored(rows: DataFrame, model) -> DataFrame:
    """The candidates with the forest's ``probability`` of being a secret and ``is_secret``."""
    if model is None:
        # Nothing to learn from: what is certain keeps its label, the rest is no finding.
        numbered = (F.col("key_before") > 0) & (F.col("digits") > 0) & ~_address()
        long = (F.col("length") >= AS_WORDS) & ((F.col("issued") > 0) | numbered)
        short = (F.col("digits") > 0) & (F.col("digits") < 1) & ((F.col("issued") > 0) | numbered & (F.col("named") > 0))
        out = rows.withColumn("probability", F.when(long | short | _random_looking(F.col("named") > 0), 1.0).otherwise(0.0))
    else:
        rated = model.transform(_vectors(rows)).withColumn("rated", F.get(vector_to_array("probability"), 1))
        out = rated.drop("probability", "vector", "rawPrediction", "prediction").withColumnRenamed("rated", "probability")
    return out.withColumn("is_secret", F.col("probability") >= SECRET_FROM)


def findings(docs: DataFrame, model=None) -> DataFrame:
    """Every candidate of every document: doc_id, at, core, the features, probability and is_secret.

    ``docs`` needs doc_id and text; other columns are ignored. Without a ``model`` (see :func:`fit`) one is
    fitted on labelled findings from these documents. Candidates, dictionary and scores cover all documents
    and whole texts; only the fit reads a bounded sample. Words held by many documents are counted with a
    map-side half. Null or empty texts have no candidates; repeated rows give repeated findings; null ids are
    findings of no known document; an empty table gives no rows.
    """
    read = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    found = saved(candidates(read), "candidates")
    rows = saved(features(found, dictionary(read)), "features")
    if model is None:
        model = fit(training_rows(rows))
    return scored(rows, model)


def _mask(text: Column, secret: Column) -> Column:
    """The text with a secret replaced; a short one only where it stands as a word, a very short one in its place."""
    literal = F.concat(F.lit("\\Q"), F.replace(secret, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E(?![A-Za-z0-9])"))
    place = r"(?:(?<=[=:>]\s{0,9}[\"'`(<{\[]{0,2})|(?<=" + KEY_NAMES + r"[\"'`]?\s{1,9}[\"'`(<{\[]{0,2}))(?-i)"
    by_place = (F.length(secret) < BY_PLACE) & ~secret.rlike(ISSUED)
    pattern = F.concat(F.when(by_place, F.lit(place)).otherwise(F.lit("(?<![A-Za-z0-9])")), literal)
    whole = F.replace(text, secret, F.lit(MASK))
    return F.when(F.length(secret) >= AS_WORDS, whole).otherwise(F.regexp_replace(text, pattern, F.lit(MASK)))


def masked(docs: DataFrame, model=None) -> DataFrame:
    """The documents, with every secret in their texts replaced by ``<secret>``; the columns stay as they are.

    ``n_chars``, where there is such a column, follows the new text. Nothing is dropped: documents without a
    secret pass through. Rows that share an id share its secrets; a row without one has those of its own text.
    """
    own = F.when(F.col("doc_id").isNotNull(), F.col("doc_id").cast("long")).when(F.col("text").isNotNull(), F.xxhash64("text"))
    secrets = (
        findings(docs.select(own.alias("doc_id"), "text"), model).where("is_secret").groupBy(F.col("doc_id").alias("found_in")).agg(F.collect_set("core").alias("secrets"))
    )
    joined = docs.select(whole_row(docs).alias("document"), own.alias("own_id")).join(
        secrets, F.col("own_id") == F.col("found_in"), "left"
    )
    text = F.col("document.text")
    longest_first = F.reverse(F.array_sort(F.transform("secrets", lambda s: F.struct(F.length(s).alias("n"), s.alias("s")))))
    clean = F.when(F.col("secrets").isNull(), text).otherwise(
        F.aggregate(longest_first, text, lambda t, s: _mask(t, s.s))
    )
    out = {c: F.col("document." + quoted(c)) for c in docs.columns} | {"text": clean}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("secrets").isNull(), out["n_chars"]).otherwise(F.length(clean).cast("long"))
    return joined.select(*[c.alias(name) for name, c in out.items()])

"""The operators of millrace.llm on small tables: odd rows, and against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    byte_bpe, components, fast_minhash, host_suffixes, quality_rules, secret_forest, source_mixing, subspace_join,
    token_counts, tool_calls, warc_zip,
)
from millrace.llm.queries import QUERIES
from millrace.llm.statements import SQL
from millrace.llm.tables import new_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, v string, key string, slot string"
PROSE = (
    "The river ran low that summer and the mills stood still for weeks. Old men sat on the bridge and talked about "
    "floods they had seen. Nobody came to buy grain, so the stores were full, and children played between the sacks. "
    "When rain fell at last the wheels turned again and everyone went back to work before the evening bells."
)


def frame(spark, rows, **more):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "x", "y", "z") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and blank texts, repeated rows, null ids, a very long text."""
    long = " ".join(f"word{i % 9973}x{i % 31}" for i in range(60_000))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, PROSE, "a"), (4, PROSE, "a"), (None, PROSE, "b"),
        (None, None, None), (7, long, "b"), (8, long + " end", "b"), (9, PROSE + " Then winter came.", "a"), (10, "word", "a"),
        (11, "word", "a"),
    ]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def by_id(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_has_the_rows_of_its_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), SQL[name]) is None


def test_quality_of_odd_rows(odd, none):
    seen = quality_rules.judged(odd)
    assert seen.count() == odd.count()
    got = by_id(seen, "n_words", "base_failed", "kept")
    assert got[1] == got[2] == got[3] == (0, True, False)
    assert got[4][1:] == (False, True)
    assert quality_rules.judged(none).count() == 0
    kept = quality_rules.kept_documents(odd)
    assert kept.columns == odd.columns and quality_rules.kept_documents(none).count() == 0
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 4, 7, 8, 9]


def test_repeated_words_by_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 30))) for _ in range(60)] + ["a a a a", "a b c a b c"]
    want = []
    for t in texts:
        w = t.split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        want.append(len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}))
    got = by_id(quality_rules.signals(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])), "n_repeat_words")
    assert [got[i][0] for i in range(len(texts))] == want


def test_quality_agrees_with_labels(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    seen = quality_rules.judged(docs).join(labels.withColumnRenamed("quality", "label"), "doc_id").where("NOT base_failed")
    right = seen.where("kept = (label = 1)").count()
    assert right >= 0.97 * seen.count()


def test_mixing_bounds(spark, odd, none):
    rng = random.Random(3)
    for _ in range(60):
        weights = {f"s{i}": rng.choice([1, 2, 3, 7, rng.randint(1, 300)]) for i in range(rng.randint(1, 9))}
        slots, placed = source_mixing.period(weights)
        units = {s: u for s, u, _, _ in placed}
        done = dict.fromkeys(units, 0)
        assert [p[3] for p in placed] == list(range(slots))
        for s, u, j, t in placed:
            assert j * slots // u <= t < -(-(j + 1) * slots // u)
            done[s] += 1
            assert all(abs(done[k] - (t + 1) * units[k] / slots) < 1 for k in units)
    mixed = source_mixing.mixed(odd, {"a": 2, "b": 1, None: 1}, block_rows=2)
    rows = mixed.collect()
    assert len(rows) == odd.count() and all(r.slot is not None for r in rows)
    assert sorted(r.number for r in rows if r.source == "a") == list(range(7))
    assert source_mixing.mixed(odd, {"a": 1}).where("slot IS NULL").count() == 5
    assert source_mixing.mixed(none).count() == 0
    ordered = source_mixing.in_mixture_order(odd)
    assert ordered.columns == odd.columns and ordered.count() == odd.count()


def test_default_weights_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "MOST_SLOTS", 300)
    docs = frame(spark, [(i * 100 + j, "t", f"s{i}") for i in range(40) for j in range(40 + i)])
    weights = source_mixing.tempered_weights(docs)
    assert len(weights) == 40 and 150 < sum(weights.values()) <= 300
    assert source_mixing.mixed(docs).where("slot IS NULL").count() == 0 and source_mixing.mixed(docs).count() == docs.count()


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.com/x", "<p>é", 1), (2, None, "<p>é", 1), (3, "http://b.com", None, 1), (4, "http://[bad", "", 1),
         (5, "u", "z" * 300_000, 1), (5, "u", "z" * 300_000, 1), (None, "q", "z", 1)],
        "page_id long, url string, html string, payload int",
    )
    archives = warc_zip.write_archives(pages, new_folder(spark, "test"))
    for r in archives.collect():
        with zipfile.ZipFile(r.path.removeprefix("file://")) as z:
            assert z.testzip() is None and all(not m.compress_type for m in z.infolist())
    got = {r.page_id: r for r in warc_zip.read_records(archives).collect()}
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in got.items()} == {
        1: ("response", None, 5), 2: ("revisit", 1, 5), 3: ("response", None, 0), 4: ("revisit", 3, 0), 5: ("response", None, 300_000)
    }
    for k, text in ((1, "<p>é"), (2, "<p>é"), (3, ""), (5, "z" * 300_000)):
        assert got[k].payload_digest == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
    assert bytes(got[1].payload).decode() == "<p>é"
    assert warc_zip.round_trip(pages, least=10).where("record_type = 'revisit'").count() == 0
    assert warc_zip.round_trip(pages.where("false")).count() == 0


def test_warc_round_trip_keeps_pages_without_id(spark):
    rows = [(1, "http://a.com", "same"), (2, "http://a.com/2", "same"), (None, "http://a.com/3", "same"), (None, None, None)]
    got = warc_zip.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got) == [
        (0, "response", None, 0), (0, "response", None, 4), (1, "response", None, 4), (2, "revisit", 1, 4)
    ]


def test_zip_directories(tmp_path):
    """Archives of another writer, with a comment, and a damaged one."""
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/x.warc.gz", b"abc" * 50)
        z.comment = b"PK\x05\x06 is not the end"
    system, inner = warc_zip.opened(str(path))
    with system.open_input_file(inner) as file:
        method, start, size = warc_zip.directory(file, file.size())["archive/x.warc.gz"]
        assert method == 0 and file.read_at(size, start) == b"abc" * 50
    path.write_bytes(b"no archive")
    with system.open_input_file(inner) as file, pytest.raises(ValueError):
        warc_zip.directory(file, file.size())


def test_secrets(spark, odd, none):
    rng = random.Random(5)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    kinds = [lambda: f'token = "{hexes(40)}"', lambda: f"password={hexes(18)}", key, lambda: str(rng.randrange(10**15, 10**16)),
             lambda: "INTERNATIONALISATION!!"]
    rows = [(i, f"{PROSE} {kinds[i % 5]()} {PROSE}", "s") for i in range(300)]
    docs = frame(spark, rows)
    found = secret_forest.findings(docs)
    assert {r.doc_id: r.is_secret for r in found.collect()} == {i: i % 5 < 3 for i in range(300)}
    # Held out: a forest fitted on other documents.
    model = secret_forest.fit(secret_forest.training_rows(found.where("doc_id < 150")))
    assert secret_forest.findings(docs.where("doc_id >= 150"), model).where("is_secret = (doc_id % 5 < 3)").count() == 150
    masked = secret_forest.masked(docs)
    assert masked.columns == docs.columns and masked.where("text LIKE '%<secret>%'").count() == 180
    assert masked.where("n_chars <> length(text)").count() == 0
    assert secret_forest.findings(none).count() == 0 and secret_forest.masked(none).count() == 0
    assert secret_forest.masked(odd).count() == odd.count()


def test_secrets_of_any_form(spark):
    """Without digits, short, punctuated or with an issuer's start only; and words in the same places."""
    rng = random.Random(9)
    text = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    common = [lambda: f'token = "{text(40, "0123456789abcdef")}"', lambda: "INTERNATIONALISATION", lambda: text(16, "0123456789"),
              lambda: "internationalisations", lambda: "AKIA" + text(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")]
    rows = [(100 + i, f"{PROSE} {common[i % 5]()} {PROSE}", "s") for i in range(200)]
    secret = {
        1: ('secret = "{}"', "qWErtYuIopASDfghJKLz"), 2: ("password={}", "hunter2!"), 3: ("pwd: {},", "Tr0ub4dor&3$xK9"),
        4: ('{{"api_key":"{}","n":1}}', "aB3.dE5"), 5: ("password {}", "hunter2!"), 6: ("Authorization: Bearer {}", "aX9.b-7"),
        7: ("see {} there", "ghp_aB3dE5f"), 8: ("?access_key={}&page=2", "x9%7Bq"),
    }
    dull = {20: "the authors of internationalisations", 21: "token: children", 22: "a secret bridge", 23: "auth = https://a.com/1"}
    rows += [(i, f"{PROSE} {form.format(value)} {PROSE}", "s") for i, (form, value) in secret.items()]
    rows += [(i, f"{PROSE} {words} {PROSE}", "s") for i, words in dull.items()]
    docs = frame(spark, rows)
    found = {(r.doc_id, r.core): r.is_secret for r in secret_forest.findings(docs).collect()}
    assert {(i, v): found.get((i, v)) for i, (_, v) in secret.items()} == {(i, v): True for i, (_, v) in secret.items()}
    assert found[20, "internationalisations"] is False and found[21, "children"] is False and found[103, "internationalisations"] is False
    got = by_id(secret_forest.masked(docs), "text")
    for i, (form, _) in secret.items():
        assert got[i] == (f"{PROSE} {form.format('<secret>')} {PROSE}",)
    assert all("<secret>" not in got[i][0] for i in [*dull, 101, 102, 103])


def test_rows_without_id_keep_to_their_own_secrets(spark):
    value = "0f3a9c81d2e4b5f60718"
    rows = [(None, f"{PROSE} token = {value} {PROSE}", "s"), (None, f"{PROSE} shown {value[:8]}, {value} {PROSE}", "s"), (None, None, "s")]
    texts = [r.text or "" for r in secret_forest.masked(frame(spark, rows)).collect()]
    assert len(texts) == 3 and sum("<secret>" in t for t in texts) == 1 and sum(value in t for t in texts) == 1


def test_vectors_by_brute_force(spark):
    rng = np.random.RandomState(1)
    base = rng.normal(size=(40, 10))
    x = np.vstack([base, base[:20] + rng.normal(size=(20, 10)) * 0.25, np.repeat(base[:1], 5, 0) * 3])
    rows = [(i, v.tolist(), "k") for i, v in enumerate(x)]
    odd_rows = [(900, None, "k"), (901, [], "k"), (902, [0.0] * 10, "k"), (903, [float("nan")] * 10, "k"), (904, [1.0, None], "k"),
                (905, [float("inf")] * 10, "k"), (None, x[0].tolist(), "k"), (906, [1.0], "k"), (907, [2.0], "k")]
    schema = "vec_id long, embedding array<double>, id string"
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    for tile in (16_384, 7):
        before, subspace_join.TILE_ROWS = subspace_join.TILE_ROWS, tile
        got = {r.vec_id: r for r in subspace_join.near_vectors(spark.createDataFrame(rows + odd_rows, schema)).collect()}
        subspace_join.TILE_ROWS = before
        assert len(got) == len(rows) + len(odd_rows)
        names = np.arange(len(x))
        for _ in range(len(x)):
            names = np.array([names[link[i]].min() for i in range(len(x))])
        for i in range(len(x)):
            assert (got[i].n_links, got[i].component_id) == (link[i].sum() - 1, names[i])
        assert all((got[i].n_links, got[i].kept) == (0, True) for i in [*range(900, 906), None])
        assert got[907].component_id == 906
    assert subspace_join.near_vectors(spark.createDataFrame([], schema)).count() == 0


def _shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates_by_brute_force(spark, odd, none):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 150))]
        for _ in range(rng.randint(1, 7)):
            copy = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.01, 0.03]) else w for w in words]
            texts.append(" ".join(copy))
    texts += ["one two", "One  TWO", "three"]
    rng.shuffle(texts)
    sets = [_shingles(t) for t in texts]
    name = list(range(len(texts)))
    for _ in texts:
        name = [min(name[j] for j in range(len(texts)) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])) for i in range(len(texts))]
    got = by_id(fast_minhash.near_duplicates(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])), "n_shingles", "component_id", "kept")
    assert got == {i: (len(sets[i]), name[i], name[i] == i) for i in range(len(texts))}

    got = fast_minhash.near_duplicates(odd)
    assert got.count() == odd.count()
    kept = by_id(got.where("doc_id IS NOT NULL"), "component_id")
    assert kept == {1: (1,), 2: (2,), 3: (3,), 4: (4,), 7: (7,), 8: (7,), 9: (4,), 10: (10,), 11: (10,)}
    assert fast_minhash.near_duplicates(none).count() == 0
    left = fast_minhash.without_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 1, 2, 3, 4, 7, 10]


def test_sketch_is_unbiased():
    rng = np.random.RandomState(2)
    for n in (3, 40, 5_000):
        base = rng.randint(0, 2**62, 2 * n).astype(np.uint64)
        x, y = np.sort(base[: n + n // 2]), np.sort(base[n // 2 :])
        agree = (fast_minhash.sketch(x) == fast_minhash.sketch(y)).mean()
        assert abs(agree - len(np.intersect1d(x, y)) / len(np.union1d(x, y))) < 0.06


def test_sketch_bits_lose_fewer_links_than_bands():
    from math import comb

    n = fast_minhash.COORDINATES
    lost = sum(comb(n, i) * 7**i for i in range(fast_minhash.LEAST_BITS)) / 8**n
    assert lost < (1 - 0.75**fast_minhash.ROWS) ** fast_minhash.BANDS / 10


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(30)] + [(5, None), (9, 9)]
    got = {r.id: r.component_id for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    name = {x: x for e in edges if e[1] is not None and e[0] != e[1] for x in e}
    for _ in name:
        for a, b in edges:
            if b is not None and a != b:
                name[a] = name[b] = min(name[a], name[b])
    assert got == name


def test_token_counts(spark, odd, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.MODEL)
    got = token_counts.token_counts(odd)
    assert got.count() == odd.count()
    want = {r.doc_id: (len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in odd.collect()}
    assert {k: v for k, v in by_id(got, "n_bytes", "n_tokens").items() if k} == {k: v for k, v in want.items() if k}
    assert token_counts.token_counts(none).count() == 0
    for text in ("a  b " * 40, " a" * 99, "x▁ y z " * 30, "é à b c " * 50, PROSE * 3, "a" * 500):
        assert sum(len(model.encode(p)) for p in token_counts.safe_parts(text, 40)) == len(model.encode(text))


def test_byte_bpe_against_the_library(spark, odd, none):
    import tiktoken

    known = byte_bpe._vocabulary(byte_bpe.RANKS)
    library = tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=known.ranks, special_tokens={})
    rng = random.Random(8)
    texts = ["", "a" * 3000, "the" * 300, "".join(rng.choice("acgt") for _ in range(900)), "漢字仮名交じり文" * 30, "=" * 999, " " * 200,
             "x  y\n\n z\x85\xa0q ²½Ⅷ", "\x1c\x1da", "🙂" * 30, "don't I'LL <|endoftext|>", PROSE]
    texts += ["".join(rng.choice("aeth ") for _ in range(rng.randint(1, 300))) for _ in range(80)]
    coded = byte_bpe.encoded(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]))
    got = by_id(coded, "n_tokens", "ids", "decoded")
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t)
        assert got[i] == (len(ids), np.array(ids, "<u4").tobytes(), t.encode()), t[:40]
    assert by_id(byte_bpe.decoded(coded), "decoded") == {i: (t.encode(),) for i, t in enumerate(texts)}
    assert byte_bpe.encoded(none).count() == 0
    assert byte_bpe.encoded(odd).where("n_tokens = 0").count() == 3


def test_byte_bpe_worker_holds_little_after_a_task(monkeypatch):
    """What one task learnt does not stay beside the stages that follow; the next task's ids are the same."""
    import tiktoken

    monkeypatch.setattr(byte_bpe, "REMEMBERED_IDLE", 100)
    monkeypatch.setattr(byte_bpe, "_LOADED", {})
    rng = random.Random(11)
    texts = [None, " ".join("".join(rng.choice("aethqxz") for _ in range(rng.randint(2, 9))) for _ in range(3000)), PROSE]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": texts})
    library = None
    for _ in range(3):
        (got,) = byte_bpe._encode_batches(iter([batch]), byte_bpe.RANKS, byte_bpe.PATTERN)
        known = byte_bpe._vocabulary(byte_bpe.RANKS)
        assert len(known.number) == len(known.ids) == len(known.texts) == 100 and known.db is None
        library = library or tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=known.ranks, special_tokens={})
        assert got["ids"].to_pylist() == [np.array(library.encode_ordinary(t or ""), "<u4").tobytes() for t in texts]
        assert got["decoded"].to_pylist() == [(t or "").encode() for t in texts]
    failing = (b for b in [batch, None])
    with pytest.raises(TypeError):
        list(byte_bpe._encode_batches(failing, byte_bpe.RANKS, byte_bpe.PATTERN))
    assert len(known.number) == 100 and known.db is None


PAGE = (
    '<html><head><title>x</title></head><body><header><h1>Site</h1></header><div class="menu">a b c d e f g h i</div>'
    "<div>Welcome to the big site of all the good things you read</div><div>{}</div><footer>c</footer></body></html>"
)


@pytest.mark.parametrize("shard", [400_000, 15])
def test_main_text(spark, shard):
    article = (
        '<article><header><h1>T &lt;1&gt;</h1>by me</header><p>A<br>b\n c<p>D<script>var x="<p>";</script><aside>no</aside>'
        '<div class="comments"><div>c1</div>c2</div><form>f</form><p>E</article>tail'
    )
    rows = [
        (1, "http://A.com/1", PAGE.format("unique one two three")), (2, "http://a.com/2", PAGE.format("other four five &amp; six")),
        (3, None, PAGE.format("x")), (4, "http://b.com", None), (5, "http://b.com", article), (2, "http://a.com/2", PAGE.format("other four five &amp; six")),
        (None, "http://[bad", "<p>hi there"), (6, "", ""), (7, "http://c", "<p>" + "long " * 50_000), (8, "http://c", "a < b <p unclosed"),
    ]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    before, host_suffixes.TOKENS_PER_SHARD = host_suffixes.TOKENS_PER_SHARD, shard
    got = sorted(((r.page_id or 0, r.text) for r in host_suffixes.main_text(pages).collect()))
    host_suffixes.TOKENS_PER_SHARD = before
    assert got == [
        (0, "hi there"), (1, "unique one two three"), (2, "other four five & six"), (2, "other four five & six"),
        (3, "Welcome to the big site of all the good things you read\nx"), (4, ""), (5, "T <1>\nA b c\nD\nE"), (6, ""),
        (7, ("long " * 50_000).strip()), (8, "a < b <p unclosed"),
    ]
    assert host_suffixes.main_text(pages.where("false")).count() == 0


@pytest.mark.parametrize("shard", [400_000, 15])
def test_main_text_loses_no_article(spark, shard):
    """A story under two addresses, a paragraph quoted once, teasers and comments marked up as articles."""
    story, body, quoted, note = (" ".join(f"{k}{i}" for i in range(n)) for k, n in (("s", 80), ("b", 60), ("q", 12), ("n", 9)))
    page = lambda *parts: "<body>" + "".join(f"<div>{p}</div>" for p in parts)
    rows = [
        (1, "http://two.com/s", page(story)), (2, "http://two.com/s?utm_source=feed", page(story)),
        (3, "http://near.com/1", page(story, "one")), (4, "http://near.com/2", page(story, "two")),
        *((10 + i, f"http://many.com/{i}", page(note, quoted if i < 2 else "", f"p{i} alone")) for i in range(6)),
        (20, "http://t.com/", f"{page(body)}<article>short teaser</article>"),
        (21, "http://c.com/", f'{page("kept")}<article class="comment">me too</article><article>{body}<article class="comment">no</article></article>'),
        (22, "http://d.com/", '<article class="teaser">all there is</article>'),
        (23, "http://e.com/", f"{page(body)}<article>{story}</article>tail"),
    ]
    before, host_suffixes.TOKENS_PER_SHARD = host_suffixes.TOKENS_PER_SHARD, shard
    got = {r.page_id: r.text for r in host_suffixes.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    host_suffixes.TOKENS_PER_SHARD = before
    assert got == {
        1: story, 2: story, 3: f"{story}\none", 4: f"{story}\ntwo", 20: f"{body}\nshort teaser", 21: body, 22: "all there is",
        23: f"{body}\n{story}", 10: f"{quoted}\np0 alone", 11: f"{quoted}\np1 alone",
        **{10 + i: f"p{i} alone" for i in range(2, 6)},
    }


@pytest.mark.parametrize("shard", [400_000, 15])
def test_runs_decide_inside_articles(spark, shard):
    """What markup rules out on most pages of a host is no part of the two articles that hold it without a name."""
    line = lambda k, n=12: " ".join(f"{k}{i}" for i in range(n))
    notice, quote, lone, banner, head = line("n"), line("q"), line("l"), line("b", 25), line("h")
    article = lambda *parts: "<article>" + "".join(p if p[0] == "<" else f"<p>{p}</p>" for p in parts) + "</article>"
    ruled = f"<aside>{notice}</aside><footer>{lone}</footer><nav>{head}</nav>"
    rows = [
        *((i, f"http://a.com/{i}", ruled + article(f"own {i}", quote)) for i in range(1, 5)),
        (5, "http://a.com/5", article(f"<h1>{head}</h1>", line("x"), notice, lone, line("y"))),
        (6, "http://a.com/6", article(f"<h1>{head}</h1>", notice, quote, f"he said {notice}")),
        (7, "http://a.com/7", article(notice)),
        (8, "http://a.com/7?again", article(notice)),
        # Ruled out on one page only; on another host; equal text counts as one article.
        (10, "http://b.com/1", ruled + article("one")), (11, "http://b.com/2", article(notice, "two")), (12, "http://b.com/3", article(notice, "three")),
        (20, "http://c.com/1", ruled + article("one")), (21, "http://c.com/2", ruled + article("two")),
        (22, "http://c.com/3", article(notice, "same")), (23, "http://c.com/4", article(notice, "same")),
        # Open text beside articles is a host's, whatever the articles say; runs end with the open text.
        *((30 + i, f"http://d.com/{i}", f"<div>{banner}</div>" + article(f"own {i}")) for i in range(3)),
        *((40 + i, f"http://e.com/{i}", f"<nav>{line('m', 7)}</nav><p>text {i} ends") for i in range(3)),
    ]
    before, host_suffixes.TOKENS_PER_SHARD = host_suffixes.TOKENS_PER_SHARD, shard
    got = {r.page_id: r.text for r in host_suffixes.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    host_suffixes.TOKENS_PER_SHARD = before
    assert got == {
        **{i: f"own {i}\n{quote}" for i in range(1, 5)},
        5: f"{head}\n{line('x')}\n{lone}\n{line('y')}", 6: f"{head}\n{quote}\nhe said {notice}", 7: notice, 8: notice,
        10: "one", 11: f"{notice}\ntwo", 12: f"{notice}\nthree", 20: "one", 21: "two", 22: f"{notice}\nsame", 23: f"{notice}\nsame",
        **{30 + i: f"own {i}" for i in range(3)}, **{40 + i: f"text {i} ends" for i in range(3)},
    }


def test_suffix_order_by_brute_force():
    rng = np.random.RandomState(3)
    tokens = rng.randint(0, 3, 200)
    order, rank = host_suffixes.suffix_order(tokens, 5)
    keys = [tuple(tokens[i : i + 5]) for i in range(200)]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(200) for j in range(0, 200, 7))


def test_tool_calls(spark):
    call = lambda i, args, name="f": f'[{{"name":"{name}","id":"{i}","arguments":{args}}}]'
    rows = [
        (1, 0, "user", "hi", None, None), (1, 1, "assistant", None, call("a", '{"y":2.50,"x":1}'), None), (1, 2, "tool", "r", None, "a"),
        (1, 3, "tool", "again", None, "a"), (1, 4, "assistant", "t", call("b", '{"x":1,"y":"$ref:a"}'), None),
        (1, 5, "assistant", None, call("c", '{"z":1}'), None), (1, 6, "tool", "?", None, "nobody"),
        (2, 0, "assistant", None, call("p", '{"x":1,"y":"$ref:q"}'), None), (2, 1, "assistant", None, call("q", '{"x":1,"y":"$ref:p"}'), None),
        (2, 2, "assistant", None, "broken", None), (2, 3, "assistant", None, "[]", None), (2, 4, "assistant", None, call("g", "{}", "other"), None),
        (None, None, None, None, None, None), (None, 1, "assistant", None, call("a", '{"x":"s"}'), None), (1, 0, "user", "hi", None, None),
    ]
    schema = "conv_id long, turn long, role string, content string, tool_calls string, tool_call_id string"
    tools = {"f": {"x": {"type": "integer", "required": True}, "y": {"type": "string"}}}
    frame_ = spark.createDataFrame(rows, schema).withColumn("id", F.lit(1)).withColumn("level", F.lit("z"))
    got = tool_calls.formatted(frame_, tools).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): (r.level, r.status) for r in got}
    assert by[1, 1] == (0, "type:y") and by[1, 2] == (1, "") and by[1, 3] == (1, "repeated") and by[1, 4] == (2, "unanswered")
    assert by[1, 5] == (0, "extra:z,missing:x,unanswered") and by[1, 6] == (0, "orphan") and by[2, 2] == (0, "malformed")
    assert by[2, 0] == by[2, 1] == (None, "circular,unanswered") and by[2, 3] == (0, "") and by[2, 4] == (0, "unanswered,unknown_tool")
    assert by[None, None] == (0, "")
    text = {(r.conv_id, r.turn): r.json for r in got}
    assert text[1, 1] == '{"role":"assistant","tool_calls":[{"arguments":{"x":1,"y":2.5},"id":"a","name":"f"}]}'
    assert text[1, 2] == '{"content":"r","role":"tool","tool_call_id":"a"}'
    assert tool_calls.formatted(frame_.where("false"), tools).count() == 0


def test_many_results_of_one_call_stream(spark):
    call = '[{"name":"f","id":"a","arguments":{}}]'
    rows = [(1, 0, "assistant", None, call, None), (1, 10_000, "assistant", None, call.replace('"a"', '"b"'), None)]
    rows += [(1, t, "tool", "r", None, "a") for t in range(1, 3000)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string, tool_calls string, tool_call_id string")
    built = []
    join = type(messages).join

    def seen(left, right, *more):
        if any("shuffle_hash" in str(x) for x in (right._jdf.queryExecution().logical().toString().split("\n")[0],)):
            built.append(right.columns)
        return join(left, right, *more)

    type(messages).join = seen
    try:
        got = tool_calls.formatted(messages, {"f": {}}).groupBy("status").count().collect()
    finally:
        type(messages).join = join
    assert built == [["conv_id", "id", "called"]]
    assert {r.status: r["count"] for r in got} == {"": 2, "repeated": 2998, "unanswered": 1}


def test_pipeline_by_brute_force(spark, folder):
    """Each stage's decisions against SQL or a plain program on its own input."""
    con = connect(folder)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({SQL['op1_quality_rules']}) WHERE kept").fetchall()}
    sets = {i: _shingles(docs[i].text) for i in good}
    name = {i: i for i in good}
    links = [(i, j) for i in good for j in good if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    for _ in range(10):
        for i, j in links:
            name[i] = name[j] = min(name[i], name[j])
    stays = {i for i in good if name[i] == i}
    out = by_id(corpus_pipeline.run(spark, folder), "ids")
    assert set(out) == stays
    secret = secret_forest.findings(spark.read.parquet(f"{folder}/documents.parquet")).where("is_secret")
    having = {r.doc_id for r in secret.collect()}
    import tiktoken

    known = byte_bpe._vocabulary(byte_bpe.RANKS)
    library = tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=known.ranks, special_tokens={})
    for i in stays - having:
        assert np.frombuffer(out[i][0], "<u4").tolist() == library.encode_ordinary(docs[i].text)
    for i in stays & having:
        assert "<secret>" in library.decode(np.frombuffer(out[i][0], "<u4").tolist())
    empty = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0

"""Main text of web pages: zones from the markup, and host suffix arrays for open text and notices in articles."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import arrow, saved, ship

# Runs of so many tokens or more can be boilerplate, if they stand on two different pages of a host at least
# and on this share of its different pages.
WINDOW = 8
SHARE = 0.5
# A repeated run of so many tokens can be an article under several addresses: its first copy stays, and on
# hosts with fewer different pages than FEW_PAGES, where a share says little, every copy.
ARTICLE_TOKENS = 50
FEW_PAGES = 5
# A block of so many tokens that no run covers is prose: it stays beside an article element, too.
PROSE_TOKENS = 20
# Tokens of one host that one task sorts; hosts with more are dealt over several tasks.
TOKENS_PER_SHARD = 100_000

# Elements of HTML by what they do to the text.
BLOCKS = set(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
NESTING = set(
    "article aside blockquote body button details dialog div fieldset figure footer form header html main menu nav "
    "noscript ol search section select svg table template ul iframe object canvas video audio".split()
)
NEVER = set(
    "aside audio button canvas dialog fieldset footer form iframe menu nav noscript object search select svg template "
    "video".split()
)
RAW = set("script style textarea title xmp noembed noframes".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NAMES = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion related "
    "replies respond share sharing sidebar social sponsor sponsored subscribe widget".split()
)

# Names, alone in a class, of article elements that are not the page's article.
ARTICLE_NAMES = set("ad ads advert advertisement adverts comment comments related replies reply teaser teasers".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def _named_out(attributes: str) -> bool:
    """The class, id or role says that an element is not part of an article."""
    for m in ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in ROLES:
                return True
            continue
        for name in value.split():
            parts = re.split(r"[-_]+", name)
            if parts[0] not in ("has", "with", "no", "without") and (parts[0] in NAMES or parts[-1] in NAMES):
                return True
    return False


def _named_aside(attributes: str) -> bool:
    """The class says that an article element is a comment, a teaser or an advert."""
    classes = [m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes) if m[1].lower() == "class"]
    return any(name in ARTICLE_NAMES for value in classes for name in value.lower().split())


def blocks(page: str) -> list[tuple[str, str]]:
    """A page's blocks in order, each with its zone: ``main`` in an article or main element (``title`` in a heading
    there), ``open`` elsewhere if markup leaves it open, ``out`` if markup rules it out (menus, footers, forms and the like;
    for evidence only). Article elements that are named as comments, teasers or adverts are ``out``, unless the
    page has no other text.

    Each block's references are decoded, its white space is one space, and it is trimmed; empty ones go.
    """
    found: list[tuple[str, str]] = []
    words: list[str] = []
    stack: list[tuple[str, bool]] = []  # open elements, and whether each rules its content out
    ruled_out = within = head = asides = 0
    heading = titled = False
    at = 0

    def flush() -> None:
        if words:
            text = " ".join("".join(words).split())
            words.clear()
            if text:
                out = ruled_out and (asides or not (heading and within))
                kept = ("title" if titled else "main") if within else "open"
                found.append((("aside" if asides == ruled_out else "out") if out else kept, text))

    while True:
        m = TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece and not head:
            words.append(html.unescape(piece))
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closing = bool(m[1])
        if name in RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}\s*[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "head":
            head = 0 if closing else 1
            continue
        if name == "body":
            head = 0
        if name == "br":
            words.append(" ")
            continue
        if name in BLOCKS or name in NESTING:
            flush()
        if re.fullmatch("h[1-6]", name):
            # A heading in an article's own header belongs to the article.
            heading = not closing and bool(stack) and stack[-1] == ("header", True)
            titled = not closing
        if name not in NESTING and name != "header":
            continue
        if closing:
            if any(name == opened for opened, _ in stack):
                while stack:
                    opened, rules = stack.pop()
                    ruled_out -= rules
                    within -= opened in ("article", "main")
                    asides -= rules and opened == "article"
                    if opened == name:
                        break
        elif not m[3].rstrip().endswith("/"):
            rules = name in NEVER or name == "header" or (
                _named_aside(m[3]) if name == "article" else name not in ("html", "body", "main") and _named_out(m[3])
            )
            stack.append((name, rules))
            ruled_out += rules
            asides += rules and name == "article"
            within += name in ("article", "main")
    flush()
    last = "out" if any(zone in ("main", "title", "open") for zone, _ in found) else "main"
    return [(last if zone == "aside" else zone, text) for zone, text in found]


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


PARSED = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("blocks", pa.list_(pa.string())),
        ("zones", pa.list_(pa.string())), ("seen", pa.list_(pa.string())),
    ]
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for page, url, source in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"], strict=True):
            found = blocks(source.as_py() or "")
            kept = [(zone, text) for zone, text in found if zone != "out"]
            seen = [t for zone, t in found if zone == "out"]
            rows.append((page, url, host_of(url), [t for _, t in kept], [z for z, _ in kept], seen))
        columns = list(zip(*rows, strict=True)) or [[]] * len(PARSED)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PARSED, strict=True)], schema=PARSED)


def suffix_order(tokens: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of a token stream and each suffix's rank, both by the first ``length`` tokens.

    Prefix doubling: ranks by the first k tokens, taken at i and i + k, give those by 2 k.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    k = 1
    while k < length:
        step = min(k, length - k)
        behind = np.full(len(rank), -1, np.int64)
        behind[: len(rank) - step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 2) + behind + 1, return_inverse=True)[1].astype(np.int64)
        k += step
    return np.argsort(rank, kind="stable"), rank


MARKS = (
    "page_id long, host string, starts array<int>, spared array<boolean>, own_starts array<int>, own_hashes array<long>, "
    "in_article array<boolean>, kinds array<long>, holders array<long>, ruled array<long>, articles array<long>"
)


def _mark(group: pd.DataFrame) -> pd.DataFrame:
    """One shard of a host: where a window of a page's own text begins that enough of the host's pages hold.

    Of hosts with several shards: all windows of the own text, and each window of the shard once with the
    numbers of pages that hold it, for the count across shards. The pages' token streams are joined with a
    different mark after each and in place of each empty token, so no window runs over.
    """
    numbers: dict[str, int] = {}
    names: list[str] = []
    group = group.sort_values("page_id", kind="stable")
    for tokens in group["tokens"]:
        names += [*tokens, ""]
    stream = np.array([numbers.setdefault(t, len(numbers)) if t else -1 for t in names], np.int64)
    barred = stream < 0
    stream[barred] = -1 - np.flatnonzero(barred)
    sizes = group["tokens"].map(len).to_numpy() + 1
    starts = np.cumsum(sizes) - sizes
    page_of = np.repeat(np.arange(len(group)), sizes)
    start_of = np.arange(len(stream)) - starts[page_of]
    in_article = (start_of >= group["opened"].to_numpy()[page_of]) & (start_of < group["own"].to_numpy()[page_of])
    ruled_out = start_of >= group["own"].to_numpy()[page_of]
    marks = np.append(0, np.cumsum(barred))
    whole = np.zeros(len(stream), bool)
    whole[: max(0, len(stream) - WINDOW + 1)] = marks[WINDOW:] == marks[:-WINDOW]

    rank = suffix_order(stream, WINDOW)[1]

    def holders(where: np.ndarray) -> np.ndarray:
        """By rank: the pages that hold the window at one of these places."""
        held = np.unique(rank[where] * len(group) + page_of[where])
        return np.bincount(held // len(group), minlength=len(stream))

    beside, ruled, articles = holders(~in_article), holders(ruled_out), holders(in_article)
    # The first place of each window; places beside articles go before.
    order = np.lexsort((page_of, in_article, rank))
    leading = order[np.append(True, rank[order][1:] != rank[order][:-1])]
    lowest = page_of[leading]
    pages = int(group["pages"].iloc[0])
    enough = max(2, SHARE * pages)
    repeated = np.where(in_article, (ruled[rank] >= enough) & (articles[rank] > 1), beside[rank] >= enough)
    wide = group["shards"].iloc[0] > 1
    leaders = np.zeros(len(stream), bool)
    leaders[leading] = True
    digest = lambda i: xxhash.xxh3_64_intdigest("\x00".join(names[i : i + WINDOW])) - 2**63
    rows = []
    for p, (page, host, start, own, size) in enumerate(
        zip(group["page_id"], group["host"], starts, group["own"], sizes, strict=True)
    ):
        span = np.arange(start, start + size)
        span = span[whole[span]]
        own = span[span < start + own]
        mine = own[:0] if wide else own[repeated[own]]
        other, shown = (own, span[leaders[span]]) if wide else (own[:0], span[:0])
        spared = ~in_article[mine] & ((pages < FEW_PAGES) | (lowest[rank[mine]] == p))
        rows.append((
            page, host, start_of[mine].tolist(), spared.tolist(), start_of[other].tolist(), [digest(i) for i in other],
            in_article[other].tolist(), [digest(i) for i in shown], beside[rank[shown]].tolist(), ruled[rank[shown]].tolist(),
            articles[rank[shown]].tolist(),
        ))
    columns = ["page_id", "host", "starts", "spared", "own_starts", "own_hashes", "in_article", "kinds", "holders", "ruled", "articles"]
    return pd.DataFrame(rows, columns=columns)


def repeated_windows(streams: DataFrame) -> DataFrame:
    """(page_id, start, spared): where WINDOW tokens of a page's own text begin that are boilerplate of its host.

    ``streams`` has page_id, host, tokens and how many of these, the first ones, are ``opened`` and ``own``: open
    text, up to ``own`` text of articles, then what markup rules out. No window runs over an empty token. In open
    text a window counts that two pages of the host hold at least beside articles, and SHARE of its pages; it is
    spared, if an article-length run of such windows stays. In an article a window counts that markup rules out on so
    many pages, and that two articles hold at least.

    A host is dealt over as many tasks as its tokens ask for; each builds the suffix array of its pages. Hosts with one
    shard are counted there. Of hosts with several the windows are counted by their hash, in an aggregate
    with a map-side half: no host, however large, meets in one task.
    """
    ship(streams.sparkSession)
    sizes = streams.groupBy("host").agg(F.sum(F.size("tokens") + 1).alias("n"), F.count("*").alias("pages"))
    shards = sizes.select("host", "pages", F.ceil(F.col("n") / TOKENS_PER_SHARD).cast("int").alias("shards"))
    dealt = streams.join(shards, "host").withColumn("shard", F.pmod(F.xxhash64("page_id"), "shards"))
    # The join has dealt by host; without this all shards of a host would stay in its task.
    dealt = dealt.repartition("host", "shard")
    marks = saved(dealt.groupBy("host", "shard").applyInPandas(_mark, MARKS), "marks")
    local = marks.select("page_id", F.explode(F.arrays_zip("starts", "spared")).alias("w")).select("page_id", "w.starts", "w.spared")
    windows = marks.select(
        "host", "page_id", F.explode(F.arrays_zip("own_starts", "own_hashes", "in_article")).alias("w")
    ).select("host", "page_id", F.col("w.own_starts").alias("start"), F.col("w.own_hashes").alias("hash"), "w.in_article")
    # A shard shows a window by the first of its pages that holds it, beside articles where there is one.
    kinds = marks.select("host", "page_id", F.explode(F.arrays_zip("kinds", "holders", "ruled", "articles")).alias("w")).select(
        "host", "page_id", F.col("w.kinds").alias("hash"), "w.holders", "w.ruled", "w.articles"
    )
    enough = F.greatest(F.lit(2.0), SHARE * F.col("pages"))
    across = (
        kinds.groupBy("host", "hash")
        .agg(
            F.sum("holders").alias("holders"), F.sum("ruled").alias("ruled"), F.sum("articles").alias("articles"),
            F.min(F.when(F.col("holders") > 0, F.col("page_id"))).alias("lowest"),
        )
        .where("holders > 1").join(sizes.select("host", "pages"), "host").where(F.col("holders") >= enough)
        .withColumn("notice", (F.col("ruled") >= enough) & (F.col("articles") > 1))
    )
    spared = ~F.col("in_article") & ((F.col("pages") < FEW_PAGES) | F.col("page_id").eqNullSafe(F.col("lowest")))
    met = windows.join(across, ["host", "hash"]).where("notice OR NOT in_article").select("page_id", "start", spared.alias("spared"))
    return local.toDF("page_id", "start", "spared").union(met)


def _covered(n: int, marks: list[dict] | None) -> np.ndarray:
    """Which of n tokens go: those that repeated windows cover, without article-length runs that are spared."""
    covered, spared = np.zeros(n + WINDOW, bool), np.zeros(n + WINDOW, bool)
    for mark in marks or ():
        covered[mark["start"] : mark["start"] + WINDOW] = True
        if mark["spared"]:
            spared[mark["start"] : mark["start"] + WINDOW] = True
    covered[n:] = False
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (covered & spared).astype(np.int8), [0]))))
    for start, end in zip(edges[::2], edges[1::2], strict=True):
        if end - start >= ARTICLE_TOKENS:
            covered[start:end] = False
    return covered[:n]


def _unique_runs(blocks_: list[str], zones: list[str], asked: list[int] | None, marks: list[dict] | None) -> str:
    """A page's text: its article's blocks without notices, and open blocks without what is boilerplate, if they
    weigh enough. ``asked`` are the article's blocks that stand, in order, behind the open text in the arrays."""
    sizes = [len(b.split()) for b in blocks_]
    opened = sum(n for n, z in zip(sizes, zones, strict=True) if z == "open")
    covered = _covered(opened + sum(1 + sizes[i] for i in asked or ()), marks)
    gone, at = set(), opened
    for i in asked or ():
        at += 1
        if covered[at : at + sizes[i]].all():
            gone.add(i)
        at += sizes[i]
    # A page whose article is nothing but the notice is about it.
    if all(i in gone for i, z in enumerate(zones) if z != "open"):
        gone = set()
    left, at = [], 0
    for i, (block, zone) in enumerate(zip(blocks_, zones, strict=True)):
        words = [] if i in gone else block.split()
        if zone == "open":
            words, at = [w for w, out in zip(words, covered[at : at + len(words)], strict=True) if not out], at + len(words)
        left.append((zone == "open", len(words), " ".join(words)))
    article = sum(n for o, n, _ in left if not o)
    outweighs = sum(n for o, n, _ in left if o) > article
    return "\n".join(t for o, n, t in left if n and (not o or outweighs or n >= PROSE_TOKENS))


def _words(texts: Column) -> Column:
    return F.flatten(F.transform(texts, lambda b: F.split(b, " ")))


def asked_blocks(parsed: DataFrame) -> DataFrame:
    """(host, copy, asked): the articles' blocks that can be notices, by their places.

    Such a block is no heading, has WINDOW tokens at least, and its first ones stand where markup rules them out on two
    pages of the host. No other block can be covered by windows that do.
    """
    key = lambda words: F.xxhash64("host", words)
    seen = parsed.where("page_id IS NOT NULL").select("page_id", "host", _words(F.col("seen")).alias("words")).where(F.size("words") >= WINDOW)
    last = F.size("words") - WINDOW + 1
    ruled = seen.select("page_id", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: key(F.slice("words", i, WINDOW)))).alias("key"))
    known = ruled.groupBy("key").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).where("a <> b").select("key")
    places = (
        parsed.where("page_id IS NOT NULL").select("host", "copy", "zones", F.posexplode("blocks").alias("place", "block"))
        .where(F.get("zones", "place") == "main").withColumn("words", F.split("block", " ", WINDOW + 1))
        .where(F.size("words") >= WINDOW).select("host", "copy", "place", key(F.slice("words", 1, WINDOW)).alias("key"))
    )
    return places.join(known, "key", "left_semi").groupBy("host", "copy").agg(F.sort_array(F.collect_set("place")).alias("asked"))


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url and ``text``, its main text (empty if none).

    ``pages`` needs page_id, url and html (whole; null: empty); other columns are ignored. Blocks are joined
    in page order by one newline. Text inside an article or main element is the article; menus, headers,
    footers, asides, forms, scripts, notices, adverts and reader comments are ruled out by element, role or
    name wherever they are. Text elsewhere that markup leaves open is a candidate: its token stream goes before
    what is ruled out on that page into the suffix arrays of its host (see :func:`repeated_windows`), and
    boilerplate is removed from it: runs of WINDOW tokens or more on SHARE of the host's different pages, two at
    least. Pages with equal text count as one and keep the same. An article-length run stays in its first
    copy, and in all copies on a host with few pages. Open text that is left stays on a page without an article,
    on one where it has more tokens than the article, and else in blocks of PROSE_TOKENS.

    Articles may quote each other, so text inside one is not removed for being repeated there. A whole block of it goes
    (a notice or an advert without a name) if runs cover it that markup rules out on SHARE of the host's different
    pages, two at least, and that two of the host's articles hold; headings, parts of blocks, and the only blocks of an
    article stay.

    Broken markup is read as far as it goes. Pages are told apart by page_id: repeated rows of a page give
    repeated rows and don't count as two pages. A null url belongs to the host without a name. A page with a
    null id is evidence for nobody and keeps its own text. An empty table gives no rows.
    """
    parsed = saved(
        arrow(
            pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")),
            _parse,
            "page_id long, url string, host string, blocks array<string>, zones array<string>, seen array<string>",
        ),
        "pages",
    ).withColumn("copy", F.xxhash64("blocks", "zones"))
    # Pages of a host with equal text are one page, counted once under the smallest id.
    texts = parsed.where("page_id IS NOT NULL").select("page_id", F.struct("host", "copy", (F.size("blocks") > 0).alias("filled")).alias("t"))
    texts = texts.groupBy("page_id").agg(F.min("t").alias("t")).select("page_id", "t.*")
    alone = F.when(~F.col("filled"), F.col("page_id"))
    shown = texts.groupBy("host", "copy", alone).agg(F.min("page_id").alias("page_id")).select("host", "copy", "page_id")
    asked = saved(asked_blocks(parsed), "asked")
    open_blocks = F.filter("blocks", lambda b, i: F.get("zones", i) == "open")
    parts = F.transform(F.coalesce("asked", F.array().cast("array<int>")), lambda i: F.concat(F.array(F.lit("")), F.split(F.get("blocks", i), " ")))
    streams = (
        parsed.join(asked, ["host", "copy"], "left")
        .select("page_id", "host", "copy", _words(open_blocks).alias("open"), F.flatten(parts).alias("parts"), _words(F.col("seen")).alias("seen"))
        .join(shown, ["page_id", "host", "copy"], "left_semi").dropDuplicates(["page_id", "host", "copy"])
        .select(
            "page_id", "host", F.concat("open", "parts", F.array(F.lit("")), "seen").alias("tokens"),
            F.size("open").alias("opened"), (F.size("open") + F.size("parts")).alias("own"),
        )
    )
    starts = repeated_windows(streams.where("size(tokens) > 1"))
    marks = starts.groupBy("page_id").agg(F.collect_set(F.struct("start", "spared")).alias("marks"))
    decided = saved(marks.join(shown, "page_id").join(asked, ["host", "copy"], "left").select("host", "copy", "asked", "marks"), "decided")
    # A page without an id has no copy. What was decided is measured, as it was saved; it is small if notices are rare.
    known = F.when(F.col("page_id").isNotNull(), F.col("copy"))
    return arrow(
        parsed.withColumn("copy", known).join(decided, ["host", "copy"], "left").select("page_id", "url", "blocks", "zones", "asked", "marks"),
        _with_urls, "page_id long, url string, text string",
    )


def _with_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("blocks", "zones", "asked", "marks")]
        texts = [_unique_runs(*row) for row in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

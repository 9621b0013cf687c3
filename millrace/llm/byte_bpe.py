"""Byte-level BPE: DuckDB contracts and decodes the distinct pieces of each partition's texts."""

from __future__ import annotations

import array
import base64
from collections.abc import Iterator
from itertools import islice

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from millrace.llm.tables import arrow

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

# Pieces longer than this contract all places of a pair at once where the ranks allow it.
LONG_PIECE = 96
# Rounds of one query over long pieces; the rest goes on in the next one, so rounds don't pile up.
ROUNDS_AT_ONCE = 48
# Bounds on what a Python worker holds: pieces it remembers, in a task and after it, pieces or bytes of text per step.
REMEMBERED = 300_000
REMEMBERED_IDLE = 50_000
PIECES_AT_ONCE = 25_000
BYTES_AT_ONCE = 4_000_000

# A word's tokens are rows (w, pos, len, tok, nxt, r): byte position and length, id, the next token's id
# and the rank of the pair they make. Each round finds the smallest rank and its leftmost position per word,
# contracts that pair, and looks up the ranks of the two pairs that changed. Words without a pair left
# come out with live = false and are not looked at again.
CONTRACT = """
WITH RECURSIVE t(w, pos, len, tok, nxt, r, live) AS (
  SELECT w, pos, 1, tok, nxt, r, true
  FROM (SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM pieces)
  LEFT JOIN merges ON k = tok::BIGINT * 1048576 + nxt
  UNION ALL
  SELECT w, pos, len, tok, nxt, CASE WHEN touched THEN m.r ELSE s.r END, live
  FROM (
    WITH best AS (
      SELECT w, min(r::BIGINT * 4294967296 + pos) AS b, arg_min(len, r::BIGINT * 4294967296 + pos) AS first_len
      FROM t WHERE live GROUP BY w
    ), q AS MATERIALIZED (
      SELECT t.w, pos, len, tok, nxt, r, b // 4294967296 AS rank, b % 4294967296 AS place, first_len
      FROM t JOIN best USING (w) WHERE live
    ), second AS MATERIALIZED (
      SELECT w, nxt, len FROM q WHERE pos = place + first_len
    )
    SELECT w, pos, live, r, hit OR before AS touched,
           CASE WHEN hit THEN len + second_len ELSE len END AS len,
           CASE WHEN hit THEN rank ELSE tok END AS tok,
           CASE WHEN hit THEN second_nxt WHEN before THEN rank ELSE nxt END AS nxt,
           CASE WHEN hit THEN rank * 1048576 + second_nxt WHEN before THEN tok::BIGINT * 1048576 + rank END AS k
    FROM (
      SELECT q.*, rank IS NOT NULL AS live, coalesce(pos = place, false) AS hit,
             coalesce(pos + q.len = place, false) AS before, second.nxt AS second_nxt, second.len AS second_len
      FROM q LEFT JOIN second ON second.w = q.w AND q.pos = place
      WHERE coalesce(pos <> place + first_len, true)
    )
  ) s LEFT JOIN merges m ON m.k = s.k
)
"""

# The same for long pieces, with windows. A rank is safe if no token that is made with that token has a
# smaller rank: then contracting one place can't make a smaller pair, so the other places follow at once
# (every other one where they overlap). Otherwise only the leftmost place is contracted.
CONTRACT_LONG = """
WITH RECURSIVE t(w, pos, tok, live, round) AS (
  SELECT w, pos, tok, true, 0 FROM pieces
  UNION ALL
  SELECT w, pos, CASE WHEN hit THEN rank ELSE tok END, rank IS NOT NULL, round + 1
  FROM (
    SELECT *, coalesce(lag(hit) OVER (PARTITION BY w ORDER BY i), false) AS gone
    FROM (
      SELECT *, here AND CASE WHEN safe THEN (i - min(i) OVER (PARTITION BY w, island)) % 2 = 0
                              ELSE i = min(i) FILTER (here) OVER (PARTITION BY w) END AS hit
      FROM (
        SELECT *, coalesce(r = rank, false) AS here,
               CASE WHEN r = rank THEN i - row_number() OVER (PARTITION BY w, r = rank ORDER BY i) ELSE -1 END AS island
        FROM (
          SELECT w, pos, tok, round, i, r, min(r) OVER (PARTITION BY w) AS rank,
                 coalesce(arg_min(is_safe, r) OVER (PARTITION BY w), false) AS safe
          FROM (
            SELECT w, pos, tok, round, row_number() OVER (PARTITION BY w ORDER BY pos) AS i,
                   lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt
            FROM t WHERE live AND round < {rounds}
          ) LEFT JOIN merges ON k = tok::BIGINT * 1048576 + nxt
        )
      )
    )
  ) WHERE NOT gone
)
"""

RESULT = """
SELECT w, string_agg(code, '' ORDER BY pos) AS ids, string_agg(hex, '' ORDER BY pos) AS text
FROM t JOIN tokens ON tokens.id = tok WHERE NOT live GROUP BY w ORDER BY w
"""


class _Numbers(dict):
    """Piece to number; a piece met for the first time gets the next one and is noted as new."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        at = len(self)
        self[piece] = at
        return at


class Vocabulary:
    """The rank table in a DuckDB of its own, in memory, and the pieces encoded so far.

    The database is there while a task needs it. Spark lets a worker live on after its task, beside the stages that follow.
    """

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.ranks = ranks
        made = [
            (ranks[t[:i]], ranks[t[i:]], r)
            for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        left, right, to = (np.array(c, np.int64) for c in zip(*made, strict=True))
        unsafe = np.union1d(left[to < left], right[to < right])
        self.merges = {"k": left * 1048576 + right, "r": to.astype(np.int32), "is_safe": ~np.isin(to, unsafe)}
        self.db: duckdb.DuckDBPyConnection | None = None
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.number = _Numbers()
        self.ids: list[bytes] = []
        self.texts: list[bytes] = []

    def _open(self) -> None:
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self._table("merges", **self.merges)
        # The code is the id as it is written out: four bytes, the low one first.
        codes = [r.to_bytes(4, "little").hex() for r in self.ranks.values()]
        self._table("tokens", id=np.array(list(self.ranks.values()), np.int32), hex=[t.hex() for t in self.ranks], code=codes)

    def rest(self) -> None:
        """Hold little until the next task: the first pieces, no database."""
        self.keep(REMEMBERED_IDLE)
        if self.db is not None:
            self.db.close()
            self.db = None

    def _table(self, name: str, **columns) -> None:
        rows = pa.table(columns)  # noqa: F841  read by name in the statement
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM rows")

    def keep(self, most: int) -> None:
        """Forget all but the first pieces: what came early is what is common."""
        self.number = _Numbers(islice(self.number.items(), most))
        del self.ids[most:], self.texts[most:]

    def _query(self, statement: str):
        return self.db.execute(statement).fetchall()

    def _pieces(self, flat: np.ndarray, lens: np.ndarray) -> None:
        w = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
        pos = (np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int64)
        self._table("pieces", w=w, pos=pos, tok=self.bytes[flat])

    def encode(self, pieces: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Ids (little-endian, 32 bits) of each piece and the bytes they decode to."""
        ids: list[bytes] = [b""] * len(pieces)
        texts: list[bytes] = [b""] * len(pieces)
        if self.db is None:
            self._open()
        short, long = [], []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                # A piece that is a token is that token, whatever its merges would give.
                ids[i], texts[i] = whole.to_bytes(4, "little"), piece
            else:
                (short if len(piece) <= LONG_PIECE else long).append(i)
        for chosen, contract in ((short, self._short), (long, self._long)):
            for start in range(0, len(chosen), PIECES_AT_ONCE):
                part = chosen[start : start + PIECES_AT_ONCE]
                raw = [pieces[i] for i in part]
                flat = np.frombuffer(b"".join(raw), np.uint8)
                self._pieces(flat, np.fromiter(map(len, raw), np.int64, len(raw)))
                for w, found, text in contract():
                    ids[part[w]] = bytes.fromhex(found)
                    texts[part[w]] = bytes.fromhex(text)
        return ids, texts

    def _short(self):
        return self._query(CONTRACT + RESULT)

    def _long(self):
        """Rounds in portions: what is still to be contracted after one is the start of the next."""
        self.db.execute("CREATE OR REPLACE TABLE done (w INTEGER, pos BIGINT, tok INTEGER)")
        while self._query("SELECT count(*) FROM pieces")[0][0]:
            self.db.execute(
                "CREATE OR REPLACE TABLE step AS "
                + CONTRACT_LONG.format(rounds=ROUNDS_AT_ONCE)
                + f"SELECT w, pos, tok, live FROM t WHERE NOT live OR round = {ROUNDS_AT_ONCE}"
            )
            self.db.execute("INSERT INTO done SELECT w, pos, tok FROM step WHERE NOT live")
            self.db.execute("CREATE OR REPLACE TABLE pieces AS SELECT w, pos, tok FROM step WHERE live")
        return self._query("WITH t AS (SELECT *, false AS live FROM done) " + RESULT)

    def learn(self, texts: list[str], split: regex.Pattern) -> list[array.array]:
        """The numbers of each text's pieces; pieces not met before are encoded."""
        if len(self.number) > REMEMBERED:
            self.keep(REMEMBERED // 2)
        number, out = self.number, []
        for text in texts:
            if len(text) > BYTES_AT_ONCE:
                found = (m.group() for m in split.finditer(text))
            else:
                found = split.findall(text)
            out.append(array.array("I", map(number.__getitem__, found)))
        new, number.new = number.new, []
        if new:
            ids, decoded = self.encode([piece.encode() for piece in new])
            self.ids += ids
            self.texts += decoded
        return out


# One per Python worker process and rank file; Spark reuses the process for later tasks.
_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes of text each, one row at least."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > start and size + (n or 0) > most:
            yield start, i
            start, size = i, 0
        size += n or 0
    if start < len(texts):
        yield start, len(texts)


ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
)


def _encode_batches(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str) -> Iterator[pa.RecordBatch]:
    known, split = _vocabulary(ranks), regex.compile(pattern)
    try:
        for batch in batches:
            for start, end in slices(batch["text"], BYTES_AT_ONCE):
                part = batch.slice(start, end - start)
                lines = known.learn(["" if t is None else t for t in part["text"].to_pylist()], split)
                ids = [b"".join(map(known.ids.__getitem__, line)) for line in lines]
                columns = (
                    part["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([b"".join(map(known.texts.__getitem__, line)) for line in lines], pa.binary()),
                )
                yield pa.RecordBatch.from_arrays(list(columns), schema=ENCODED)
    finally:
        known.rest()


def encoded(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit) and ``decoded``, the
    bytes that the ids stand for.

    ``docs`` needs doc_id and text; other columns are ignored. ``ranks`` names a rank file that every
    machine has. Each match of ``pattern`` is encoded by itself, special strings are ordinary text. In every
    Python worker the distinct pieces of a portion of texts become token rows in DuckDB, where recursive
    queries contract each one's leftmost pair of smallest rank until none is left; an ordered aggregation
    decodes them. A bounded number of pieces is remembered, so a word met again costs a look-up, and fewer of them
    after a task; nothing shuffles, and a lost task is simply run again.

    A null or empty text has no tokens. Repeated rows and null ids are encoded row by row; an empty table
    gives no rows.
    """

    return arrow(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        lambda batches: _encode_batches(batches, ranks, pattern),
        "doc_id long, n_tokens long, ids binary, decoded binary",
    )


def decoded(tokens: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Per row of ``tokens`` (doc_id, ids as ``encoded`` gives them): doc_id and the decoded bytes.

    Null or empty ids give empty bytes; an id that the rank file doesn't hold fails the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _vocabulary(ranks)
        parts = {r: t for t, r in known.ranks.items()}
        for batch in batches:
            found = [
                b"".join(map(parts.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in batch["ids"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.binary())], names=["doc_id", "decoded"])

    return arrow(tokens.select(F.col("doc_id").cast("long"), "ids"), run, "doc_id long, decoded binary")

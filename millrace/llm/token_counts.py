"""Token counts of whole texts by a public tokenizer library, lengths only."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.tables import arrow

MODEL = public_tokenizers.path("piece_bpe_32k.model")
# Characters of text in one call of the library, and the length from which a text is cut.
BATCH = 1_000_000
LONG = 200_000
SPACE = "▁"


def _sentencepiece(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    # A text may be cut at a lone space if no piece goes on behind one, and if a text's start gets the
    # mark that a space would have given.
    cuts = not any(SPACE in p.lstrip(SPACE) or " " in p for p in pieces)
    cuts = cuts and model.encode("a b", out_type=str) == model.encode("a", out_type=str) + model.encode("b", out_type=str)
    cuts = cuts and len(model.encode("a  b")) > len(model.encode("a b"))

    def counts(texts: list[str]) -> list[int]:
        return [len(ids) for ids in model.encode(texts, num_threads=1)]

    return counts, cuts


def _tokenizers(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()

    def counts(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]

    return counts, False


# One per Python worker process and file.
_LOADED: dict[str, tuple[Callable[[list[str]], list[int]], bool]] = {}


def _loaded(path: str):
    if path not in _LOADED:
        _LOADED[path] = (_sentencepiece if path.endswith(".model") else _tokenizers)(path)
    return _LOADED[path]


def safe_parts(text: str, most: int = LONG) -> list[str]:
    """A text cut at lone spaces into parts whose tokens are those of the whole.

    The space at a cut is left out, as the start of a part stands for it. The characters beside it are plain
    ASCII letters, digits or stops, so neither normalisation nor runs of spaces reach over the cut. Parts have
    about ``most`` characters; where no cut is safe, a part is longer.
    """
    parts, start = [], 0
    while len(text) - start > most:
        cut = text.find(" ", start + most)
        while cut != -1 and not (_plain(text[cut - 1]) and cut + 1 < len(text) and _plain(text[cut + 1])):
            cut = text.find(" ", cut + 1)
        if cut == -1:
            break
        parts.append(text[start:cut])
        start = cut + 1
    return [*parts, text[start:]]


def _plain(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c in ".,;:!?")


def count_all(texts: list[str], path: str) -> list[int]:
    """Token counts of texts, in calls of about the same number of characters each."""
    counts, cuts = _loaded(path)
    parts, owner = [], []
    for i, text in enumerate(texts):
        for part in safe_parts(text) if cuts and len(text) > LONG else [text]:
            parts.append(part)
            owner.append(i)
    out, start, size = [0] * len(texts), 0, 0
    for end in range(1, len(parts) + 1):
        size += len(parts[end - 1])
        if end == len(parts) or size + len(parts[end]) > BATCH:
            for i, n in zip(owner[start:end], counts(parts[start:end]), strict=True):
                out[i] += n
            start, size = end, 0
    return out


def token_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8) and n_tokens, both of the whole text.

    ``docs`` needs doc_id and text; other columns are ignored. ``model`` names a file that every machine
    has: ``.model`` for sentencepiece, ``.json`` for tokenizers. Texts go to the library in calls of about
    equal size, lengths alone come back; begin, end or other special tokens are not added, and nothing is
    truncated or padded. Long texts are cut only where the model's pieces make a cut safe (see
    :func:`safe_parts`), else encoded whole. Nothing shuffles. A null or empty text has no bytes or tokens;
    repeated rows and null ids are counted row by row; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = count_all([t or "" for t in batch["text"].to_pylist()], model)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], pa.array(found, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    read = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("text").cast("string"),
    )
    return arrow(read, run, "doc_id long, n_bytes long, n_tokens long")

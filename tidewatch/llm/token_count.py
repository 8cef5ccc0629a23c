"""Token counts of whole texts by overlap resynchronisation (operator 3).

A text of at most ``chunk`` characters is encoded at once.  A longer one is cut into chunks that
overlap by ``overlap`` characters.  Each chunk is encoded alone with byte offsets, and neighbours
are spliced after a token that both encodings hold with the same start and end inside the overlap.

Why such a splice is exact: byte-pair encoding by rank returns a token row if and only if every
two neighbouring tokens are what it returns for the two tokens' joined text (a merge across a
token's end must join a suffix of one token to a prefix of the next, and would already happen in
that pair alone).  All pairs left of the splice stand in the left encoding; the shared token and
its follower stand in the right one; so each pair of the spliced row is proven, and with them the
whole row.  Where the overlap holds no shared token, it is doubled and the two chunks are encoded
again, up to the point where they form one chunk.

Memory: one text, its chunk ids and the word memo (``tokens.MEMO_WORDS`` words).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches, table, texts_of
from tidewatch.llm.tokens import PieceIds, loaded

CHUNK = 16_384  # characters
OVERLAP = 256
LIMIT = 4096  # tokens


def spliced_ids(tok: PieceIds, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
    """Ids of a non-empty text, encoded chunk by chunk and spliced at proven boundaries."""
    # a blank stands in front, and a blank mark in the text is a blank to the model, so it is one byte wide here too
    body = " " + text.replace("\u2581", " ")
    out: list[np.ndarray] = []
    at, have, have_at = 0, None, 0  # ids kept so far end before byte have_at of chunk `have`
    start = 0  # character where the current left chunk begins
    size = lambda s: len(s.encode())
    base = 0  # byte of `start`
    end = min(len(body), chunk)
    left = tok.bare_ids(body[:end])
    left_from = 0  # ids of the left chunk before this index are not taken
    while end < len(body):
        wide = overlap
        while True:
            cut = max(start + 1, end - wide)  # the right chunk begins here
            stop = min(len(body), cut + chunk + wide)
            right = tok.bare_ids(body[cut:stop])
            shift = size(body[start:cut])
            l_end = np.cumsum(tok.width[left])
            r_end = np.cumsum(tok.width[right]) + shift
            l_start, r_start = l_end - tok.width[left], r_end - tok.width[right]
            common, li, ri = np.intersect1d(l_start, r_start, return_indices=True)
            ok = (l_end[li] == r_end[ri]) & (left[li] == right[ri]) & (li >= left_from)
            # tokens that touch an artificial end are not used when another shared token exists
            hits = np.flatnonzero(ok)
            if len(hits):
                mid = hits[len(hits) // 2]
                break
            if cut == start + 1:  # widened to the whole left chunk: encode both as one
                stop = min(len(body), end + chunk)
                cut, right, mid = start, tok.bare_ids(body[start:stop]), None
                break
            wide *= 2
        if mid is None:
            left, end = right, stop  # same start, same left_from only if nothing was kept
            if left_from:
                return tok.bare_ids(body)  # a chunk that was cut already cannot be regrown
            continue
        out.append(left[left_from:li[mid] + 1])
        left, left_from = right, int(ri[mid]) + 1
        start, end = cut, stop
    out.append(left[left_from:])
    return np.concatenate(out)


def count_tokens(tok: PieceIds, texts: pa.Array, chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
    n = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    huge = n > chunk if tok.splits else np.zeros(len(n), dtype=bool)
    out = np.zeros(len(n), dtype=np.int64)
    if not huge.all():
        out[~huge] = tok.count(texts.filter(pa.array(~huge)))
    for i in np.flatnonzero(huge):
        out[i] = len(spliced_ids(tok, texts[int(i)].as_py(), chunk, overlap))
    return out


def with_token_counts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT,
                      chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; no shuffle.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null keys are counted each
    on its own; other columns are not read.  A text of any length is one row of one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(PieceIds, path)
        for b in small_batches(batches, "text"):
            texts = texts_of(b)
            n = count_tokens(tok, texts, chunk, overlap)
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("key"), size, pa.array(n), pa.array(n > limit)], names=["key", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    got = rows.mapInArrow(run, "key long, n_bytes long, n_tokens long, over_limit boolean")
    return got.withColumnRenamed("key", "doc_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over all documents with ``piece_bpe_32k.model``."""
    import public_tokenizers

    return with_token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))

"""Best-fit packing by a grouping genetic algorithm on islands (operator 2).

Texts become ids plus an end id; only those over the capacity are cut, into full pieces and a last
one.  Full pieces are sequences already.  The other pieces are dealt to shards of a bounded number
of pieces by a hash of their row.  Each shard has several islands, each a Spark group that holds a
small population of packings.  An epoch evolves every island; then each island's elite moves on to
the next one (a shuffle).  Crossover injects well-filled sequences of one parent whole into the
other, takes out the sequences that hold duplicates, and places the displaced pieces best-fit, from
the longest.  Every island takes all its steps, also where its first packing already has as few
sequences as the lengths allow: the fill may still be shifted into fewer of them.  After the last
epoch the best packing of each shard stands, but for its ill-filled
sequences: their pieces are pooled over all shards and packed again, level by level, until one shard
holds them.  Where most pieces lie in ill-filled sequences (long pieces that leave no room for another),
only the least filled sequence of each shard is packed again.  So the unavoidable rest is one sequence
in all, not one in each shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import TAKE_BYTES, give_back, small_batches, table, texts_of, written
from tidewatch.llm.tokens import WordIds, loaded

CAPACITY = 4096
END_ID = 1
SHARD_PIECES = 4096  # pieces in a shard, on average
ISLANDS = 2
EPOCHS = 2
POPULATION = 3
CHILDREN = 3  # a generation step per island and epoch
WELL_FILLED = 0.98  # sequences below it are packed again on the next level

PIECES = "doc_id long, uid long, piece int, start long, length long, ids_crc32 long"
STATE = "shard long, island int, elite boolean, uids binary, lens binary, bins binary, fitness double"


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, *keep: str, most: int = TAKE_BYTES) -> DataFrame:
    """(doc_id, uid, piece, start, length, ids_crc32) of every piece of every row; no shuffle.

    Null text counts as empty, and an empty text is the end id alone.  ``uid`` tells repeated rows
    apart.  Other columns are not read.  ``most``: bytes of text handled at a time; with less than ``TAKE_BYTES``, for
    workers that hold the memory of other stages too, no words are remembered after a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, uid = loaded(WordIds, tokenizer), TaskContext.get().partitionId() << 36
        for b in small_batches(batches, "text", most):
            ids, off = tok.encode(texts_of(b))
            n = np.diff(off) + 1
            cuts = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), cuts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * capacity
            length = np.minimum(n[row] - start, capacity)
            end = np.array([end_id], "<u4").tobytes()
            crc = [zlib.crc32(end if s + m == n[r] else b"", zlib.crc32(ids[off[r] + s:min(off[r] + s + m, off[r + 1])].tobytes())) for r, s, m in zip(row, start, length)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), pa.array(uid + np.arange(len(row))), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["doc_id", "uid", "piece", "start", "length", "ids_crc32"])
            uid += len(row)
        if most < TAKE_BYTES:
            tok.forget()
            give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


# --- one packing -------------------------------------------------------------------------


def best_fit(lens: np.ndarray, order, bins: list[list[int]], room: list[int], capacity: int) -> None:
    """Place the pieces, in the given order, where the least room is left; open a new bin if none fits."""
    by_room: dict[int, list[int]] = {}
    mask = 0
    for b, r in enumerate(room):
        if r:
            by_room.setdefault(r, []).append(b)
            mask |= 1 << r
    for i in order:
        n = int(lens[i])
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            own = by_room[r]
            b = own.pop()
            if not own:
                mask &= ~(1 << r)
        else:
            b, r = len(bins), capacity
            bins.append([])
            room.append(r)
        bins[b].append(i)
        room[b] = r = r - n
        if r:
            if not (own := by_room.setdefault(r, [])):
                mask |= 1 << r
            own.append(b)


def numbered(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, "<i4")
    for k, own in enumerate(bins):
        out[own] = k
    return out


def listed(assigned: np.ndarray) -> list[list[int]]:
    order = np.argsort(assigned, kind="stable")
    at = np.flatnonzero(np.diff(assigned[order])) + 1
    return [x.tolist() for x in np.split(order, at)] if len(order) else []


def fitness(assigned: np.ndarray, lens: np.ndarray, capacity: int) -> float:
    """Mean squared fill of the sequences, less a whole unit for each sequence (fewer always win)."""
    fill = np.bincount(assigned, weights=lens) / capacity
    return float((fill**2).mean() - len(fill)) if len(fill) else 0.0


def crossover(a: np.ndarray, b: np.ndarray, lens: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject some of the best-filled bins of ``a`` whole into ``b``."""
    fill_a = np.bincount(a, weights=lens)
    best = np.argsort(-fill_a, kind="stable")[: max(1, len(fill_a) // 2)]
    take = np.zeros(len(fill_a), bool)
    take[best[rng.random(len(best)) < 0.5]] = True
    injected = take[a]
    hit = np.zeros(int(b.max()) + 1, bool)
    hit[b[injected]] = True
    fill_b = np.bincount(b, weights=lens)
    hit[np.argsort(fill_b, kind="stable")[: max(1, len(fill_b) // 50)]] = True  # mutation: the worst bins go too
    loose = hit[b] & ~injected
    kept = ~hit[b] & ~injected
    bins = [x for x in listed(np.where(injected, a, -1)) if injected[x[0]]] + [x for x in listed(np.where(kept, b, -1)) if kept[x[0]]]
    room = [capacity - int(lens[x].sum()) for x in bins]
    displaced = np.flatnonzero(loose)
    best_fit(lens, displaced[np.argsort(-lens[displaced], kind="stable")].tolist(), bins, room, capacity)
    return numbered(bins, len(lens))


def first_packing(lens: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    """Best-fit from the longest piece; with noise, in a nearly sorted order."""
    order = np.argsort(-lens * (1 + noise * rng.random(len(lens))), kind="stable")
    bins: list[list[int]] = []
    best_fit(lens, order.tolist(), bins, [], capacity)
    return numbered(bins, len(lens))


# --- islands -----------------------------------------------------------------------------


def _rng(*parts: int) -> np.random.Generator:
    return np.random.default_rng([int(p) & 0xFFFFFFFF for p in parts])


def _states(shard, island, uids, lens, packings, capacity) -> pd.DataFrame:
    ranked = sorted(((fitness(p, lens, capacity), k) for k, p in enumerate(packings)), reverse=True)[:POPULATION]
    u, m = uids.astype("<i8").tobytes(), lens.astype("<i4").tobytes()
    return pd.DataFrame([{"shard": shard, "island": island, "elite": j == 0, "uids": u, "lens": m, "bins": packings[k].astype("<i4").tobytes(), "fitness": f} for j, (f, k) in enumerate(ranked)])


def _evolved(packings: list[np.ndarray], lens: np.ndarray, capacity: int, rng: np.random.Generator) -> list[np.ndarray]:
    for _ in range(CHILDREN):
        i, j = rng.choice(len(packings), 2, replace=len(packings) < 2)
        packings = [*packings, crossover(packings[i], packings[j], lens, capacity, rng)]
    return packings


def evolve(pieces: DataFrame, shards: int, level: int, capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """The best packing of each shard of the pieces (uid, length), a row of ``STATE`` each."""

    def begin(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True])
        uids, lens = pdf["uid"].to_numpy(np.int64), pdf["length"].to_numpy(np.int64)
        shard, island = int(pdf["shard"].iloc[0]), int(pdf["island"].iloc[0])
        rng = _rng(shard, island, level, 0)
        packings = [first_packing(lens, capacity, rng, 0.0 if k == 0 and island == 0 else 0.05) for k in range(POPULATION)]
        return _states(shard, island, uids, lens, _evolved(packings, lens, capacity, rng), capacity)

    def epoch(number: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["fitness", "bins"], ascending=False)
            first = pdf.iloc[0]
            uids, lens = np.frombuffer(first["uids"], "<i8"), np.frombuffer(first["lens"], "<i4").astype(np.int64)
            packings = [np.frombuffer(x, "<i4") for x in pdf["bins"]]
            rng = _rng(first["shard"], first["island"], level, number)
            return _states(first["shard"], first["island"], uids, lens, _evolved(packings, lens, capacity, rng), capacity)

        return run

    dealt = pieces.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)).alias("shard"))
    dealt = dealt.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    state = dealt.groupBy("shard", "island").applyInPandas(begin, STATE)
    for k in range(1, epochs):
        onward = (F.col("island") + 1) % F.lit(islands)
        to = F.when(F.col("elite") & (F.lit(islands) > 1), F.array(F.col("island"), onward)).otherwise(F.array("island"))
        state = state.withColumn("island", F.explode(to)).groupBy("shard", "island").applyInPandas(epoch(k), STATE)
    best = state.groupBy("shard").agg(F.max_by(F.struct("uids", "lens", "bins"), F.struct("fitness", "bins")).alias("best"))
    return best.select("shard", "best.*")


def _places(level: int, capacity: int, last: bool):
    """(uid, length, sequence_id, offset, again) of the pieces; again: 0, or in an ill-filled sequence 1, in the
    least filled one of its shard 2."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                uids, lens, bins = np.frombuffer(r.uids, "<i8"), np.frombuffer(r.lens, "<i4").astype(np.int64), np.frombuffer(r.bins, "<i4")
                order = np.argsort(bins, kind="stable")
                b, n = bins[order], lens[order]
                total = np.cumsum(n) - n
                head = np.concatenate([[True], b[1:] != b[:-1]])
                offset = total - np.repeat(total[head], np.diff(np.append(np.flatnonzero(head), len(b))))
                fill = np.bincount(bins, weights=lens)[b]
                seq = (level << 56) + (int(r.shard) << 20) + b.astype(np.int64)
                again = ((fill < WELL_FILLED * capacity) & (not last)).astype(np.int32)
                again[(again > 0) & (b == b[np.argmin(fill)])] = 2
                yield pd.DataFrame({"uid": uids[order], "length": n, "sequence_id": seq, "offset": offset, "again": again})

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Each piece (uid, length) with its sequence_id and offset.  Empty input gives no rows.

    ``pieces`` must be a stable table, such as one written before."""
    full = pieces.where(F.col("length") >= capacity).select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed, rest = [full], pieces.where(F.col("length") < capacity).select("uid", "length")
    left, level = rest.count(), 0
    while left:
        shards = max(1, -(-left // shard_pieces))
        got = evolve(rest, shards, level, capacity).mapInPandas(_places(level, capacity, shards == 1), "uid long, length long, sequence_id long, offset long, again int")
        got = written(got, "packing")
        ill, tails = got.agg(F.count_if(F.col("again") > 0), F.count_if(F.col("again") > 1)).first()
        if ill <= left // 2:
            again = F.col("again") > 0
        else:  # most pieces do not fill sequences well
            again, ill = F.col("again") > 1, tails
        if ill > left // 2:  # a sequence holds most of a shard; it has at most ``capacity`` pieces, so larger shards leave fewer
            shard_pieces = max(shard_pieces, 4 * capacity)
        placed.append(got.where(~again).select("uid", "sequence_id", "offset"))
        rest, left, level = got.where(again).select("uid", "length"), ill, level + 1
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, most: int = TAKE_BYTES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = written(pieces_of(docs, tokenizer, capacity, end_id, most=most), "pieces")
    return pieces.join(pack(pieces, capacity), "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all documents with ``word_bpe_49k.json``, 4096 tokens and end id 1."""
    import public_tokenizers

    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

"""Raw token-id shards with a minimal perfect hash index (operator 10).

Files, all written by Spark's Parquet writer (its commit protocol survives lost executors):

* ``payload/``  one row per shard: (part, seq, n_docs, n_ids, keys, copies, nulls, lengths, ids).
  ``ids`` is the raw little-endian id payload of the shard's documents in ascending key order
  (2 bytes an id if the vocabulary allows, else 4).  (part, seq) order is ascending key order.
* ``index/``    one row per hash bucket: (bucket, n_buckets, salt, n, seeds, prints, parts, seqs,
  offsets, lengths): a minimal perfect hash by displacement.  A key's group picks a seed, the seed
  and the key's hash pick its slot; the slot holds a 32-bit fingerprint, the shard and the place
  in it.  A lookup reads one bucket row and touches one seed and one slot, whatever the size.
  ``shared`` lists, with the key itself, the few keys whose 64-bit hash another key of the bucket has
  too; they are looked up there and stand in no slot.

A key is (doc_id, copy): rows that repeat a doc_id are told apart by their rank in text order.
Null doc_ids sort first and are keys too.
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

from tidewatch.llm.common import mix64, small_batches, table, texts_of, written
from tidewatch.llm.tokens import WordIds, loaded
from tidewatch.session import scratch_path

END_ID = 2
SHARD_IDS = 1 << 20  # ids in a shard, one longer document excepted
BUCKET_KEYS = 16_384  # keys that share a bucket row, on average
GROUP_KEYS = 4  # keys that share a displacement, on average

PAYLOAD = "part int, seq int, n_docs long, n_ids long, keys binary, copies binary, nulls binary, lengths binary, width int, ids binary"
INDEX = "bucket long, n_buckets long, salt long, n long, seeds binary, prints binary, parts binary, seqs binary, offsets binary, lengths binary, shared binary"
SHARED = np.dtype([("key", "<i8"), ("copy", "<i8"), ("null", "?"), ("part", "<i4"), ("seq", "<i4"), ("offset", "<i8"), ("length", "<i8")])


def key_hash(keys: np.ndarray, copies: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    h = mix64(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return mix64(h + copies.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + nulls.astype(np.uint64))


def _shard(part: int, seq: int, rows: list[tuple[int, int, bool, np.ndarray]], width: int) -> dict:
    ids = np.concatenate([r[3] for r in rows])
    return {
        "part": part, "seq": seq, "n_docs": len(rows), "n_ids": len(ids),
        "keys": np.array([r[0] for r in rows], "<i8").tobytes(), "copies": np.array([r[1] for r in rows], "<u4").tobytes(),
        "nulls": np.array([r[2] for r in rows], "u1").tobytes(), "lengths": np.array([len(r[3]) for r in rows], "<u4").tobytes(),
        "width": width, "ids": ids.astype(f"<u{width}").tobytes(),
    }


def write_payload(docs: DataFrame, out: str, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode whole texts and write the shards in ascending doc_id order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, seq = loaded(WordIds, tokenizer), TaskContext.get().partitionId(), 0
        width = 2 if max(tok.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        rows, held, last, copy = [], 0, (0, None), 0
        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), *[(c, pa.binary()) for c in ("keys", "copies", "nulls", "lengths")], ("width", pa.int32()), ("ids", pa.binary())])
        for b in small_batches(batches, "text"):
            ids, off = tok.encode(texts_of(b))
            for k, key in enumerate(b.column("key").to_pylist()):
                now = (key is None, key)
                copy = copy + 1 if now == last else 0
                last = now
                one = np.append(ids[off[k]:off[k + 1]], np.uint32(end_id))
                if rows and held + len(one) > shard_ids:
                    yield pa.RecordBatch.from_pylist([_shard(part, seq, rows, width)], schema)
                    rows, held, seq = [], 0, seq + 1
                rows.append((0 if key is None else key, copy, key is None, one))
                held += len(one)
        if rows:
            yield pa.RecordBatch.from_pylist([_shard(part, seq, rows, width)], schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    (rows.repartitionByRange("key").sortWithinPartitions("key", "text")
     .mapInArrow(run, PAYLOAD).write.option("compression", "zstd").parquet(out))


def _entries(pdf: pd.DataFrame) -> Iterator[tuple]:
    for r in pdf.itertuples(index=False):
        lengths = np.frombuffer(r.lengths, "<u4").astype(np.int64)
        yield (r, np.frombuffer(r.keys, "<i8"), np.frombuffer(r.copies, "<u4"), np.frombuffer(r.nulls, "u1"), lengths, np.cumsum(lengths) - lengths)


def perfect_hash(h: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(salt, seeds, slot of each key) of a minimal perfect hash over distinct 64-bit key hashes.

    Groups are placed from the largest; a group of one takes any free slot and stores it itself
    as a negative seed."""
    n = len(h)
    groups = max(1, -(-n // GROUP_KEYS))
    for salt in range(1, 100):
        g = (mix64(h ^ np.uint64(salt)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(g, kind="stable")
        at = np.searchsorted(g[order], np.arange(groups + 1))
        seeds, slots, used = np.zeros(groups, np.int32), np.full(n, -1, np.int64), np.zeros(n, bool)
        size = np.diff(at)
        ok = True
        for i in np.argsort(-size, kind="stable"):
            if size[i] < 2:
                break
            own = order[at[i]:at[i + 1]]
            for first in range(1, 1 << 20, 64):
                tries = np.arange(first, first + 64, dtype=np.uint64)[:, None]
                cand = (mix64(h[own][None, :] + tries * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)
                srt = np.sort(cand, axis=1)
                good = ~used[cand].any(axis=1) & (srt[:, 1:] != srt[:, :-1]).all(axis=1)
                if good.any():
                    t = int(np.argmax(good))
                    seeds[i], slots[own] = first + t, cand[t]
                    used[cand[t]] = True
                    break
            else:
                ok = False
                break
        if ok:
            free, single = np.flatnonzero(~used), np.flatnonzero(size == 1)
            seeds[single] = -free - 1
            slots[order[at[single]]] = free
            return salt, seeds, slots
    raise ValueError("two keys have the same hash")


def slot_of(h: np.ndarray, n: int, salt: int, seeds: np.ndarray) -> np.ndarray:
    seed = seeds[(mix64(h ^ np.uint64(salt)) % np.uint64(len(seeds))).astype(np.int64)].astype(np.int64)
    shifted = mix64(h + seed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)
    return np.where(seed < 0, -seed - 1, shifted.astype(np.int64))


def write_index(spark: SparkSession, payload: str, out: str, bucket_keys: int = BUCKET_KEYS) -> int:
    """Build the index from the payload's keys; returns the number of buckets."""
    shards = spark.read.schema(PAYLOAD).parquet(payload)
    n_keys = shards.agg(F.sum("n_docs")).first()[0] or 0
    buckets = max(1, -(-n_keys // bucket_keys))

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r, k, c, z, lengths, offsets in _entries(pdf):
                h = key_hash(k, c, z)
                yield pd.DataFrame({"bucket": ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), "h": h.view(np.int64), "key": k, "copy": c.astype(np.int64), "null": z.astype(bool), "part": r.part, "seq": r.seq, "offset": offsets, "length": lengths})

    def build(every: pd.DataFrame) -> pd.DataFrame:
        twice = every["h"].duplicated(keep=False)
        pdf, more = every[~twice], every[twice]
        shared = np.array([tuple(x) for x in more[list(SHARED.names)].itertuples(index=False)], SHARED)
        h = pdf["h"].to_numpy(np.int64).view(np.uint64)
        salt, seeds, slots = perfect_hash(h)
        to = np.argsort(slots)
        put = lambda x, t: np.asarray(x)[to].astype(t).tobytes()
        return pd.DataFrame([{
            "bucket": every["bucket"].iloc[0], "n_buckets": buckets, "salt": salt, "n": len(h), "seeds": seeds.astype("<i4").tobytes(),
            "prints": put(h & np.uint64(0xFFFFFFFF), "<u4"), "parts": put(pdf["part"], "<i4"), "seqs": put(pdf["seq"], "<i4"),
            "offsets": put(pdf["offset"], "<i8"), "lengths": put(pdf["length"], "<u4"),
            "shared": shared.tobytes(),
        }])

    rows = shards.select("part", "seq", "keys", "copies", "nulls", "lengths").mapInPandas(keys, "bucket long, h long, key long, copy long, null boolean, part int, seq int, offset long, length long")
    rows.groupBy("bucket").applyInPandas(build, INDEX).write.parquet(out)
    return buckets


def lookup(spark: SparkSession, index: str, keys: DataFrame, n_buckets: int) -> DataFrame:
    """(key, copy, part, seq, offset, length) of each key (key, copy) that the index holds.

    A key that is not in the index fails the fingerprint check (but for 1 in 2^32)."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            z = pdf["key"].isna().to_numpy()
            k = pdf["key"].fillna(0).to_numpy(np.int64)
            h = key_hash(k, pdf["copy"].to_numpy(np.int64), z)
            yield pd.DataFrame({"key": pdf["key"], "copy": pdf["copy"], "h": h.view(np.int64), "bucket": ((h >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)})

    def find(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        cols = ["key", "copy", "part", "seq", "offset", "length"]
        if not len(own) or not len(rows):
            return pd.DataFrame({c: pd.Series(dtype="Int64" if c == "key" else "int64") for c in cols})
        r = rows.iloc[0]
        h = own["h"].to_numpy(np.int64).view(np.uint64)
        if r.n:
            slot = slot_of(h, int(r.n), int(r.salt), np.frombuffer(r.seeds, "<i4"))
            hit = np.frombuffer(r.prints, "<u4")[slot] == (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        else:
            slot, hit = np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        shared = pd.DataFrame(np.frombuffer(r.shared, SHARED))
        exact = pd.DataFrame({"key": own["key"].fillna(0).astype("int64"), "copy": own["copy"].astype("int64"), "null": own["key"].isna()}).merge(shared, "left", ["key", "copy", "null"])
        listed = exact["part"].notna().to_numpy()
        s, one = slot[hit & ~listed], own[hit & ~listed]
        found = pd.DataFrame({"key": one["key"].astype("Int64").to_numpy(), "copy": one["copy"].to_numpy(), "part": np.frombuffer(r.parts, "<i4")[s], "seq": np.frombuffer(r.seqs, "<i4")[s], "offset": np.frombuffer(r.offsets, "<i8")[s], "length": np.frombuffer(r.lengths, "<u4")[s].astype(np.int64)}, columns=cols)
        if not listed.any():
            return found
        places = exact.loc[listed, cols[2:]].astype("int64")
        return pd.concat([found, places.assign(key=own["key"].astype("Int64").to_numpy()[listed], copy=own["copy"].to_numpy()[listed])[cols]])

    asked = keys.select(F.col("key").cast("long"), F.col("copy").cast("long")).mapInPandas(hashed, "key long, copy long, h long, bucket long")
    held = spark.read.schema(INDEX).parquet(index)
    return asked.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInPandas(find, "key long, copy long, part int, seq int, offset long, length long")


def read_records(spark: SparkSession, payload: str) -> DataFrame:
    """(part, seq, offset, n_tokens, ids_crc32, key, copy) of every record, read from the raw shards."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r, k, c, z, lengths, offsets in _entries(pdf):
                ids = np.frombuffer(r.ids, f"<u{r.width}").astype("<u4")
                crc = [zlib.crc32(ids[o:o + n].tobytes()) for o, n in zip(offsets, lengths)]
                yield pd.DataFrame({"part": r.part, "seq": r.seq, "offset": offsets, "n_tokens": lengths, "ids_crc32": crc, "key": pd.array(k, "Int64").copy() if not z.any() else pd.array(np.where(z, None, k.astype(object)), "Int64"), "copy": c.astype(np.int64)})

    return spark.read.schema(PAYLOAD).parquet(payload).mapInPandas(run, "part int, seq int, offset long, n_tokens long, ids_crc32 long, key long, copy long")


def shard_starts(spark: SparkSession, payload: str) -> DataFrame:
    """(part, seq, base): ids before each shard.  Only one total per written part is summed in one place."""
    from pyspark.sql import Window

    sizes = spark.read.schema(PAYLOAD).parquet(payload).select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("p0"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return sizes.withColumn("s0", inside).join(before, "part").select("part", "seq", (F.col("p0") + F.col("s0")).alias("base"))


def write_store(docs: DataFrame, root: str, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS,
                bucket_keys: int = BUCKET_KEYS) -> int:
    """Write payload and index under ``root``; returns the number of index buckets."""
    write_payload(docs, f"{root}/payload", tokenizer, end_id, shard_ids)
    return write_index(docs.sparkSession, f"{root}/payload", f"{root}/index", bucket_keys)


def read_all(spark: SparkSession, root: str, n_buckets: int) -> DataFrame:
    """Every record by its key through the index: (doc_id, start, n_tokens, ids_crc32, copy).

    The raw payload is scanned once and never shuffled; the keyed places and the records read
    meet on (part, seq, offset), and the index must name the length that the payload has."""
    records = written(read_records(spark, f"{root}/payload"), "id_records")
    found = lookup(spark, f"{root}/index", records.select("key", "copy"), n_buckets)
    same = ["part", "seq", "offset"]
    got = found.withColumnRenamed("length", "n_tokens").join(records.drop("key", "copy"), [*same, "n_tokens"])
    return got.join(shard_starts(spark, f"{root}/payload"), ["part", "seq"]).select(
        F.col("key").alias("doc_id"), (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "copy")


def op10_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over all documents: written with ``word_bpe_49k.json`` and end id 2, then read back."""
    import public_tokenizers

    root = scratch_path(spark, "id_store")
    n = write_store(table(spark, sf_dir, "documents"), root, public_tokenizers.path("word_bpe_49k.json"))
    return read_all(spark, root, n)

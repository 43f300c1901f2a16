"""Token-id files: each document's ids compressed on their own with one shared zstandard
dictionary, in shards with an offset index.

The dictionary is trained on the serialized id arrays of a bounded sample (``SAMPLE_DOCS``
documents with the smallest hash of their id).  A shard is one row: block and place in it,
dictionary hash, bytes per id, the block's ids before the shard, the index (document keys,
token counts, end offsets of the frames) and the frames.  Any document is read by its offsets
alone, without its neighbours.  Shards are written by Spark in ascending document order
(ordered blocks, one shuffle of compressed frames), so the format needs no file system but
the one Spark writes to.

Null text: empty (the end id alone).  Null id: sorted first, returned as null.  Equal ids:
ordered by their ids' bytes.  Empty table: no shards.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import MIN_LONG, block_starts, order_key, shuffle_partitions
from courtline.llm.tokens import encoder, spans
from courtline.session import scratch_path

END_ID = 2
SAMPLE_DOCS = 1024          # documents whose ids train the dictionary
DICT_BYTES = 64 << 10
SHARD_BYTES = 4 << 20       # compressed frames of a shard (a longer document has its own)
LEVEL = 3

SHARD_SCHEMA = ("blk int, seq int, dict_hash string, item_bytes int, first_token long, n_tokens long, "
                "doc_keys binary, counts binary, ends binary, frames binary")


def train_dictionary(docs: DataFrame, id_col: str, text_col: str, tokenizer: str) -> bytes:
    """Dictionary bytes from the sample; raw content where too little text is there to train."""
    import zstandard as zstd

    h = F.xxhash64(order_key(id_col))
    cut = docs.select(h.alias("h")).orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if cut is None:
        return b""
    rows = docs.where(h <= F.lit(cut)).select(h.alias("h"), F.col(text_col).alias("t")).orderBy("h", "t").limit(SAMPLE_DOCS).collect()
    samples = [x for x in encoder(tokenizer).encode([r.t for r in rows]) if x]
    if not samples:
        return b""
    try:
        return zstd.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[:DICT_BYTES]


def _dict(raw: bytes):
    import zstandard as zstd

    return zstd.ZstdCompressionDict(raw) if raw else None


def write_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                *, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the shards to ``path``/shards and the dictionary to ``path``/dictionary."""
    spark = docs.sparkSession
    raw = train_dictionary(docs, id_col, text_col, tokenizer)
    mark = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(mark, raw)], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    key = order_key(id_col)
    starts = block_starts(docs, key)

    def encode(batches):
        import zstandard as zstd

        enc, comp = encoder(tokenizer), zstd.ZstdCompressor(level=LEVEL, dict_data=_dict(raw), write_content_size=True)
        tail = np.array([end_id], enc.dtype).tobytes()
        edges = np.array(starts, np.int64)
        for b in batches:
            keys = b.column(0).to_numpy()
            blk = (np.searchsorted(edges, keys, "right") - 1).astype(np.int32)
            for at, texts in spans(b.column(1)):
                ids = [x + tail for x in enc.encode(texts)]
                k = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blk[at:at + k]), pa.array(keys[at:at + k]), pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64()),
                     pa.array([comp.compress(x) for x in ids], pa.binary())], names=["blk", "key", "n", "frame"])

    def pack(batches):
        item = encoder(tokenizer).dtype.itemsize
        blk, seq, first, rows, size = None, 0, 0, [], 0

        def shard():
            keys, counts, frames = zip(*rows, strict=True)
            total = sum(counts)
            cols = [[blk], [seq], [mark], [item], [first], [total], [np.array(keys, "<i8").tobytes()], [np.array(counts, "<i8").tobytes()],
                    [np.cumsum([len(f) for f in frames]).astype("<i8").tobytes()], [b"".join(frames)]]
            types = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            names = ["blk", "seq", "dict_hash", "item_bytes", "first_token", "n_tokens", "doc_keys", "counts", "ends", "frames"]
            return total, pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for b in batches:
            for g, k, n, f in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows and (g != blk or size >= SHARD_BYTES):
                    total, out = shard()
                    yield out
                    seq, first, rows, size = seq + 1, first + total, [], 0
                if g != blk:
                    blk, seq, first = g, 0, 0
                rows.append((k, n, f))
                size += len(f)
        if rows:
            yield shard()[1]

    frames = docs.select(key.alias("key"), F.col(text_col).alias("text")).mapInArrow(encode, "blk int, key long, n long, frame binary")
    shards = (frames.repartition(shuffle_partitions(spark), "blk").sortWithinPartitions("blk", "key", "frame")
              .mapInArrow(pack, SHARD_SCHEMA))
    shards.write.option("compression", "uncompressed").parquet(f"{path}/shards")


def read_files(spark, path: str) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids (binary, ``item_bytes`` each)."""
    raw = spark.read.parquet(f"{path}/dictionary").first()
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards")
    # one count per block, a few blocks per shuffle partition
    totals = dict(shards.groupBy("blk").agg(F.sum("n_tokens")).collect())
    base, at = {}, 0
    for g in sorted(totals):
        base[g], at = at, at + totals[g]
    dictionary, mark = bytes(raw.dictionary), raw.dict_hash

    def decode(batches):
        import zstandard as zstd

        plain = zstd.ZstdDecompressor(dict_data=_dict(dictionary))
        for b in batches:
            for s in b.to_pylist():
                if s["dict_hash"] != mark:
                    raise ValueError("shard was written with another dictionary")
                keys, counts, ends = (np.frombuffer(s[c], "<i8") for c in ("doc_keys", "counts", "ends"))
                begins, whole = np.concatenate([[0], ends[:-1]]), memoryview(s["frames"])
                start = base[s["blk"]] + s["first_token"] + np.concatenate([[0], np.cumsum(counts)[:-1]])
                for i in range(0, len(keys), 256):
                    j = slice(i, i + 256)
                    ids = [plain.decompress(whole[a:z]) for a, z in zip(begins[j], ends[j], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[j], pa.int64(), mask=keys[j] == MIN_LONG), pa.array(start[j], pa.int64()),
                         pa.array([len(x) // s["item_bytes"] for x in ids], pa.int64()), pa.array([s["item_bytes"]] * len(ids), pa.int32()),
                         pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "item_bytes", "ids"])

    return shards.mapInArrow(decode, "doc_id long, start long, n_tokens long, item_bytes int, ids binary")


def read_document(spark, path: str, doc_id: int) -> list[int]:
    """Ids of one document by the index: only its own frame is decompressed."""
    import zstandard as zstd

    plain = zstd.ZstdDecompressor(dict_data=_dict(bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)))
    mark = F.lit(np.array([doc_id], "<i8").tobytes())
    for s in spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards").where(F.instr(F.hex("doc_keys"), F.hex(mark)) > 0).toLocalIterator():
        keys, ends = np.frombuffer(s.doc_keys, "<i8"), np.frombuffer(s.ends, "<i8")
        for i in np.flatnonzero(keys == doc_id):
            return np.frombuffer(plain.decompress(s.frames[ends[i - 1] if i else 0:ends[i]]), f"<u{s.item_bytes}").tolist()
    raise KeyError(doc_id)


def digests(ids: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as unsigned 32-bit integers."""
    def crc(batches):
        for b in batches:
            out = [zlib.crc32(np.frombuffer(x, f"<u{w}").astype("<u4").tobytes())
                   for x, w in zip(b.column(4).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return ids.mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, *, tokenizer: str) -> DataFrame:
    """Write all documents to token files in the shared scratch folder, read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_files(docs, path, tokenizer=tokenizer)
    return digests(read_files(spark, path))

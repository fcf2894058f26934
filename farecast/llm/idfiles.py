"""Token-id files with Elias-Fano document boundaries (5).

Documents are range-partitioned and sorted by id once; each task turns its
texts into ids and writes shards of at most ``SHARD_IDS`` ids (a longer
document has one of its own). A shard is one binary value:

  ``EFID`` | format version u16 | bytes per id u16 | documents u64 | ids u64
  | Elias-Fano block | ids (u16 where all fit, else u32, little-endian)

The Elias-Fano block holds the documents' end positions: each value's low
bits packed side by side, its high bits as ones in a unary bit vector, and
the position of every 256th one as u32 for select. An offset is read with one
select and one low-bits read; there is no table of 64-bit offsets.

The documents' ids are an Elias-Fano sequence, too (they ascend): the number
of null ids and the smallest id, then the differences from it.

Spark writes the shards (so the commit protocol covers lost tasks) as a
table (part, seq, n_docs, n_ids, doc_ids, shard), and reads it back: a
document's place and length come through select.

Order: doc_id ascending, null ids first; equal ids by hash of the text, then
the text. Null text holds the end id alone. An empty table gives no shards.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.llm.common import bound_batches
from farecast.llm.wordids import word_ids

SHARD_IDS = 1 << 21
MAGIC = b"EFID"
SAMPLE = 256

SHARDS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.BinaryType()),
        T.StructField("shard", T.BinaryType()),
    ]
)


class EliasFano:
    """A non-decreasing sequence of n values up to ``top`` in about n * (2 + log2(top / n)) bits."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple[EliasFano, int]:
        """The sequence and the number of bytes it took."""
        n, low_bits, a, b, c = struct.unpack_from("<QBQQQ", raw)
        at = struct.calcsize("<QBQQQ")
        low = np.frombuffer(raw, np.uint8, a, at)
        high = np.frombuffer(raw, np.uint8, b, at + a)
        samples = np.frombuffer(raw, "<u4", c, at + a + b)
        return cls(n, low_bits, low, high, samples), at + a + b + 4 * c

    def _select(self, i: int) -> int:
        """Position of the i-th one: from the nearest sample on, a byte's ones at a time."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        bits = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        return 8 * byte + (bits & -bits).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        first, low = i * self.low_bits, 0
        if self.low_bits:
            a, b = first >> 3, (first + self.low_bits + 7) >> 3
            low = int.from_bytes(self.low[a:b].tobytes(), "little") >> (first & 7) & (1 << self.low_bits) - 1
        return (self._select(i) - i) << self.low_bits | low

    def all(self) -> np.ndarray:
        """Every value at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, -1)
            out |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return out.astype(np.int64)


class DocIds:
    """Ascending document ids, nulls first: ``ids[i]`` by select."""

    def __init__(self, raw: bytes):
        self.nulls, self.least = struct.unpack_from("<Qq", raw)
        self.rest = EliasFano.from_bytes(raw[struct.calcsize("<Qq") :])[0]

    @staticmethod
    def build(ids: list[int | None]) -> bytes:
        known = [i for i in ids if i is not None]
        least = known[0] if known else 0
        gaps = np.array([i - least for i in known], np.uint64)  # Python integers: no difference overflows
        return struct.pack("<Qq", len(ids) - len(known), least) + EliasFano.build(gaps).to_bytes()

    def __len__(self) -> int:
        return self.nulls + self.rest.n

    def __getitem__(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.rest[i - self.nulls]


def write_shard(documents: list[bytes]) -> bytes:
    """One shard from each document's ids (little-endian unsigned 32-bit)."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    ends = np.cumsum([len(d) // 4 for d in documents])
    head = MAGIC + struct.pack("<HHQQ", 1, width, len(documents), len(ids))
    return head + EliasFano.build(ends).to_bytes() + ids.astype(f"<u{width}").tobytes()


class Shard:
    """Reader of one shard: ``shard[i]`` is the id array of document i."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token-id shard")
        version, width, self.n_docs, self.n_ids = struct.unpack_from("<HHQQ", raw, 4)
        if version != 1:
            raise ValueError(f"unknown shard version {version}")
        at = 4 + struct.calcsize("<HHQQ")
        self.ends, size = EliasFano.from_bytes(raw[at:])
        self.ids = np.frombuffer(raw, f"<u{width}", self.n_ids, at + size)

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def spans(self) -> list[tuple[int, int]]:
        """Every document's span, by one select each."""
        ends = [self.ends[i] for i in range(self.n_docs)]
        return list(zip([0, *ends], ends))

    def __getitem__(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return self.ids[a:b]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_ids: int = SHARD_IDS) -> None:
    """Write every document's ids and the end id to ``path``, in ascending doc_id order."""
    spark = docs.sparkSession
    bound_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the hash spreads rows of one id, too; the texts themselves are no range bounds
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("__h"))
    ordered = (
        keyed.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "__h")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "__h", "text")
        .select("doc_id", "text")
    )
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, part, seq = word_ids(tokenizer), TaskContext.get().partitionId(), 0
        docs_, ids_, size = [], [], 0

        def shard():
            cols = [[part], [seq], [len(docs_)], [size], [DocIds.build(docs_)], [write_shard(ids_)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=SHARDS.names)

        for got in batches:
            for at in range(0, got.num_rows, 256):
                rows = got.slice(at, 256)
                raws = encoder.encode_many(rows.column("text").to_pylist())
                for doc_id, raw in zip(rows.column("doc_id").to_pylist(), raws):
                    if docs_ and size + len(raw) // 4 >= shard_ids:
                        yield shard()
                        seq, docs_, ids_, size = seq + 1, [], [], 0
                    docs_.append(doc_id)
                    ids_.append(raw + tail)
                    size += len(raw) // 4 + 1
        if docs_:
            yield shard()

    ordered.mapInArrow(run, SHARDS).write.parquet(path)


def read_spans(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts over all shards: the running sum of the parts' id counts
    (one row per writing task) and, within a part, of its shards' is joined to
    the documents' local offsets.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    counts = shards.select("part", "seq", "n_ids")
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("ahead", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
    bases = bases.select("part", "seq", (F.col("base") + F.col("ahead")).alias("base"))
    local = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("seq", T.IntegerType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("at", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def run(batches):
        import pyarrow as pa

        for got in batches:
            for i in range(got.num_rows):
                row = {n: got.column(n)[i].as_py() for n in ("part", "seq", "doc_ids", "shard")}
                shard, names = Shard(row["shard"]), DocIds(row["doc_ids"])
                n = shard.n_docs
                spans = shard.spans()
                if [b for _, b in spans] != shard.ends.all().tolist() or len(names) != n:
                    raise ValueError(f"shard {row['part']}, {row['seq']} is damaged")
                ids = shard.ids.astype("<u4")
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["part"], np.int32)),
                        pa.array(np.full(n, row["seq"], np.int32)),
                        pa.array([names[i] for i in range(n)], pa.int64()),
                        pa.array([a for a, _ in spans], pa.int64()),
                        pa.array([b - a for a, b in spans], pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=local.names,
                )

    docs = shards.select("part", "seq", "doc_ids", "shard").mapInArrow(run, local)
    return docs.join(bases, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")

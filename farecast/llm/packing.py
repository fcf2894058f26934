"""Packing by minimum bin slack (4).

Every input split packs its own documents, so nothing is shuffled: a text
becomes ids, whole windows of ``capacity`` ids become sequences at once, and
the rest of each document waits in a pool of at most ``POOL`` pieces. For
each sequence the longest waiting piece is the anchor; a subset-sum dynamic
programme over the lengths left (a Python integer is the bitset of reachable
sums, copies of a length are added in doubling groups) finds the multiset
that fills the window closest to capacity, and walking the recorded bitsets
back gives the count of each length. Where even the best multiset leaves
slack, one more piece is cut to fill it. What is left at the end of a split
is cut into power-of-two sequences, which need no padding.

Null and empty texts hold the end id alone. Repeated rows are packed like
any others. An empty table gives no rows. The plan is a function of the
split's rows in file order, so a task that runs again gives the same rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.llm.common import bound_batches
from farecast.llm.wordids import word_ids

CAPACITY = 2048
POOL = 4096

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def best_fill(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of ``counts`` (length -> copies) whose sum is closest to ``room`` from below.

    ``lengths`` are the keys in ascending order; long ones are tried first
    and the search ends once ``room`` itself can be reached.
    """
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        v = lengths[i]
        left, group = min(counts[v], room // v), 1
        while left and not reach >> room & 1:
            group = min(group, left)
            steps.append((reach, v, group))
            reach |= reach << v * group & mask
            left -= group
            group *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for before, v, group in reversed(steps):
        if not before >> at & 1:
            used[v] = used.get(v, 0) + group
            at -= v * group
    return used


class Packer:
    """Packs one split; ``out`` collects rows (doc_id, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int = CAPACITY, pool: int = POOL):
        # a full pool always holds a window's worth of ids, as a piece has one at least
        self.capacity, self.pool, self.out = capacity, max(pool, capacity), []
        self.waiting: dict[int, list[tuple]] = {}
        self.lengths: list[int] = []
        self.counts: dict[int, int] = {}
        self.size = self.sequence = 0

    def _wait(self, piece: tuple) -> None:
        n = len(piece[2]) // 4
        if n not in self.waiting:
            self.waiting[n] = []
            self.counts[n] = 0
            insort(self.lengths, n)
        self.waiting[n].append(piece)
        self.counts[n] += 1
        self.size += 1

    def _take(self, n: int) -> tuple:
        piece = self.waiting[n].pop()
        self.counts[n] -= 1
        self.size -= 1
        if not self.counts[n]:
            del self.waiting[n], self.counts[n]
            self.lengths.remove(n)
        return piece

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            self.out.append((doc_id, start, ids, total, self.sequence, at))
            at += len(ids) // 4
        self.sequence += 1

    def _cut(self, n: int, size: int) -> tuple:
        """Take a piece of n ids, put all but its first ``size`` back."""
        doc_id, start, ids, total = self._take(n)
        self._wait((doc_id, start + size, ids[4 * size :], total))
        return doc_id, start, ids[: 4 * size], total

    def _fill(self) -> None:
        anchor = self.lengths[-1]
        pieces, room = [self._take(anchor)], self.capacity - anchor
        for n, copies in best_fill(self.counts, self.lengths, room).items():
            pieces += [self._take(n) for _ in range(copies)]
            room -= n * copies
        if room and self.lengths:  # all that are left are longer than the slack
            pieces.append(self._cut(self.lengths[-1], room))
        self._emit(pieces)

    def add(self, doc_id, ids: bytes) -> None:
        total, step = len(ids) // 4, 4 * self.capacity
        whole = len(ids) // step * step
        for at in range(0, whole, step):
            self._emit([(doc_id, at // 4, ids[at : at + step], total)])
        if whole < len(ids):
            self._wait((doc_id, whole // 4, ids[whole:], total))
        while self.size >= self.pool:
            self._fill()

    def finish(self) -> None:
        while self.size and sum(n * c for n, c in self.counts.items()) >= self.capacity:
            self._fill()
        left = sum(n * c for n, c in self.counts.items())
        while left:  # powers of two, largest first
            size = 1 << left.bit_length() - 1
            left -= size
            pieces = []
            while size:
                n = self.lengths[-1]
                pieces.append(self._take(n) if n <= size else self._cut(n, size))
                size -= len(pieces[-1][2]) // 4
            self._emit(pieces)

    def rows(self) -> list[tuple]:
        got, self.out = self.out, []
        return got


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, pool: int = POOL, with_ids: bool = False
) -> DataFrame:
    """Pieces of every document with their place in a sequence (``SCHEMA``; ``ids`` too if asked for).

    Sequence ids are unique over all splits: split << 33 | number in the split.
    """
    bound_batches(docs.sparkSession)
    schema = T.StructType([*SCHEMA.fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, packer = word_ids(tokenizer), Packer(capacity, pool)
        base = TaskContext.get().partitionId() << 33

        def batch(rows):
            cols = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([len(r[2]) // 4 for r in rows], pa.int64()),
                pa.array([zlib.crc32(r[2]) for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.int64()),
                pa.array([base + r[4] for r in rows], pa.int64()),
                pa.array([r[5] for r in rows], pa.int64()),
            ]
            if with_ids:
                cols.append(pa.array([np.frombuffer(r[2], "<i4") for r in rows], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        for got in batches:
            for at in range(0, got.num_rows, 256):
                part = got.slice(at, 256)
                texts = part.column("text").to_pylist()
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode_many(texts)):
                    packer.add(doc_id, ids + tail)
                if len(packer.out):
                    yield batch(packer.rows())
        packer.finish()
        if len(packer.out):
            yield batch(packer.rows())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces packed ``with_ids``; a group holds at most ``capacity`` ids."""
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
        .select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))
    )

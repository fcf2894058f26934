"""N-gram Jaccard self-join with multiple global token orders (1).

Two texts link when their sets of word shingles have a Jaccard similarity of
``num / den`` or more. A set of n shingles must share one of its
n - ceil(t n) + 1 first shingles, under *any* fixed order of all shingles,
with each partner. Candidates come from a first order and must share prefix
shingles under two more before the sets are compared:

* order one puts the shingles with a low hash first, rarest first; the rest
  follow by hash. Low is a share of the hashes that holds a third more
  shingles than a prefix needs, and only these have to be counted. A text
  whose prefix fills up with shingles seen once has no partner and is gone
  after one count and one join;
* orders two and three rank by other mixings of the hash; their prefixes
  must overlap, too, before the exact test.

Equal sets are one class from the start, however many copies there are. The
classes under one prefix shingle form a group, cut by set size into bands
that any linked pair shares; groups with the same leading member (by hash)
are joined, so the many groups of one set of near copies become a few. Groups
are compared in blocks of at most ``BLOCK`` by ``BLOCK`` sets: a block tests
the overlap of the further orders' prefixes, then the sets, as matrix
products, and gives back only links that join two components (all of them
with ``prune=False``); pairs never leave it. Where the blocks would compare
many more pairs than there are rows, groups first compare their members with
one of them, another one each round, and connected classes are passed over
afterwards. No pair that could join two components is left out.

Texts are read twice: for the prefixes of all, and for the whole sets of the
candidates. Words are runs of anything but ASCII white space, A-Z lowered;
a shorter text is one shingle; null, empty and blank texts have no shingles
and link with nothing. Rows, not ids, are compared: repeated rows and null
ids are kept, and a component is named by the smallest id in it (null if all
are null). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from farecast.llm.common import bound_batches, map_slices
from farecast.llm.components import components
from farecast.llm.shingles import hashed_words, lowered, scramble, shingle_hashes
from farecast.session import scratch_path

ORDERS = (1, 2)  # salts of the orders after the first
PAIR_FACTOR = 1000  # more pairs than this many times the prefix rows are first thinned by stars
BLOCK = 256  # sets of one side of a block
FEW = 24  # candidate pairs that are compared one by one

_META = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("n_low", T.IntegerType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("tokens", T.ArrayType(T.LongType())),
    ]
)
_SETS = T.StructType([T.StructField("node", T.LongType()), T.StructField("tokens", T.BinaryType())])
_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def low_bound(num: int, den: int) -> int:
    """Hashes below are counted and come first in order one: a third more shingles than a prefix holds
    (at most half of the range, so that the signed view keeps their order)."""
    return min((1 << 64) * 4 * (den - num) // (3 * den), (1 << 63) - 1)


def prefix_size(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def _sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(w, words)) for w in hashed_words([lowered(t) for t in texts])]


def _key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _write(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _prefixes(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Per row: set size, class key, and the shingles that order one can put into its prefix."""

    bound = low_bound(num, den)

    def make():
        def fn(c):
            sets = _sets(c["text"], words)
            low = [int(np.searchsorted(s, np.uint64(bound))) for s in sets]
            return {
                "doc_id": c["doc_id"],
                "text_hash": c["text_hash"],
                "n": [len(s) for s in sets],
                "n_low": low,
                "key": [_key(s) if len(s) else None for s in sets],
                # unsigned order is kept by the view only up to 2**63; the bound is below it
                "tokens": [s[: max(k, prefix_size(len(s), num, den)) if len(s) else 0].view(np.int64) for s, k in zip(sets, low)],
            }

        return fn

    return map_slices(docs, make, _META)


def _whole_sets(rows: DataFrame, words: int) -> DataFrame:
    """Whole sets of rows (node, key, text) as bytes of ascending 64-bit hashes."""

    def make():
        def fn(c):
            got = [
                (node, s.tobytes())
                for node, key, s in zip(c["node"], c["key"], _sets(c["text"], words))
                if len(s) and _key(s) == key
            ]
            return {"node": [x for x, _ in got], "tokens": [s for _, s in got]}

        return fn

    return map_slices(rows, make, _SETS)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of values in both ascending arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _prefix(tokens: np.ndarray, salt: int, size: int) -> np.ndarray:
    """The first ``size`` tokens under a further order, as their ranks, ascending."""
    ranks = scramble(tokens, salt)
    return np.sort(np.partition(ranks, size - 1)[:size] if size < len(ranks) else ranks)


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs, from products of 0/1 matrices over the tokens both sides have."""
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    row = np.repeat(np.arange(len(left)), [len(x) for x in left])
    col = np.repeat(np.arange(len(right)), [len(x) for x in right])
    if not len(shared):
        return out
    for at in range(0, len(shared), 8192):
        part = shared[at : at + 8192]
        m = []
        for values, where, n in ((a, row, len(left)), (b, col, len(right))):
            i = np.searchsorted(part, values)
            i[i == len(part)] = 0
            hit = part[i] == values
            x = np.zeros((n, len(part)), np.float32)
            x[where[hit], i[hit]] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out


class _Block:
    """Sets of one block: side 0 against side 1, or side 0 with itself if there is no side 1."""

    def __init__(self, num: int, den: int, prune: bool):
        self.num, self.den, self.prune = num, den, prune
        self.sides: tuple[list, list] = ([], [])

    def add(self, side: int, node: int, comp: int, raw: bytes) -> None:
        self.sides[side].append((node, comp, np.frombuffer(raw, np.uint64)))

    def links(self) -> list[tuple[int, int]]:
        left, right = self.sides
        within = not right
        right = left if within else right
        if not left or (within and len(left) < 2):
            return []
        num, den = self.num, self.den
        n = np.array([len(t) for _, _, t in left], np.int64)[:, None]
        m = np.array([len(t) for _, _, t in right], np.int64)[None, :]
        ok = np.minimum(n, m) * den >= np.maximum(n, m) * num
        if self.prune:
            ok &= np.array([c for _, c, _ in left])[:, None] != np.array([c for _, c, _ in right])[None, :]
        else:
            ok &= np.array([x for x, _, _ in left])[:, None] != np.array([x for x, _, _ in right])[None, :]
        if within:
            ok &= np.triu(np.ones(ok.shape, bool), 1)
        few = ok.sum() <= FEW
        for salt in ORDERS:
            if not ok.any():
                return []
            a, b = ([_prefix(t, salt, prefix_size(len(t), num, den)) for _, _, t in side] for side in (left, right))
            if few:
                for i, j in zip(*np.nonzero(ok)):
                    ok[i, j] = _common(a[i], b[j]) > 0
            else:
                ok &= _overlaps(a, b) > 0
        pairs = list(zip(*(x.tolist() for x in np.nonzero(ok))))
        if len(pairs) > FEW:
            same = np.rint(_overlaps([t for _, _, t in left], [t for _, _, t in right])).astype(np.int64)
            ok &= den * same >= num * (n + m - same)
            pairs, tested = list(zip(*(x.tolist() for x in np.nonzero(ok)))), True
        else:
            tested = False
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        out = []
        for i, j in pairs:
            (x, cx, s), (y, cy, t) = left[i], right[j]
            cx, cy = find(cx), find(cy)
            if self.prune and cx == cy:
                continue
            if not tested:
                same = _common(s, t)
                if den * same < num * (len(s) + len(t) - same):
                    continue
            up[cx] = cy
            out.append((min(x, y), max(x, y)))
        return out


def _verify(rows: DataFrame, num: int, den: int, prune: bool) -> DataFrame:
    """Links among rows (block..., side, node, comp, tokens) that are sorted by block."""
    bound_batches(rows.sparkSession)

    def run(batches):
        import pyarrow as pa

        name, block, found = None, _Block(num, den, prune), []
        for got in batches:
            c = got.to_pydict()
            for s, g, y, z, side, node, comp, tokens in zip(*(c[k] for k in _SEAT), c["tokens"]):
                if (s, g, y, z) != name:
                    found += block.links()
                    name, block = (s, g, y, z), _Block(num, den, prune)
                block.add(side, node, comp, tokens)
            yield _link_batch(pa, found)
            found = []
        yield _link_batch(pa, block.links())

    return rows.mapInArrow(run, _LINKS)


def _link_batch(pa, found: list[tuple[int, int]]):
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
    )


_SEAT = ["s", "g", "y", "z", "side", "node", "comp"]


def _band(odd: int, num: int, den: int):
    """Set sizes of a linked pair differ by at most num/den: their bands agree for one of the two offsets.
    The step is a little wider than den/num, so rounding of the logarithm can't part a pair."""
    step = math.log(den / num) * 1.08
    return F.floor((F.floor(F.log(F.col("n").cast("double")) / step) + odd) / 2)


class JaccardJoin:
    """One run of the join; ``members`` and ``links`` are its real outputs."""

    def __init__(self, docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, prune: bool = True):
        """``prune=False`` compares all candidate pairs, so that ``links`` holds every link between classes."""
        self.spark: SparkSession = docs.sparkSession
        self.words, self.num, self.den, self.prune = words, num, den, prune
        self.docs = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")
        )
        self.rows = _write(
            _prefixes(self.docs, words, num, den).withColumn("rid", F.monotonically_increasing_id()), "jaccard-rows"
        )
        first = F.min(F.struct("rid", "doc_id", "text_hash", "n", "n_low")).alias("r")
        self.classes = (
            self.rows.where("n > 0")
            .groupBy("key")
            .agg(first, F.min("doc_id").alias("first_id"))
            .select("key", F.col("r.rid").alias("node"), "first_id", "r.doc_id", "r.text_hash", "r.n", "r.n_low")
        )
        self.groups = self._prefix_rows()
        self.joined = self._joined_groups()
        self.sets, self.table = self._candidate_sets()
        try:
            self.links, self.comps = self._run()
        except BaseException:
            self.close()  # a run that fails leaves no table in the catalog
            raise

    def _prefix_rows(self) -> DataFrame:
        """(node, token, n): order one's prefixes, of shingles that several rows have."""
        tokens = self.rows.where("n > 0").select("rid", F.explode("tokens").alias("token"))
        common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        hits = tokens.join(common, "token").join(
            self.classes.select(F.col("node").alias("rid"), "n", "n_low"), "rid"
        )
        low = F.col("token").between(0, low_bound(self.num, self.den) - 1)
        by_node = Window.partitionBy("rid")
        ranked = hits.select(
            F.col("rid").alias("node"),
            "token",
            "n",
            low.alias("low"),
            (F.col("n_low") - F.count(F.when(low, 1)).over(by_node)).alias("alone"),
            F.row_number().over(by_node.orderBy(~low, "df", "token")).alias("rank"),
        )
        size = F.expr(f"n - int((n * {self.num}L + {self.den - 1}) div {self.den}) + 1")
        kept = ranked.where(~F.col("low") | (F.col("alone") + F.col("rank") <= size)).select("node", "token", "n")
        return _write(kept, "jaccard-groups")

    def _joined_groups(self) -> DataFrame:
        """(s, g, node): groups of two members or more, joined by their leading member s and band g."""
        out = []
        for odd in (0, 1):
            rows = self.groups.withColumn("g", (2 * _band(odd, self.num, self.den) + odd).cast("int"))
            first = F.min(F.struct(F.xxhash64("node").alias("h"), "node"))
            leads = rows.groupBy("token", "g").agg(first.alias("f"), F.count(F.lit(1)).alias("k")).where("k > 1")
            out.append(
                rows.join(leads.select("token", "g", F.col("f.node").alias("s")), ["token", "g"]).select("s", "g", "node")
            )
        return _write(reduce(DataFrame.union, out).distinct(), "jaccard-joined")

    def _candidate_sets(self) -> tuple[DataFrame, str]:
        """Whole sets of the classes that share a group with another, bucketed by node."""
        nodes = self.joined.select("node").distinct()
        wanted = self.classes.join(nodes, "node").select("node", "key", F.col("doc_id").alias("id"), F.col("text_hash").alias("h"))
        rows = self.docs.join(
            wanted, self.docs["doc_id"].eqNullSafe(wanted["id"]) & (self.docs["text_hash"] == wanted["h"])
        ).select("node", "key", "text")
        path = scratch_path(self.spark, "jaccard-sets")
        name = "jaccard_sets_" + path.rsplit("-", 1)[1]
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (
            _whole_sets(rows, self.words)
            .repartition(parts, "node")
            .dropDuplicates(["node"])
            .write.bucketBy(parts, "node")
            .option("path", path)
            .saveAsTable(name)
        )
        return self.spark.table(name), name

    def _compared(self, seats: DataFrame) -> DataFrame:
        """Links of the seats' blocks."""
        rows = seats.select(*_SEAT).join(self.sets, "node").select(*_SEAT, "tokens")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        blocks = rows.repartition(parts, *_SEAT[:4]).sortWithinPartitions(*_SEAT[:6])
        return _write(_verify(blocks, self.num, self.den, self.prune), "jaccard-links")

    def _open_groups(self, comps: DataFrame | None) -> DataFrame:
        """(s, g, node, comp, k) of the groups that are not connected yet; k members."""
        rows = self.joined.withColumn("comp", F.col("node"))
        if comps is not None:
            rows = self.joined.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        sizes = rows.groupBy("s", "g").agg(F.count(F.lit(1)).alias("k"), F.min("comp").alias("x"), F.max("comp").alias("y"))
        # written first: the join then shuffles rows for itself, and a hot group's rows can be split over tasks
        # (in one stage with the counts, which combine map-side, they could not)
        sizes = _write(sizes.where("x < y").select("s", "g", "k"), "jaccard-sizes")
        return rows.join(sizes, ["s", "g"])

    def _block_seats(self, rows: DataFrame) -> DataFrame:
        """Every pair of parts of a group is a block; a part sits in all its blocks."""
        m = F.ceil(F.col("k") / F.lit(BLOCK))
        rows = rows.withColumn("m", m.cast("int")).withColumn("p", F.pmod(F.xxhash64("node", F.lit(7)), F.col("m")).cast("int"))
        return rows.select("s", "g", "node", "comp", "p", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("q")).select(
            "s", "g", F.least("p", "q").alias("y"), F.greatest("p", "q").alias("z"), (F.col("p") > F.col("q")).cast("int").alias("side"),
            "node", "comp",
        )

    def _star_seats(self, rows: DataFrame, turn: int) -> DataFrame:
        """Every group's member of this turn against the others, in parts."""
        rank = F.struct(F.xxhash64("node", F.lit(turn + 100)).alias("h"), "node", "comp")
        centres = rows.groupBy("s", "g").agg(F.min(rank).alias("c"), F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("m"))
        centres = _write(centres, "jaccard-centres")  # as with the sizes: hot groups are split in the join
        part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("m")).cast("int")
        others = rows.join(centres, ["s", "g"]).where(F.col("comp") != F.col("c.comp")).select(
            "s", "g", F.lit(-1).alias("y"), part.alias("z"), F.lit(1).alias("side"), "node", "comp"
        )
        centre = centres.select(
            "s", "g", F.lit(-1).alias("y"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("z"), F.lit(0).alias("side"),
            F.col("c.node").alias("node"), F.col("c.comp").alias("comp"),
        )
        return others.union(centre)

    def _run(self) -> tuple[DataFrame, DataFrame]:
        links: list[DataFrame] = []
        comps, turn, before = None, 0, math.inf
        bound = PAIR_FACTOR * self.joined.count()
        while True:
            # written once a round: the counts below combine map-side, and no hot group stays in one task
            rows = _write(self._open_groups(comps), "jaccard-open")
            left = self._pairs_left(rows) if self.prune else 0
            if left <= bound or left > 0.7 * before:
                links.append(self._compared(self._block_seats(rows)))
                break
            links.append(self._compared(self._star_seats(rows, turn)))
            comps, turn, before = components(reduce(DataFrame.union, links)), turn + 1, left
        links = reduce(DataFrame.union, links).distinct()
        return links, components(links)

    def _pairs_left(self, rows: DataFrame) -> float:
        """How many pairs of unconnected classes the groups hold, from counts alone."""
        sizes = rows.groupBy("s", "g", "comp").agg(F.count(F.lit(1)).cast("double").alias("k"))
        whole = sizes.groupBy("s", "g").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("k2"))
        return whole.agg(F.sum((F.col("k") * F.col("k") - F.col("k2")) / 2)).first()[0] or 0.0

    def members(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, is_first, text_hash) per row; ``is_first`` marks one row of each component."""
        comps = self.comps.union(self.comps.select(F.col("comp").alias("node"), "comp").distinct())
        linked = self.classes.join(comps, "node")
        names = linked.groupBy("comp").agg(F.min("first_id").alias("component_id"), F.min("node").alias("first_rid"))
        named = linked.select("key", "comp").join(names, "comp").select("key", "component_id", "first_rid")
        classes = self.classes.join(named, "key", "left").select(
            "key",
            F.when(F.col("first_rid").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("first_rid", "node").alias("first_rid"),
        )
        shape = [F.col("doc_id"), F.col("n").cast("long").alias("n_shingles")]
        classes = _write(classes, "jaccard-classes")  # as above, for a class with many copies
        full = self.rows.where("n > 0").select("doc_id", "n", "rid", "key", "text_hash").join(classes, "key")
        none = self.rows.where("n = 0")
        return full.select(
            *shape, "component_id", (F.col("rid") == F.col("first_rid")).alias("is_first"), "text_hash"
        ).union(none.select(*shape, F.col("doc_id").alias("component_id"), F.lit(True).alias("is_first"), "text_hash"))

    def close(self) -> None:
        """Drop the table of candidate sets (the results no longer read it)."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows, with all their columns, of one text per component; texts without a word all stay.

    Of equal (doc_id, text) rows one stays.
    """
    run = JaccardJoin(docs, words, num, den)
    first = run.members().where("is_first AND n_shingles > 0").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    )
    first = _write(first, "jaccard-first")
    run.close()
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.where(has_word).withColumn("__doc_hash", F.xxhash64("text"))
    same = Window.partitionBy(F.col("doc_id"), F.col("__doc_hash")).orderBy(F.lit(0))
    kept = (
        rows.join(first, rows["doc_id"].eqNullSafe(first["__id"]) & (rows["__doc_hash"] == first["__hash"]), "left_semi")
        .withColumn("__nth", F.row_number().over(same))
        .where(F.col("__nth") == 1)
    )
    return kept.select(*docs.columns).union(docs.where(~has_word))


def jaccard_components(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    run = JaccardJoin(docs, words, num, den)
    out = run.members().select("doc_id", "n_shingles", "component_id")
    run.close()
    return out

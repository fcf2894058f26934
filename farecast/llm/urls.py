"""URL filter (11): block and allow rules, and boosted trees on lexical features for URLs no rule decides.

A rule is (host, path, verdict); it fits its host and all subdomains where
the URL's path starts with the rule's, and the longest rule (host and path
together; equal lengths: block) wins. URLs without a rule go to trees over
lengths, depth, digit ratios, entropy, parameter counts and suffix
statistics. What the trees learn from is a frame of labelled URLs; the
registered query takes the URLs that its rules decide.

Suffix statistics are counts over *all* labelled URLs: how often a host
suffix (every one of its dotted tails), a first path segment or a file suffix
occurs and how often it is blocked. Keys are hashed into ``BUCKETS`` cells,
so what reaches the driver and the tasks is bounded whatever the number of
hosts. Cells are counted per half of the URLs (by crc32 of the URL); a URL
that trains the trees is described by the other half's cells only, so its own
label is never among its features.

Nulls: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is judged by the trees like any other; null page ids stay. Empty
tables give no rows; without labelled URLs, or with one verdict only, the
trees give that verdict's rate (none: 0.5, which allows). Repeated rows are
judged and counted once each. Long URLs are read whole. Other columns are
never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farecast.llm.boost import Trees, fit
from farecast.llm.common import bound_batches, columns, hash_sample, map_slices

BUCKETS = 1 << 16
SAMPLE_ROWS = 20_000  # at most so many labelled URLs fit the trees
PRIOR = 4.0  # labelled URLs' worth of the overall rate in every cell's rate

BLOCK, ALLOW = "block", "allow"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """``path`` starts with ``/``; ``verdict`` is block or allow."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host, path, what follows the path)."""
    if url is None or (at := url.find("://")) < 0:
        return "", "", ""
    rest = url[at + 3 :]
    ends = [i for c in "/?#" if (i := rest.find(c)) >= 0]
    cut = min(ends, default=len(rest))
    host, rest = rest[:cut].translate(_LOWER), rest[cut:]
    ends = [i for c in "?#" if (i := rest.find(c)) >= 0]
    cut = min(ends, default=len(rest))
    return host, rest[:cut], rest[cut:]


class Rules:
    """Rules by host: a URL looks up the tails of its own host, so its cost does not follow their number."""

    def __init__(self, rules: Sequence[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for r in sorted(rules, key=lambda r: (-len(r.name), r.verdict != BLOCK)):
            self.by_host.setdefault(r.host, []).append(r)

    def find(self, host: str, path: str) -> Rule | None:
        best = None
        for tail in tails(host):
            for r in self.by_host.get(tail, ()):
                if path.startswith(r.path):
                    if best is None or (len(r.name), r.verdict == BLOCK) > (len(best.name), best.verdict == BLOCK):
                        best = r
                    break
        return best


def tails(host: str) -> list[str]:
    """Dotted tails, shortest first; the last one is the host."""
    if not host:
        return []
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels) - 1, -1, -1)]


def _file_suffix(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[1] if "." in name else ""


def cells(host: str, path: str) -> list[int]:
    """Statistic cells: host's last label, last two, whole host; first path segment; file suffix; then the other tails."""
    t = tails(host) or [""]
    head = path[1:].split("/", 1)[0] if path.count("/") > 1 else ""
    keys = [f"h:{t[0]}", f"h:{t[min(1, len(t) - 1)]}", f"h:{t[-1]}", f"p:{head}", f"s:{_file_suffix(path)}"]
    return [zlib.crc32(k.encode("utf-8", "surrogatepass")) % BUCKETS for k in [*keys, *(f"h:{x}" for x in t[2:-1])]]


STATISTICS = ["label", "domain", "host", "segment", "file"]
LEXICAL = [
    "length", "host_length", "path_length", "query_length", "depth", "labels", "longest_label", "last_label",
    "digit_ratio", "host_digits", "path_digits", "digit_run", "entropy", "host_entropy", "parameters", "fragment",
    "hyphens", "host_hyphens", "marks", "file_suffix", "secure", "port", "upper",
]
FEATURES = [*LEXICAL, *(f"{s}_{k}" for s in STATISTICS for k in ("count", "rate"))]


def _entropy(text: str) -> float:
    if not text:
        return 0.0
    counts = np.unique(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), return_counts=True)[1]
    p = counts / counts.sum()
    return float(-(p * np.log2(p)).sum())


def _digits(text: str) -> int:
    return sum(c.isdigit() for c in text)


def _longest_digits(text: str) -> int:
    best = run = 0
    for c in text:
        run = run + 1 if c.isdigit() else 0
        best = max(best, run)
    return best


def lexical(url: str | None, parts: tuple[str, str, str] | None = None) -> list[float]:
    """The features that need the URL alone (``LEXICAL``)."""
    url = url or ""
    host, path, rest = parts or split_url(url)
    query = rest[1:].split("#", 1)[0] if rest.startswith("?") else ""
    labels = host.split(".") if host else []
    d = _digits(url)
    return [
        math.log1p(len(url)),
        len(host),
        math.log1p(len(path)),
        math.log1p(len(query)),
        sum(1 for s in path.split("/") if s),
        len(labels),
        max(map(len, labels), default=0),
        len(labels[-1]) if labels else 0,
        d / max(1, len(url)),
        _digits(host),
        _digits(path) / max(1, len(path)),
        _longest_digits(url),
        _entropy(url),
        _entropy(host),
        sum(1 for p in query.replace(";", "&").split("&") if p),
        "#" in rest,
        url.count("-"),
        host.count("-"),
        sum(not c.isalnum() for c in url) / max(1, len(url)),
        len(_file_suffix(path)),
        url[:8].lower() == "https://",
        ":" in host,
        sum(c.isupper() for c in url) / max(1, len(url)),
    ]


def half(url: str) -> int:
    return zlib.crc32(url.encode("utf-8", "surrogatepass")) & 1


@dataclass
class Model:
    """Trees, and per half of the labelled URLs the count and the blocked count of every cell."""

    trees: Trees
    count: np.ndarray  # (2, BUCKETS)
    blocked: np.ndarray

    def statistics(self, at: np.ndarray, halves: Sequence[int] | None = None) -> np.ndarray:
        """(rows, 2 * len(STATISTICS)) for cells ``at``; of the other half only where ``halves`` names the row's own."""
        if halves is None:
            n, b = self.count.sum(0), self.blocked.sum(0)
            seen, bad, total, all_bad = n[at], b[at], self.total().sum(), self.total(True).sum()
        else:
            other = 1 - np.asarray(halves, np.int64)[:, None]
            seen, bad = self.count[other, at], self.blocked[other, at]
            total, all_bad = self.total()[other], self.total(True)[other]
        overall = (all_bad + 1) / (total + 2)
        rate = (bad + PRIOR * overall) / (seen + PRIOR)
        return np.stack([np.log1p(seen), rate], 2).reshape(len(at), -1)

    def total(self, blocked: bool = False) -> np.ndarray:
        """Labelled URLs per half: each is in exactly one cell of the last-label kind, counted apart in the last column."""
        return (self.blocked if blocked else self.count)[:, -1]

    def score(self, urls: Sequence[str | None]) -> np.ndarray:
        """How likely each URL is to be blocked."""
        parts = [split_url(u) for u in urls]
        x = np.array([lexical(u, p) for u, p in zip(urls, parts)], np.float64).reshape(len(urls), len(LEXICAL))
        at = np.array([cells(h, p)[: len(STATISTICS)] for h, p, _ in parts], np.int64).reshape(len(urls), len(STATISTICS))
        return self.trees.score(np.hstack([x, self.statistics(at)]))


def _count_cells(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cell counts over all labelled URLs. A task adds up its own rows first, so what is shuffled is one
    row per cell seen and task, and what reaches the driver is at most 2 * (BUCKETS + 1) rows."""
    schema = "half int, cell int, seen long, blocked long"
    bound_batches(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bad = np.zeros((2, BUCKETS + 1), np.int64), np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for url, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host, path, _ = split_url(url)
                at = np.array([*set(cells(host, path)), BUCKETS])
                seen[h := half(url), at] += 1
                bad[h, at] += label
        h, c = np.nonzero(seen)
        cols = [h.astype(np.int32), c.astype(np.int32), seen[h, c], bad[h, c]]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in cols], names=["half", "cell", "seen", "blocked"])

    got = labelled.mapInArrow(run, schema).groupBy("half", "cell").agg(F.sum("seen"), F.sum("blocked")).collect()
    count, blocked = np.zeros((2, BUCKETS + 1)), np.zeros((2, BUCKETS + 1))
    for h, c, n, b in got:
        count[h, c], blocked[h, c] = n, b
    return count, blocked


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on ``labelled`` (url, label: 1 for block). Cells count every row, the trees see at most
    ``rows`` of them, those with the smallest hash of the URL. Rows with a null are left out."""
    known = labelled.select("url", F.col("label").cast("int").alias("label")).dropna()
    count, blocked = _count_cells(known)
    model = Model(fit(np.zeros((0, len(FEATURES))), np.zeros(0)), count, blocked)
    got = sorted((r[0], r[1]) for r in hash_sample(known, ["url", "label"], rows).collect())
    if not got:
        return model
    parts = [split_url(u) for u, _ in got]
    x = np.array([lexical(u, p) for (u, _), p in zip(got, parts)], np.float64)
    at = np.array([cells(h, p)[: len(STATISTICS)] for h, p, _ in parts], np.int64)
    x = np.hstack([x, model.statistics(at, [half(u) for u, _ in got])])
    model.trees = fit(x, np.array([y for _, y in got], np.float64), trees=50, least=8.0)
    return model


def rule_labels(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(url, label) of the URLs that a rule decides: 1 for block."""
    def make():
        known = Rules(rules)

        def fn(c):
            found = [(u, r) for u in c["url"] if u is not None and (r := known.find(*split_url(u)[:2]))]
            return {"url": [u for u, _ in found], "label": [int(r.verdict == BLOCK) for _, r in found]}

        return fn

    return map_slices(pages.select("url"), make, columns("url string, label int"), 2048)


def judge(pages: DataFrame, rules: Sequence[Rule], model: Model, threshold: float = 0.5, page_id: str | Column = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row: the longest rule's verdict, else block where the
    trees' score (null where a rule decides) is over ``threshold``."""
    def make():
        known = Rules(rules)

        def fn(c):
            parts = [split_url(u) for u in c["url"]]
            found = [known.find(h, p) for h, p, _ in parts]
            score = np.full(len(parts), np.nan)
            open_ = [i for i, r in enumerate(found) if r is None]
            if open_:
                score[open_] = model.score([c["url"][i] for i in open_])
            return {
                "page_id": c["page_id"],
                "host": [h for h, _, _ in parts],
                "path": [p for _, p, _ in parts],
                "rule": [r and r.name for r in found],
                "verdict": [r.verdict if r else BLOCK if s > threshold else ALLOW for r, s in zip(found, score)],
                "score": pa.array(score, pa.float64(), from_pandas=True),
            }

        return fn

    key = (F.col(page_id) if isinstance(page_id, str) else page_id).cast("long").alias("page_id")
    schema = columns("page_id long, host string, path string, rule string, verdict string, score double")
    return map_slices(pages.select(key, "url"), make, schema, 2048)

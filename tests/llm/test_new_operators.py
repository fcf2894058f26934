"""URL filter (11), hard negatives (12) and periodic runs (13) against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from farecast.llm import negatives as N
from farecast.llm import periodic as R
from farecast.llm import urls as U
from farecast.llm.oracle import ORACLES
from farecast.llm.queries import QUERIES, URL_RULES
from tests.conftest import MEDIUM, SMALL
from tests.llm.conftest import make_docs
from tests.oracle_compare import compare, duck

RULES = [U.Rule(*r) for r in URL_RULES]

# --- URL filter ----------------------------------------------------------------

CASES = [
    ("http://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/de/1?x=/en/", "example.net", "/de/1", "net/", "block"),
    ("HTTPS://EXAMPLE.NET/en/", "example.net", "/en/", "example.net/en/", "allow"),
    ("http://notexample.net/en/1", "notexample.net", "/en/1", "net/", "block"),
    ("http://xnet/en/", "xnet", "/en/", None, None),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://net", "net", "", None, None),
    ("http://net?/", "net", "", None, None),
    ("https://x.example.com/de/1", "x.example.com", "/de/1", "example.com/de/", "block"),
    ("https://x.example.com/de", "x.example.com", "/de", None, None),
    ("https://example.com.org/fr/a#b", "example.com.org", "/fr/a", "org/fr/", "allow"),
    ("https://example.org:80/fr/a", "example.org:80", "/fr/a", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("no scheme/en/", "", "", None, None),
    ("://", "", "", None, None),
    ("http://É.org/fr/", "É.org", "/fr/", "org/fr/", "allow"),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


@pytest.mark.parametrize("url,host,path,rule,verdict", CASES)
def test_url_rules(url, host, path, rule, verdict):
    assert U.split_url(url)[:2] == (host, path)
    found = U.Rules(RULES).find(host, path)
    assert (found and found.name, found and found.verdict) == (rule, verdict)


def naive_rule(host, path):
    best = None
    for h, p, v in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "<p>", "other") for i, (u, *_) in enumerate(CASES)]
    rows += [(0, CASES[0][0], None, None), (None, "http://q.example.com/x", None, None), (99, "http://a.b/" + "9" * 100_000, "", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, verdict string").repartition(3)


def test_judge_edge_rows(spark, pages):
    got = U.judge(pages, RULES, U.learn(U.rule_labels(pages, RULES))).collect()
    assert len(got) == pages.count()
    want = {i: c for i, c in enumerate(CASES)}
    for r in got:
        assert r.verdict in ("block", "allow") and (r.rule is None) == (r.score is not None)
        if r.page_id in want:
            _, host, path, rule, verdict = want[r.page_id]
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert verdict is None or r.verdict == verdict


def test_judge_empty_tables(spark, pages):
    none = pages.where("false")
    assert U.judge(none, RULES, U.learn(U.rule_labels(none, RULES))).count() == 0
    unlearned = U.learn(U.rule_labels(none, RULES))
    assert {r.verdict for r in U.judge(pages, [], unlearned).collect()} == {"allow"}


def test_url_statistics_are_counts(spark, pages):
    labelled = U.rule_labels(pages, RULES)
    model = U.learn(labelled)
    rows = labelled.collect()
    for cell in range(U.BUCKETS):
        if not model.count[:, cell].any():
            continue
        for h in (0, 1):
            mine = [r for r in rows if U.half(r.url) == h and cell in U.cells(*U.split_url(r.url)[:2])]
            assert model.count[h, cell] == len(mine) and model.blocked[h, cell] == sum(r.label for r in mine)
    assert model.total().sum() == len(rows)


def test_url_trees_learn_from_labels(spark):
    """Held-out accuracy on labelled URLs whose verdict follows their form."""
    r = random.Random(3)

    def url(bad):
        word = lambda k: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
        if bad:
            return f"http://{word(6)}-{word(5)}-{word(4)}.{r.choice(['info', 'top'])}/{r.randrange(10**9)}?a={r.randrange(99)}&b={word(4)}&c=1"
        return f"https://www.{word(9)}.{r.choice(['org', 'edu'])}/{word(5)}/{word(7)}.html"

    rows = [(url(i % 2), i % 2) for i in range(1200)]
    model = U.learn(spark.createDataFrame(rows[:800], "url string, label int"))
    s = model.score([u for u, _ in rows[800:]])
    assert np.mean((s > 0.5) == np.array([y for _, y in rows[800:]])) > 0.98


def test_op11_whole_table(spark):
    got = QUERIES["op11_boosted_url_filter"](spark, MEDIUM).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{MEDIUM}/pages.parquet").select("page_id", "url").collect()}
    assert sorted(r.page_id for r in got) == sorted(urls)
    labels = U.rule_labels(spark.read.parquet(f"{MEDIUM}/pages.parquet"), RULES).collect()
    model = U.learn(spark.createDataFrame(labels))
    for r in got:
        rest = urls[r.page_id].split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        assert (r.host, r.path) == (host.lower(), path)
        rule = naive_rule(r.host, r.path)
        assert r.rule == (rule and rule[0])
        if rule:
            assert r.verdict == rule[1]
        else:
            assert r.score == pytest.approx(model.score([urls[r.page_id]])[0])
            assert r.verdict == ("block" if r.score > 0.5 else "allow")


# --- hard negatives --------------------------------------------------------------


def naive_negatives(rows):
    """rows of (vec_id, label, components) -> sorted output rows."""
    use = []
    for at, (i, label, v) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in v], at))
    out = []
    for a in use:
        if a[0] % 50:
            continue
        s = [(-sum(p * q for p, q in zip(a[2], b[2])), b[0], b[3], b[1]) for b in use if b[3] != a[3] and len(b[2]) == len(a[2])]
        s.sort()
        for neg, pid, *_ in [x for x in s if x[3] == a[1]][:5]:
            p = -neg
            fit = [x for x in s if x[3] != a[1] and 50 * p <= -100 * x[0] <= 95 * p][:3]
            out += [(a[0], pid, k + 1, x[1], p, -x[0]) for k, x in enumerate(fit)]
    return sorted(out)


def vectors(spark, rows):
    full = [(i, v, label, "x", 1) for i, label, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, score string, grp int").repartition(3)


def mined(spark, rows):
    return sorted(tuple(r) for r in N.mine(vectors(spark, rows)).collect())


def test_negatives_edge_rows(spark):
    r = random.Random(7)
    rows = [(i, r.choice([0, 1, None]) if i % 9 == 8 else r.choice([0, 1]), [r.uniform(-1, 1) for _ in range(3)]) for i in range(1, 160)]
    rows += [(200, 0, [1.0, 0.0, 0.0]), (200, 0, [1.0, 0.0, 0.0]), (201, 0, [1.0, 0.0, 0.0]), (202, 1, [0.7, 0.0, 0.0])]  # repeated rows, ties
    rows += [(203, 1, [0.7, 0.0, 0.0]), (250, 0, [1.0, 2.0]), (251, 0, [1.0, 2.0]), (252, 1, [0.5, 1.5]), (300, 0, []), (301, 0, []), (302, 1, [])]
    rows += [(350, 0, [float("nan"), 0.0, 0.0]), (351, 0, None), (352, None, [1.0, 1.0, 1.0]), (None, 1, [0.6, 0.0, 0.0]), (353, 1, [None, 1.0, 0.0])]
    rows += [(354, 1, [float("inf"), 1.0, 0.0])]
    assert mined(spark, rows) == naive_negatives(rows)


def test_negatives_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, None, [1.0])]) == []


def test_negatives_large_components(spark):
    r = random.Random(2)
    rows = [(i, i % 2, [r.uniform(-1, 1) * 10**6 for _ in range(4)]) for i in range(40, 120)]
    assert mined(spark, rows) == naive_negatives(rows)


def test_negatives_oracle(spark):
    got = QUERIES["op12_zone_mapped_negatives"](spark, SMALL).toPandas()
    want = duck(SMALL).sql(ORACLES["op12_zone_mapped_negatives"]).df()
    assert len(got) and compare(got, want) is None


def test_scores_are_exact_beyond_floats():
    a, c = np.array([[3.0e9, 1.0]]), np.array([[3.0e9, 7.0], [-3.0e9, 0.0]])
    assert N.scores(a, c).tolist() == [[1 << 62, -(1 << 62)]]  # kept within 2**62
    a, c = np.array([[2.0**28, 1.0]]), np.array([[2.0**28, 1.0]])
    assert N.scores(a, c).tolist() == [[(1 << 56) + 1]]


def test_zone_bounds_hold_every_score():
    r = np.random.default_rng(1)
    a, x = r.integers(-300, 300, (20, 8)), r.integers(-300, 300, (64, 8))
    low, high = N.score_bounds(a, x.min(0)[None], x.max(0)[None])
    s = N.scores(a, x)
    assert (s >= low).all() and (s <= high).all()


def test_hilbert_neighbours_differ_in_one_cell():
    cells = np.stack([g.ravel() for g in np.meshgrid(*[np.arange(8)] * 3, indexing="ij")], 1)
    place = N.hilbert(cells, 3)
    assert sorted(place.tolist()) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_zone_maps_spare_blocks(spark, monkeypatch):
    """On clustered rows most blocks are never read, and the rows found are still all."""
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "GROUP", 4)
    r = np.random.default_rng(4)
    centres = r.normal(size=(24, 6))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    rows = [(i, int(r.integers(0, 2)), (centres[i % 24] * 0.9 + r.normal(size=6) * 0.01).astype(np.float32).tolist()) for i in range(1, 1500)]
    index = N.Index(vectors(spark, rows))
    chosen = N._chosen(N._open(index.groups), index.blocks, True).count()
    assert chosen < 0.5 * index.groups.count() * index.blocks.count()
    assert mined(spark, rows) == naive_negatives(rows)


# --- periodic runs ----------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def naive_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 2):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i - s + q >= max(6, 4 * q):
                found.setdefault((s, i - s + q), q)
            i += 1
    return sorted((s, q, k) for (s, k), q in found.items())


def naive_document(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = naive_runs(w)
    dropped = {i for s, q, k in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else None
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    listing = "".join(f"{s},{k},{q}\n" for s, q, k in runs)
    return (doc_id, len(runs), *top, sha(listing), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def same_rows(got, docs):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r)[:8] for r in got), key=key) == sorted((naive_document(i, t) for i, t in docs), key=key)


def random_words(r):
    n, k = r.choice([0, 1, 5, 6, 7, 8, 30, 100, 500]), r.choice([1, 2, 3, 50])
    w = [r.randrange(k) for _ in range(n)]
    for _ in range(r.randint(0, 4)):
        if n > 8:
            a, p = r.randrange(n), r.randint(1, max(1, n // 6))
            for i in range(a + p, min(n, a + r.randint(1, 8 * p))):
                w[i] = w[i - p]
    return w


@pytest.mark.parametrize("tile", [4, 32, 1024])
def test_tiles_and_stitching_against_brute_force(spark, monkeypatch, tile):
    """Tiles of every width give the same runs; narrow ones cut runs into many fragments."""
    monkeypatch.setattr(R, "TILE", tile)
    r = random.Random(tile)
    docs = [random_words(r) for _ in range(150)]
    fragments = []
    for at in range(0, len(docs), 5):
        part = [np.array(d, np.int32) for d in docs[at : at + 5]]
        for d, octave, b, q in R.equal_blocks(part):
            for first, x, bs, qs in R.tiles(part[d], octave, b, q):
                fragments += [(at + d, p, first + s, first + e) for p, s, e in R.solve(x.tolist(), octave, bs.tolist(), qs.tolist())]
    r.shuffle(fragments)
    frame = spark.createDataFrame(fragments, "rid long, period long, start long, end long")
    got = {}
    for row in R._stitched(frame).collect():
        got.setdefault(row.rid, []).append((row.start, row.period, row.length))
    for i, d in enumerate(docs):
        assert sorted(got.get(i, [])) == naive_runs(d)


def test_z_function():
    r = random.Random(0)
    for _ in range(200):
        s = [r.randrange(2) for _ in range(r.randint(0, 30))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert R.z_function(s, len(s)) == want


def test_periodic_edge_rows(spark):
    r = random.Random(11)
    docs = [(i, " ".join(f"w{x}" for x in random_words(r))) for i in range(1, 120)]
    docs += [(1, docs[0][1]), (None, "a a a a a a a"), (None, None), (200, None), (201, ""), (202, " \t\n"), (203, "a a a a a"), (204, "a a a a a a")]
    docs += [(205, "\x1c \x85 \xa0 " * 9), (206, "x\x00y " * 40), (207, "é ü é ü é ü é ü")]
    docs += [(208, " ".join(["lorem ipsum dolor sit"] * 3000)), (209, "z" * 60_000 + " q" * 3), (210, ("a b " * 30 + "c ") * 9)]
    same_rows(R.detect(make_docs(spark, docs)).collect(), docs)


def test_periodic_empty(spark, empty):
    assert R.detect(empty).count() == 0


def test_op13_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same_rows(QUERIES["op13_periodic_runs"](spark, SMALL).collect(), docs)

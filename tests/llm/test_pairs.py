"""N-gram Jaccard join (1) and fingerprints (2) against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from farecast.llm.components import components
from farecast.llm.fingerprints import (
    K, RANGE, containment, distinct_count, edited_fingerprints, fingerprint, from_text, merge, merge_by, resemblance,
    sketches, to_text,
)
from farecast.llm.jaccard import JaccardJoin, jaccard_components, keep_one
from farecast.llm.oracle import ORACLES
from farecast.llm.queries import QUERIES
from farecast.llm.shingles import hashed_words, shingle_hashes
from tests.conftest import SMALL
from tests.llm.conftest import EDGE, make_docs
from tests.oracle_compare import compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return (t or "").encode().lower().decode()


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, num, den):
    """component (smallest id) per row index, by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(rows)
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = min(ids) if ids else None
    return [(rows[i][0], len(sets[i]), out[i]) for i in range(len(rows))]


def key(r):
    return tuple(map(str, r))


def near_copies(seed, groups=12, size=9, words=60):
    r = random.Random(seed)
    rows, n = [], 0
    common = [f"c{i}" for i in range(12)]
    for _ in range(groups):
        base = [f"w{r.randrange(4000)}" for _ in range(r.randint(3, words))] + common * r.randint(0, 1)
        for _ in range(r.randint(1, size)):
            t = list(base)
            for _ in range(r.randint(0, 3)):
                t[r.randrange(len(t))] = f"e{r.randrange(9)}"
            rows.append((n, " ".join(t)))
            n += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,k,num", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_components_equal_brute_force(spark, seed, k, num):
    rows = near_copies(seed)
    got = jaccard_components(make_docs(spark, rows), k, num, 100).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, k, num, 100), key=key)


def test_one_large_group_of_near_copies(spark):
    """A chain of edits: far ends are not similar, all share tokens; stars, then the rest."""
    r = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        t = list(base)
        for j in r.sample(range(80), 2):
            t[j] = f"x{i}_{j}"
        rows.append((i, " ".join(t)))
    got = jaccard_components(make_docs(spark, rows), 4, 85, 100).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 4, 85, 100))


def test_unpruned_links_are_all_links(spark):
    rows = near_copies(5, groups=6)
    run = JaccardJoin(make_docs(spark, rows), 4, 85, 100, prune=False)
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(shingles(t, 4)), []).append(i)
    reps = list(sets)
    want = sum(100 * len(a & b) >= 85 * len(a | b) for n, a in enumerate(reps) for b in reps[:n])
    assert run.links.count() == want
    run.close()


def test_join_edge_rows(spark, edge, empty):
    rows = [(i, t) for i, t, _ in EDGE]
    got = jaccard_components(edge).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 4, 85, 100), key=key)
    assert jaccard_components(empty).collect() == []


def test_keep_one_keeps_blank_texts_and_columns(spark, edge):
    got = keep_one(edge)
    assert got.columns == edge.columns
    texts = [r["text"] for r in got.collect()]
    assert len(texts) == len(EDGE) - 2  # the repeated row and the upper-case copy go
    assert sum(t is None or not t.strip() for t in texts) == 4


def test_join_matches_sql(spark):
    got = QUERIES["op1_ngram_jaccard_join"](spark, SMALL).toPandas()
    want = duck(SMALL).sql(ORACLES["op1_ngram_jaccard_join"]).df()
    assert compare(got, want) is None


def test_connected_components(spark):
    r = random.Random(3)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    up = {x: x for e in links for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(got.get(x, x) == find(x) for x in up)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_hashes_tell_texts_apart():
    texts = [b"a b c d", b"a b cd", b"ab c d", b"a  b\tc\nd", b"", b" ", b"a", b"\x00 a", b"d c b a"]
    h = [tuple(shingle_hashes(w, 3)) for w in hashed_words(texts)]
    assert h[0] == h[3] and h[4] == h[5] == ()
    assert len(set(h)) == len(texts) - 2


def test_long_text_is_hashed_alike_in_parts(monkeypatch):
    import farecast.llm.shingles as s

    raw = " ".join(f"w{i}" for i in range(5000)).encode()
    whole = hashed_words([raw])[0]
    monkeypatch.setattr(s, "PART_BYTES", 1000)
    assert (s.hashed_words([raw])[0] == whole).all()


# --- fingerprints --------------------------------------------------------------


def test_sketch_estimates(spark):
    r = random.Random(1)
    a = [f"w{r.randrange(10**6)}" for _ in range(6000)]
    b = a[:4000] + [f"v{i}" for i in range(1000)]
    x, y = sketches([" ".join(a), " ".join(b)])
    sa, sb = shingles(" ".join(a), 5), shingles(" ".join(b), 5)
    assert abs(resemblance(x, y) - len(sa & sb) / len(sa | sb)) < 0.15
    assert abs(containment(y, x) - len(sa & sb) / len(sb)) < 0.2
    assert abs(distinct_count(x) / len(sa) - 1) < 0.3
    assert (from_text(to_text(x)).hashes == x.hashes).all() and len(x.hashes) == K and int(x.hashes[-1]) < RANGE
    assert not x.whole and not from_text(to_text(x)).whole
    both = sketches([" ".join(a[:3000]), " ".join(a[2996:])])
    assert (merge(*both).hashes == x.hashes).all() and not merge(*both).whole


@pytest.mark.parametrize("n", [0, 1, K - 1, K, K + 1, 4 * K + 1])
def test_sets_of_about_k_shingles_are_counted_exactly(n):
    """Exactly k distinct shingles are a whole set, not the k smallest of more."""
    text = " ".join(f"w{i}" for i in range(n + 4)) if n else ""
    [s] = sketches([text])
    assert s.whole == (n <= K) == from_text(to_text(s)).whole and len(s.hashes) == min(n, K)
    if n <= K:
        assert distinct_count(s) == n
    halves = sketches([" ".join(f"w{i}" for i in range(a, b + 4)) for a, b in ((0, n // 2), (n // 2, n))]) if n > 1 else [s]
    assert to_text(merge(*halves)) == to_text(s)


def test_merge_by_group_equals_merge(spark):
    rows = [(i, " ".join(f"w{i * 7 + j}" for j in range(40))) for i in range(40)] + [(99, None)]
    rows += [(1000, " ".join(f"x{j}" for j in range(K + 4))), (1001, " ".join(f"y{j}" for j in range(K + 5)))]  # K, K + 1
    docs = make_docs(spark, rows)
    prints = fingerprint(docs).withColumn("g", F.when(F.col("doc_id") > 999, F.col("doc_id")).otherwise(F.col("doc_id") % 3))
    got = {r["g"]: r["fingerprint"] for r in merge_by(prints, ["g"], salts=4).collect()}
    rows = prints.collect()
    for g in {r["g"] for r in rows}:
        parts = [from_text(r["fingerprint"]) for r in rows if r["g"] == g]
        assert got[g] == to_text(merge(*parts))


def test_edited_fingerprints_edge_rows(spark, edge, empty):
    got = edited_fingerprints(edge).collect()
    assert len(got) == len(EDGE)
    assert edited_fingerprints(empty).count() == 0
    by_text = {}
    order = sorted([(i, t or "") for i, t, _ in EDGE if i is not None], key=lambda r: -r[0])
    for r in got:
        by_text.setdefault(r["fingerprint"], set()).add(r["n_chars"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    want = {}
    for n, (i, t) in enumerate(order[:-1]):
        if [x for x, _ in order].count(i) == 1 and [x for x, _ in order].count(order[n + 1][0]) == 1:
            want[i] = hashlib.sha256((t[: len(t) - len(t) // 3] + order[n + 1][1][: len(t) // 3]).encode()).hexdigest()
    shas = {r["doc_id"]: r["edited_sha256"] for r in got}
    assert all(shas[i] == s for i, s in want.items()) and len(want) >= 6


@pytest.mark.parametrize("n", [1, 2, 500])
def test_edited_text_wraps_around(spark, n):
    texts = [f"document {i} " + " ".join(f"w{i}x{j}" for j in range(i % 40)) for i in range(n)]
    got = {r["doc_id"]: r for r in edited_fingerprints(make_docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        a, b = shingles(t, 5), shingles(texts[(i - 1) % n], 5)
        assert got[i]["distinct_shingles"] == len(a) and got[i]["distinct_with_next"] == len(a | b)  # small sets: exact
        assert got[i]["in_next"] == pytest.approx(len(a & b) / len(a) if a else 1.0)
        assert got[i]["near_next"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        nxt = texts[(i - 1) % n]
        edited = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["n_chars"] == len(t)

"""Queries of the learned operators over a whole table, against plain restatements of their models.

The model is learned by the library; what it says of every document is then worked out again from its
definition: kernels from sets of n-grams, trees node by node, lexicons by looking every word up."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest

from farecast.llm import langid, quality, rules, toxicity
from farecast.llm.common import fold_of
from farecast.llm.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return docs, spark.read.parquet(f"{SMALL}/labels.parquet"), {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def ngrams(text):
    """Buckets of the 2- to 4-grams of the A-Z-lowered bytes, one by one."""
    return {int(g) for part in langid._grams(text) for g in part}


def test_op3_is_the_kernel_regression(spark, tables):
    docs, _, texts = tables
    model = langid.learn(docs, mod=5, held_out=0)
    marks = [set(np.flatnonzero(np.unpackbits(m)).tolist()) for m in model.landmarks]
    got = QUERIES["op3_string_kernel_langid"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        text = texts[r.doc_id]
        assert r.held_out == (fold_of(r.doc_id, 5) == 0)
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        own = ngrams(text)
        kernel = np.array([len(own & m) / math.sqrt(len(own) * len(m)) for m in marks])
        values = kernel @ model.weights + model.bias
        assert r.lang_pred == model.langs[int(values.argmax())]
        assert r.score == pytest.approx(min(1, max(0, (values.max() + 1) / 2)), abs=1e-4)


def test_op6_is_the_trees_walked_one_by_one(spark, tables):
    docs, labels, texts = tables
    m = quality.learn(docs, labels, "quality", mod=3, held_out=1)
    got = QUERIES["op6_boosted_quality"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        x, total = quality.statistics(texts[r.doc_id]), m.base
        for node in m.roots:
            while m.feature[node] >= 0:
                node = m.left[node] + (x[m.feature[node]] > m.threshold[node])
            total += m.value[node]
        want = 1 / (1 + math.exp(-total))
        assert r.score == pytest.approx(want) and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (fold_of(r.doc_id, 3) == 1)


def test_op7_verdict_is_the_ratio_of_all_texts(spark, tables):
    docs, labels, texts = tables
    good = {r.doc_id for r in labels.collect() if r.quality == 1}

    def buckets(text):
        raw = (text or "").encode()
        return [(int.from_bytes(raw[i : i + 3], "big") * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - rules.BITS) for i in range(len(raw) - 2)]

    grams = {i: buckets(t) for i, t in texts.items()}
    raw, target = np.zeros(1 << rules.BITS), np.zeros(1 << rules.BITS)
    for i, g in grams.items():
        for b in g:
            raw[b] += 1
            target[b] += i in good
    p, q = ((c + 0.5) / (c + 0.5).sum() for c in (target, raw))
    ratio = [math.log(a / b) for a, b in zip(p, q)]
    score = {i: sum(ratio[b] for b in g) / len(g) if g else 0.0 for i, g in grams.items()}
    trusted = sorted(score[i] for i in good if i in score)
    threshold = trusted[int(rules.QUANTILE * len(trusted))] - rules.MARGIN
    got = QUERIES["op7_likelihood_ratio_rules"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.log_ratio == pytest.approx(score[r.doc_id], abs=1e-9)
        assert r.kept == (not r.base_failed and score[r.doc_id] >= threshold)


def looked_up(model, text):
    """(sum of weights, words) by looking every word's beginnings up; phrases are searched for one by one."""
    folded = re.sub("[^a-z]+", " ", f" {toxicity.fold(text)} ") if text else ""
    found = {}
    sizes = {len(w) for w in model.weights}
    for at in (i for i, c in enumerate(folded) if c == " "):
        hits = [model.weights[w] for n in sizes if (w := folded[at + 1 : at + 1 + n]) in model.weights]
        if hits:
            found[at] = max(hits)
    for phrase in model.exceptions:
        text_ = f" {toxicity.fold(phrase)} "
        at = folded.find(text_)
        while at >= 0:
            found = {i: w for i, w in found.items() if not at <= i < at + len(text_) - 1}
            at = folded.find(text_, at + 1)
    return sum(found.values()), max(0, folded.count(" ") - 1)


def test_op10_is_the_lexicon_looked_up_word_by_word(spark, tables):
    docs, labels, texts = tables
    m = toxicity.learn(docs, labels, "toxic", mod=4, held_out=2)
    b, w1, w2 = m.logistic
    got = QUERIES["op10_lexicon_toxicity"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts) and m.weights
    for r in got:
        total, words = looked_up(m, texts[r.doc_id])
        assert m.hits(texts[r.doc_id]) == (pytest.approx(total), words)
        want = 1 / (1 + math.exp(-(b + w1 * math.log1p(total) + w2 * total / math.sqrt(words + 20))))
        assert r.score == pytest.approx(want) and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (fold_of(r.doc_id, 4) == 2)
    assert any(m.hits(t)[0] > 0 for t in texts.values())

"""The corpus pipeline on the small tables and on edge rows."""

from __future__ import annotations

import base64
import random

import corpus_pipeline
from tests.conftest import MEDIUM, SMALL
from tests.llm.conftest import make_docs
from tests.llm.test_pairs import brute


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near duplicates", "personal data", "packing"]


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = spark.createDataFrame(stage(spark, before, SMALL).collect(), docs.schema)
        assert kept.columns == docs.columns
        if name == "near duplicates":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            groups = {g for _, _, g in brute(rows, 5, 80, 100)}
            left = {g for i, _, g in brute(rows, 5, 80, 100) if i in {r["doc_id"] for r in kept.collect()}}
            assert left == groups and kept.count() == len(groups)
    pieces = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.collect()}


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").select("doc_id")
    clean = docs.join(good, "doc_id")
    after = corpus_pipeline.quality_stage(spark, docs, SMALL)
    assert after.join(good, "doc_id").count() >= 0.97 * clean.count()
    known = corpus_pipeline.language_stage(spark, clean.select(docs.columns), SMALL)
    assert known.count() >= 0.99 * clean.count()


def test_language_stage_drops_what_no_known_language_has(spark):
    r = random.Random(5)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    good = spark.read.parquet(f"{MEDIUM}/labels.parquet").where("quality = 1").select("doc_id")
    clean = docs.join(good, "doc_id").select("doc_id", "text", "lang").collect()
    by_lang = {}
    for d in clean:
        by_lang.setdefault(d["lang"], []).append(d["text"])
    mixed = [f"{a[:600]} {b[:600]}" for x in by_lang for y in by_lang if x < y for a, b in zip(by_lang[x][:5], by_lang[y][:5])]
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = [
        "Wczoraj wieczorem poszedłem z przyjaciółmi do kina, a potem wróciliśmy do domu piechotą przez park.",
        "Вчера вечером мы с друзьями пошли в кино, а потом вернулись домой пешком через парк.",
        "昨天晚上我和朋友们去看电影，然后步行穿过公园回家。",
        "Dün akşam arkadaşlarımla sinemaya gittim ve sonra parktan yürüyerek eve döndük.",
        "x",
        *[base64.b64encode(r.randbytes(n)).decode() for n in (60, 600, 6000)],
        *[r.randbytes(n).hex() for n in (60, 600, 6000)],
        " ".join("".join(r.choice(letters) for _ in range(6)) for _ in range(200)),
    ]
    rows = [tuple(d) for d in clean] + [(-1 - i, t) for i, t in enumerate(mixed)] + [(-1000 - i, t) for i, t in enumerate(junk)]
    kept = {d["doc_id"] for d in corpus_pipeline.language_stage(spark, make_docs(spark, rows), MEDIUM).collect()}
    assert [t for i, t in enumerate(junk) if -1000 - i in kept] == []
    assert len(mixed) > 20 and all(-1 - i in kept for i in range(len(mixed)))
    assert len([i for i in kept if i >= 0]) >= 0.99 * len(clean)


def test_edge_rows_pass_through(spark, edge, empty):
    """What each stage does with nulls, empty, blank, repeated and very long texts, and with no rows."""
    key = lambda r: tuple((v is None, str(v)) for v in r)
    rows = sorted((tuple(r) for r in edge.collect()), key=key)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, edge, SMALL)
        assert got.columns == edge.columns and got.schema == edge.schema, name
        kept = sorted((tuple(r) for r in got.collect()), key=key)
        ids = [r[0] for r in kept]
        if name == "personal data":  # every row stays, and only texts with data change
            assert [(r[0], *r[2:4]) for r in kept] == sorted([(r[0], *r[2:4]) for r in rows], key=key)
            changed = {r[0] for r in kept if r[1] not in {x[1] for x in rows}}
            assert changed == {8}
            [eight] = [r[1] for r in kept if r[0] == 8]
            assert "<EMAIL>" in eight and "<IP>" in eight and "<CARD>" in eight and "a.b@c.de" not in eight
        else:  # rows go or stay whole
            assert all(r in rows for r in kept), name
        if name == "language":  # a letter is needed, and null, empty and blank texts have none
            assert not {2, 3, 4} & set(ids) and all(r[1] and r[1].strip() for r in kept)
        if name == "near duplicates":  # the repeated row and its upper-case form are one; texts without a word stay
            assert len([i for i in ids if i in (1, 9)]) == 1 and {2, 3, 4, 5, 6, 7, 8} <= set(ids)
            assert len([r for r in kept if r[1] is None]) == 2
        assert stage(spark, empty, SMALL).collect() == [], name
    pieces = corpus_pipeline.packing_stage(spark, edge, SMALL)
    assert {r["doc_id"] for r in pieces.collect()} == {r[0] for r in rows}
    assert sum(r["length"] for r in pieces.collect()) >= len(rows)  # the end id of every document
    assert corpus_pipeline.packing_stage(spark, empty, SMALL).count() == 0

"""The registered queries of the operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farecast.llm.common import read_table
from farecast.session import scratch_path

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.jaccard import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def op2_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.fingerprints import edited_fingerprints

    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op3_string_kernel_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.langid import identify, learn

    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, learn(docs, mod=5, held_out=0), mod=5, held_out=0)


def op4_min_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from farecast.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op5_elias_fano_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from farecast.llm.idfiles import read_spans, write_ids

    path = scratch_path(spark, "token-ids")
    write_ids(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_VOCABULARY))
    return read_spans(spark, path)


def op6_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.quality import learn, score

    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels"), "quality", mod=3, held_out=1)
    return score(docs, model, mod=3, held_out=1)


def op7_likelihood_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.rules import judge, learn

    docs = read_table(spark, sf_dir, "documents")
    return judge(docs, learn(docs, read_table(spark, sf_dir, "labels")))


def op8_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.pii import find

    return find(read_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from farecast.llm.bytebpe import encode_documents

    docs = read_table(spark, sf_dir, "documents")
    return encode_documents(docs, public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.PATTERN)


def op10_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.toxicity import learn, score

    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels"), "toxic", mod=4, held_out=2)
    return score(docs, model, mod=4, held_out=2, threshold=0.3)


#: host, path, verdict
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op11_boosted_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.urls import Rule, judge, learn, rule_labels

    pages, rules = read_table(spark, sf_dir, "pages"), [Rule(*r) for r in URL_RULES]
    return judge(pages, rules, learn(rule_labels(pages, rules)))


def op12_zone_mapped_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.negatives import mine

    return mine(read_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from farecast.llm.periodic import detect

    return detect(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_bottom_k_fingerprints": op2_bottom_k_fingerprints,
    "op3_string_kernel_langid": op3_string_kernel_langid,
    "op4_min_bin_slack_packing": op4_min_bin_slack_packing,
    "op5_elias_fano_ids": op5_elias_fano_ids,
    "op6_boosted_quality": op6_boosted_quality,
    "op7_likelihood_ratio_rules": op7_likelihood_ratio_rules,
    "op8_boosted_pii": op8_boosted_pii,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_lexicon_toxicity": op10_lexicon_toxicity,
    "op11_boosted_url_filter": op11_boosted_url_filter,
    "op12_zone_mapped_negatives": op12_zone_mapped_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

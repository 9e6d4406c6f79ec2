"""The queries of this subpackage: opN_<name> applies operator N to its whole table."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline

from . import bpe, common, licenses, manifest, merkle, mixing, neardup, pitman_yor, prefix_bpe, prefix_trie, quality, sql, tiff, token_files, toxicity


def op1_mixing(spark, sf_dir):
    return mixing.taken(common.table(spark, sf_dir))


def op2_quality(spark, sf_dir):
    docs = common.table(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


def op3_merkle(spark, sf_dir):
    return merkle.edited_likeness(common.table(spark, sf_dir))


def op4_neardup(spark, sf_dir):
    return neardup.linked(common.table(spark, sf_dir), size=3, least_hundredths=85)


def op5_bpe(spark, sf_dir):
    return bpe.digests(common.table(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_toxicity(spark, sf_dir):
    docs = common.table(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def op7_licenses(spark, sf_dir):
    return licenses.scan(common.table(spark, sf_dir))


def op8_token_files(spark, sf_dir):
    return token_files.digests(common.table(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_pitman_yor(spark, sf_dir):
    return pitman_yor.score(common.table(spark, sf_dir), lambda doc_id: common.crc_mod(doc_id, 7) == 2)


def op10_tiff(spark, sf_dir):
    return tiff.digests(common.table(spark, sf_dir))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(common.table(spark, sf_dir, "conversations"))


def op12_prefix_bpe(spark, sf_dir):
    return prefix_bpe.digests(common.table(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op13_manifest(spark, sf_dir):
    return manifest.tampered(common.table(spark, sf_dir))


def queries():
    return {
        "op1_mixing": op1_mixing,
        "op2_quality": op2_quality,
        "op3_merkle": op3_merkle,
        "op4_neardup": op4_neardup,
        "op5_bpe": op5_bpe,
        "op6_toxicity": op6_toxicity,
        "op7_licenses": op7_licenses,
        "op8_token_files": op8_token_files,
        "op9_pitman_yor": op9_pitman_yor,
        "op10_tiff": op10_tiff,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_prefix_bpe": op12_prefix_bpe,
        "op13_manifest": op13_manifest,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql():
    return sql.oracles() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

"""The operators' registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.llm import decontaminate, html, infill, licenses, mixing, packing, pii, quality, repeats, resampling, sharding, simhash, sql, urls


def quality_statistics(spark, sf_dir: str):
    """What operator 6 counts before any rule."""
    found = quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def license_phrases(spark, sf_dir: str):
    """The base scan of operator 9, beside which its rules find more."""
    found = licenses.digest(licenses.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def url_fixed_rules(spark, sf_dir: str):
    """Hosts, paths and the fixed rule that fits, of operator 2."""
    found = urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("page_id", "host", "path", "rule")


def mix_targets(spark, sf_dir: str):
    """Sizes and targets of operator 12, before any rate."""
    found = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))
    return found.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def queries() -> dict:
    return {
        "op1_surrogates": pii.op1_query,
        "op2_url_rules": urls.op2_query,
        "op3_virtual_slots": sharding.op3_query,
        "op4_block_rules": html.op4_query,
        "op5_winnowing": decontaminate.op5_query,
        "op6_decision_list": quality.op6_query,
        "op7_simhash_tiles": simhash.op7_query,
        "op8_best_fit_packing": packing.op8_query,
        "op9_license_rules": licenses.op9_query,
        "op10_cover_names": repeats.op10_query,
        "op11_checkpoint_infill": infill.op11_query,
        "op12_entropy_mix": mixing.op12_query,
        "op13_csr_resampling": resampling.op13_query,
        "quality_statistics": quality_statistics,
        "license_phrases": license_phrases,
        "url_fixed_rules": url_fixed_rules,
        "mix_targets": mix_targets,
    }


def oracle_sql() -> dict[str, str]:
    """Only what SQL can express; the others are tested by brute force."""
    return {
        "op5_winnowing": sql.DECONTAMINATION,
        "op10_cover_names": sql.REPEATS,
        "op11_checkpoint_infill": sql.INFILL,
        "op13_csr_resampling": sql.RESAMPLING,
        "quality_statistics": sql.STATISTICS,
        "license_phrases": sql.PHRASES,
        "url_fixed_rules": sql.FIXED_RULES,
        "mix_targets": sql.TARGETS,
    }

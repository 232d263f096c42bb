"""The registered queries of this subpackage, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from listenhouse.llm import collocations, decontaminate, filter_audit, fingerprints, html_text, language, mixing, near_dedup, secret_scan, sharding, substring_dedup, token_counts, token_files
from listenhouse.llm.staging import delete_on_exit
from listenhouse.session import scratch_path
from listenhouse.sources.tables import read_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", format="parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that occur in every document."""
    return decontaminate.digest(decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, and whose they are."""
    return secret_scan.find_secrets(_table(spark, sf_dir, "documents"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal bytes."""
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), n_shards=8)


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fifths of all tokens, mixed by weights, with up to two epochs of a source."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), (3, 5), MIX_WEIGHTS, max_epochs=2)
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "budget")


#: Target weights of op6; what is not named weighs 1.
MIX_WEIGHTS = {"domain": {"d0": 5, "d1": 3, "d2": 2}, "lang": {"en": 4, "de": 3, "es": 2}}


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated passages."""
    return substring_dedup.repeated_spans(_table(spark, sf_dir, "documents")).drop("spans")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.identify(_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text."""
    return fingerprints.fingerprint(_table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, read back from the files they were written to."""
    folder = scratch_path(spark, "token-files")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), folder)
    delete_on_exit(spark, folder)
    return token_files.digest(token_files.read_tokens(spark, folder))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of every language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of every source, in every order."""
    return filter_audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_decontaminate, op3_token_counts, op4_secrets, op5_shards, op6_mix, op7_html_text, op8_substring_dedup, op9_language,
        op10_fingerprints, op11_token_files, op12_collocations, op13_filter_audit,
    )
}

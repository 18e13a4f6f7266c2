"""The pN_ queries over the test tables, and the SQL that states those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.variants import spelling_clusters

    return spelling_clusters(_table(spark, sf_dir, "reconciled_agents"), _table(spark, sf_dir, "authority"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.variants import pairs_of_clusters

    return pairs_of_clusters(_clusters(spark, sf_dir))


def p1_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clusters(spark, sf_dir)


def p1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest names of each name; the limit is the feature."""
    from hammerlot.llm.variants import nearest_spellings

    return nearest_spellings(_table(spark, sf_dir, "reconciled_agents"), _table(spark, sf_dir, "authority"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_mapped(spark, sf_dir).select("agent_id", "wikidata_id")


def p2_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.canonical import map_to_reference

    return map_to_reference(_table(spark, sf_dir, "reconciled_agents"), _table(spark, sf_dir, "authority"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.languages import language_spans, mislabelled

    return mislabelled(language_spans(_table(spark, sf_dir, "chunks"))).select("chunk_id", "seg_no", "lang")


def p3_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.languages import language_spans

    return language_spans(_table(spark, sf_dir, "chunks"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.markup import markup_elements

    return markup_elements(_table(spark, sf_dir, "chunks"))


def p4_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.markup import render_markup

    return render_markup(_table(spark, sf_dir, "chunks"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.scan_noise import scan_noise

    return scan_noise(_table(spark, sf_dir, "chunks"))


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.scan_noise import repair_scans

    return repair_scans(_table(spark, sf_dir, "chunks"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.leaks import leaks

    found = leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"), near=False)
    return found.select("doc_id", "item_id").distinct()


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.leaks import leaks

    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"))


def p7_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.sentences import split_sentences

    return split_sentences(_table(spark, sf_dir, "documents")).select("doc_id", "sent_end")


def p8_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hammerlot.llm.sentences import split_sentences

    return split_sentences(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_clusters, p1_neighbours, p2_found, p2_mapped, p3_found, p3_spans, p4_found, p4_rendered, p5_found, p5_repaired, p6_found, p6_matches, p7_uses, p7_shares, p8_found, p8_sentences)
}

# Shared runs of twelve words: a document and an item share one if they share one of the passage's windows of twelve.
_WORDS = r"regexp_extract_all(replace(replace(replace(replace(strip_accents(lower({})), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), 'ø', 'o'), '[\p{{L}}\p{{N}}]+')"
_WINDOWS = "SELECT DISTINCT {key}, array_to_string(w[i:i + 11], ' ') AS gram FROM (SELECT {key}, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT {key}, {words} AS w FROM {table} WHERE {text} IS NOT NULL) x WHERE len(w) >= 12) y"
ORACLES: dict[str, str] = {
    "p6_found": "SELECT DISTINCT doc_id, item_id FROM ({}) d JOIN ({}) e USING (gram)".format(
        _WINDOWS.format(key="doc_id", words=_WORDS.format("text"), table="documents", text="text"), _WINDOWS.format(key="item_id", words=_WORDS.format("passage"), table="eval_items", text="passage")
    )
}

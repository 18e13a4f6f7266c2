"""Queries of the core operators over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerlot.functions import text as T
from hammerlot.functions import vocabularies as V
from hammerlot.operators import chunking, curation, pages, quality, reconcile, triples
from hammerlot.operators.language_guess import detect_language
from hammerlot.operators.lookups import required_lookup
from hammerlot.plans.materialize import materialize

#: The catalogue that the curation queries edit.
EDITED = "BX0100_0000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chunks").select("catalogue_id", "idx", "chunk_id", "num", "title", "text")


ORDER = ("idx", "chunk_id")


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged lots, written once: report and flags both read them."""
    return materialize(chunking.merge_sandwiched(_lots(spark, sf_dir), order=ORDER), "merged-lots")


def _pattern_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = table(spark, sf_dir, "chunks")
        if name == "pipe_prefix":
            # No transcription starts its lots with a bar, so one is put in front.
            texts = texts.withColumn("text", F.concat(F.lit("| "), F.regexp_replace("text", r"^(?:#+|-)\s*", "")))
        return chunking.chunk(texts, key="chunk_id", pattern=name).drop("pattern")

    return query


def chunk_best_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk(table(spark, sf_dir, "documents"), key="doc_id")


def chunk_catalogue_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots of whole catalogues: texts of a catalogue are its pages. A digest stands for each lot's text."""
    documents = pages.concat_pages(table(spark, sf_dir, "chunks").withColumn("page", F.format_string("%010d-%019d", "idx", "chunk_id")))
    lots = chunking.chunk(documents)
    return lots.select("catalogue_id", "pattern", "idx", "num", "title", F.md5("text").alias("digest"))


def gap_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.split_gaps(_lots(spark, sf_dir), order=ORDER)


def merge_sandwiched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.merge_sandwiched(_lots(spark, sf_dir), order=ORDER)


def recalc_inconsistencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.inconsistencies(_merged(spark, sf_dir))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = _merged(spark, sf_dir)
    return quality.flag_needs_revision(lots, chunking.inconsistencies(lots))


def flag_needs_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir)


def catalogue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.catalogue_stats(_flagged(spark, sf_dir))


def view_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repairs go catalogue by catalogue, so only the one asked for is read."""
    lots = chunking.merge_sandwiched(_lots(spark, sf_dir).where(F.col("catalogue_id") == EDITED), order=ORDER)
    return curation.view_catalogue(quality.flag_needs_revision(lots, chunking.inconsistencies(lots)), EDITED)


def update_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = _merged(spark, sf_dir)
    return curation.update_chunk(lots, chunking.inconsistencies(lots), EDITED, 2, " A new title ", " A new text ")


def save_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An edit with repeated and null positions."""
    lots = _merged(spark, sf_dir)
    pos = F.when(F.col("idx") % 5 != 0, F.floor(F.col("idx") / 2))
    edited = lots.where(F.col("catalogue_id") == EDITED).select(pos.alias("pos"), "num", F.concat(F.lit(" "), F.upper("title"), F.lit(" ")).alias("title"), "text")
    return curation.save_catalogue(lots, edited, EDITED)


def resolve_inconsistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.resolve_inconsistency(chunking.inconsistencies(_merged(spark, sf_dir)), EDITED, "1")


def pipeline_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both repairs one after the other."""
    split = materialize(chunking.split_gaps(_lots(spark, sf_dir), order=ORDER), "split-lots")
    return chunking.merge_sandwiched(split)


def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both repairs leave inconsistent."""
    return chunking.inconsistencies(materialize(pipeline_lots(spark, sf_dir), "repaired-lots"))


def concat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = table(spark, sf_dir, "chunks").withColumn("page", F.format_string("%010d-%019d", "idx", "chunk_id"))
    joined = pages.concat_pages(lots)
    return joined.select("catalogue_id", "n_pages", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


def folder_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.folder_index(table(spark, sf_dir, "pages_list")).select("folder_id", "n_pages", F.array_join("filenames", ";").alias("filenames"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listed file per document, half of them named as a page of the list."""
    listed = table(spark, sf_dir, "pages_list").where("filename is not null").select("filename").distinct()
    more = table(spark, sf_dir, "documents").select(F.concat(F.col("catalogue_id"), F.lit("_"), F.lpad(F.col("doc_id").cast("string"), 6, "0"), F.lit("_l.jpg")).alias("filename"))
    return listed.unionByName(more.where("filename is not null")).withColumn("folder", F.regexp_extract("filename", r"^([A-Za-z0-9]+_[A-Za-z0-9]+)_", 1))


def select_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.select_pages(_files(spark, sf_dir), table(spark, sf_dir, "pages_list"))


def select_pages_of_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.select_pages(_files(spark, sf_dir), table(spark, sf_dir, "pages_list"), [EDITED, "BX0101_0000001"])


def pending_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "pages_list").select("filename")
    return pages.pending_pages(_files(spark, sf_dir), done, "filename")


def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "reconciled_agents").select("agent_id", F.expr(T.slug("label")).alias("slug"))


def name_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "catalogues").select(F.explode(F.array("autori_principali", "ente_autore_principale", "ente_autore_secondario", "autori_secondari")).alias("agent"))
    return people.where("agent is not null").distinct().select("agent", F.expr(T.name_part("agent")).alias("name"), F.expr(T.place_part("agent")).alias("place"))


def _parts(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return table(spark, sf_dir, "auctions").where(F.col(column).isNotNull()).select(F.explode(F.expr(T.parts(column))).alias("item"))


def role_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, "banditore").select(F.expr(T.bracketed("item")).alias("role")).where("role is not null").distinct()


def multi_value_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, "tipi_oggetti").distinct()


def column_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "auctions").select("cronologia").where("cronologia is not null").distinct()


def number_parsers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chunks").select("chunk_id", F.expr(T.digits_int("num")).alias("digits_int"), F.expr(T.strict_int("num")).alias("strict_int"))


def date_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = "data_inizio_asta", "data_fine_asta"
    label = T.date_label(a, b)
    dates = table(spark, sf_dir, "auctions").select("inventario", a, b).distinct()
    return dates.select("inventario", a, b, F.expr(label).alias("label"), F.expr(T.span_slug(label)).alias("span"), F.expr(T.date_begin(a)).alias("begin_date"), F.expr(T.date_end(a, b)).alias("end_date"), F.coalesce(F.expr(T.is_valid_date(T.date_begin(a))), F.lit(False)).alias("begin_valid"))


def lookup_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    langs = F.broadcast(V.table(spark, V.LANGUAGES))
    rows = table(spark, sf_dir, "catalogues").where("lingue is not null").select("nome_cartella", "lingue")
    return rows.join(langs, rows["lingue"] == langs["label"]).groupBy("lingue", "code").agg(F.count("*").alias("n"))


def lookup_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the required lookups: catalogues without a known language or a year."""
    rows = table(spark, sf_dir, "catalogues")
    year = F.expr(f"try_cast({T.strip('data_pubblicazione')} AS DOUBLE)")
    langs = F.broadcast(V.table(spark, V.LANGUAGES).select("label"))
    bad = rows.join(langs, rows["lingue"] == langs["label"], "left").where(F.col("label").isNull() | year.isNull())
    return bad.select("nome_cartella", "lingue", "data_pubblicazione")


def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _parts(spark, sf_dir, "banditore").where("item <> ''").select("item", F.expr(T.place_part("item")).alias("role")).where("role is not null").distinct()
    roles = F.broadcast(V.table(spark, V.ROLES))
    return named.join(roles, named["role"] == roles["label"], "left").select("item", "role", F.coalesce("code", F.lit(V.AUCTIONEER)).alias("code"))


def lookup_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = F.broadcast(V.table(spark, V.OBJECT_TYPES))
    return _parts(spark, sf_dir, "tipi_oggetti").join(types, F.col("item") == F.col("label")).groupBy("item", "code").agg(F.count("*").alias("n"))


def lookup_one_to_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = F.broadcast(V.table(spark, V.PERIODS))
    rows = table(spark, sf_dir, "auctions").select("cronologia").where("cronologia is not null").distinct()
    return rows.join(periods, rows["cronologia"] == periods["label"], "left").select("cronologia", "code").distinct()


def catalogue_auction_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogues and auctions by identifier, with what only one side has."""
    left = triples.rows_of(table(spark, sf_dir, "catalogues"), triples.catalogue_sql).select("id", "title").distinct()
    right = triples.rows_of(table(spark, sf_dir, "auctions"), triples.auction_sql).select("id", "span_label").distinct()
    return left.join(right, "id", "full_outer").select("id", "title", "span_label")


def triples_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.catalogue_triples(table(spark, sf_dir, "catalogues"))


def triples_auction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.auction_triples(table(spark, sf_dir, "auctions"))


def triples_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.all_triples(table(spark, sf_dir, "catalogues"), table(spark, sf_dir, "auctions"))


def role_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples_all(spark, sf_dir).where(F.col("s").contains("_assignment_"))


def trig_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.triple_lines(triples_all(spark, sf_dir))


def reconcile_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile_agents(table(spark, sf_dir, "reconciled_agents"), table(spark, sf_dir, "authority"))


def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.render_prompts(table(spark, sf_dir, "pages_list").where("filename is not null").distinct())


def preview_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows; the limit is the feature."""
    return table(spark, sf_dir, "reconciled_agents").select("agent_id", "uri", "label").orderBy("agent_id").limit(5)


def missing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed catalogues of which no text came."""
    listed = table(spark, sf_dir, "catalogues").where("nome_cartella is not null").select(F.explode(F.expr(T.parts("nome_cartella"))).alias("catalogue_id"))
    return pages.missing_documents(listed, table(spark, sf_dir, "documents"))


def required_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of catalogues with a listed language; one that is not listed would stop the query."""
    rows = table(spark, sf_dir, "catalogues").where(F.col("lingue").isin(list(V.LANGUAGES))).select("nome_cartella", "lingue")
    return required_lookup(rows, V.table(spark, V.LANGUAGES), "lingue")


def quote_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "catalogues").select("titolo").where("titolo is not null").distinct()
    return names.select("titolo", T.url_quoted(F.col("titolo")).alias("quoted"))


def detect_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", detect_language(F.col("text")).alias("detected"))


def transcribe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.transcribe(table(spark, sf_dir, "pages_list").where("filename is not null").distinct(), pages.echo_transcriber)


def split_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcriptions with separators, made of each catalogue text's paragraphs."""
    made = table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("page"), F.regexp_replace("text", r"\n\n", "\n---------\n").alias("text"))
    return chunking.separated(made)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f"chunk_{name}": _pattern_query(name) for name in chunking.PATTERNS},
    **{
        f.__name__: f
        for f in (
            chunk_best_pattern, chunk_catalogue_texts, gap_split, merge_sandwiched, recalc_inconsistencies, flag_needs_revision, catalogue_stats, pipeline_lots, pipeline_report,
            view_catalogue, update_chunk, save_catalogue, resolve_inconsistency, concat_pages, folder_index, select_pages, select_pages_of_folders, pending_pages,
            slugify, name_place, role_extract, multi_value_distinct, column_unique, number_parsers, date_normalise,
            lookup_required, lookup_unmatched, lookup_default, lookup_drop_empty, lookup_one_to_many, catalogue_auction_join,
            triples_catalogue, triples_auction, triples_all, role_assignments, trig_lines, reconcile_agents, prompt_render, preview_agents, missing_documents, required_languages, quote_names, detect_languages, transcribe_pages, split_separators,
        )
    },
}

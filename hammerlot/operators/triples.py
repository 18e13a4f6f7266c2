"""Catalogue and auction records as a set of triples of one named graph.

Each base table is scanned once. Its rows are spread to one per identifier, the parts of names and dates are columns,
and all templates of the table are one array of structs that a single ``inline`` emits; one ``distinct`` at the end makes
the set. Templates are SQL that both dialects read, so the checks can run the same list on another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerlot.functions import text as T
from hammerlot.functions import vocabularies as V

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
CRM = "http://www.cidoc-crm.org/cidoc-crm/"
AAT = "http://vocab.getty.edu/aat/"
#: Namespace of the graph's own nodes; pass the namespace in use to get its identifiers.
BASE = "http://example.org/catalogue/"
COLUMNS = ("s", "p", "o", "o_kind", "o_lang", "o_datatype", "graph")


@dataclass(frozen=True)
class Template:
    """SQL of subject and object, the predicate, and what the object is. A null or missing guard column leaves it out."""

    s: str
    p: str
    o: str
    kind: str = "iri"
    lang: str = "cast(null as string)"
    datatype: str = "cast(null as string)"
    guard: str = "true"


def _node(tail: str, base: str) -> str:
    return f"('{base}' || {tail})"


def _role(base: str, event: str, agent: str, role: str, guard: str) -> list[Template]:
    """The five triples that give an agent a role in an event; ``agent`` is the slug column."""
    s = f"('{base}' || {event} || '_assignment_' || {agent})"
    return [
        Template(s, RDF + "type", f"'{CRM}E13_Attribute_Assignment'", guard=guard),
        Template(s, CRM + "P140_assigned_attribute_to", _node(event, base), guard=guard),
        Template(s, CRM + "P141_assigned", _node(agent, base), guard=guard),
        Template(s, CRM + "P177_assigned_property_type", f"'{CRM}P14_carried_out_by'", guard=guard),
        Template(s, CRM + "P2_has_type", role, guard=guard),
    ]


def _agent(base: str, subject: str, name: str, kind: str | None, guard: str, place: bool = True) -> list[Template]:
    """Agent ``name`` carried out ``subject``: link, label, class if known, residence if stated."""
    node = _node(f"{name}_slug", base)
    out = [Template(subject, CRM + "P14_carried_out_by", node, guard=guard), Template(node, RDFS + "label", f"{name}_name", "literal", guard=guard)]
    if kind:
        out.append(Template(node, RDF + "type", f"'{CRM}{kind}'", guard=guard))
    if place:
        out.append(Template(node, CRM + "P74_has_current_or_former_residence", _node(f"{name}_place_slug", base), guard=f"{guard} AND {name}_place IS NOT NULL"))
    return out


def catalogue_templates(base: str = BASE) -> list[Template]:
    """Templates over ``catalogue_rows``: document, titles, language, creation, sale, authors."""
    doc, title, second, made, sale = (_node(x, base) for x in ("id", "id || '_title'", "id || '_secondary_title'", "id || '_creation'", "id || '_auction'"))
    lang_node = _node("id || '_lang_' || lang", base)
    out = [
        Template(doc, RDF + "type", f"'{CRM}E31_Document'"),
        Template(doc, CRM + "P48_has_preferred_identifier", "id", "literal"),
        Template(doc, CRM + "P2_has_type", f"'{AAT}{V.CATALOGUE_TYPE}'"),
        Template(doc, RDFS + "label", "title", "literal", "lang"),
        Template(doc, CRM + "P102_has_title", title),
        Template(doc, CRM + "P72_has_language", _node("'lang_' || lang", base)),
        Template(lang_node, RDF + "type", f"'{CRM}E56_Language'"),
        Template(lang_node, RDFS + "label", "lang", "literal"),
        Template(title, RDFS + "label", "title", "literal", "lang"),
        Template(title, CRM + "P2_has_type", _node("'primary_title'", base)),
        Template(doc, CRM + "P102_has_title", second, guard="other_title IS NOT NULL"),
        Template(second, RDFS + "label", "other_title", "literal", "lang", guard="other_title IS NOT NULL"),
        Template(second, CRM + "P2_has_type", _node("'secondary_title'", base), guard="other_title IS NOT NULL"),
        Template(doc, CRM + "P94i_was_created_by", made),
        Template(made, CRM + "P82_at_some_time_within", "year", "literal", datatype=f"'{XSD}gYear'"),
        Template(doc, CRM + "P70_documents", sale),
        Template(sale, RDFS + "label", "sale", "literal"),
    ]
    for name, kind, role in (
        ("author_person", "E21_Person", f"'{AAT}{V.AUTHOR_ROLE}'"),
        ("author_org", "E74_Group", f"'{AAT}{V.AUTHOR_ROLE}'"),
        ("second_org", "E74_Group", _node("'secondary_author'", base)),
        ("second_person", "E21_Person", _node("'secondary_author'", base)),
    ):
        guard = f"{name}_name IS NOT NULL"
        out += _agent(base, doc, name, kind, guard) + _role(base, "id || '_creation'", f"{name}_slug", role, guard)
    return out


def auction_templates(base: str = BASE) -> list[Template]:
    """Templates over ``auction_rows`` that need no list: sale, place, time span, organisers, period."""
    sale, place, span, organisation, period = (
        _node(x, base) for x in ("id || '_auction'", "place_slug", "span_slug", "id || '_organisation'", "'object_period_' || period_slug")
    )
    have, period_there = "place IS NOT NULL", "period IS NOT NULL"
    out = [
        Template(sale, RDF + "type", f"'{CRM}E7_Activity'"),
        Template(sale, CRM + "P2_has_type", f"'{AAT}{V.SALE_TYPE}'"),
        Template(sale, CRM + "P7_took_place_at", place, guard=have),
        Template(place, RDFS + "label", "place", "literal", guard=have),
        Template(place, RDF + "type", f"'{CRM}E53_Place'", guard=have),
        Template(sale, CRM + "P4_has_time-span", span),
        Template(span, RDF + "type", f"'{CRM}E52_Time-Span'"),
        Template(span, RDFS + "label", "span_label", "literal"),
        Template(span, CRM + "P82a_begin_of_the_begin", "begin_date", "literal", datatype=f"'{XSD}date'", guard="begin_date IS NOT NULL"),
        Template(span, CRM + "P82b_end_of_the_end", "end_date", "literal", datatype=f"'{XSD}date'", guard="end_date IS NOT NULL"),
        Template(sale, CRM + "P16_used_specific_object", _node("id", base)),
        Template(sale, CRM + "P9_consists_of", organisation, guard="organiser_name IS NOT NULL"),
        Template(organisation, RDF + "type", f"'{CRM}E7_Activity'", guard="organiser_name IS NOT NULL"),
        Template(organisation, CRM + "P2_has_type", _node("'auction_organisation'", base), guard="organiser_name IS NOT NULL"),
        *_agent(base, organisation, "organiser", None, "organiser_name IS NOT NULL"),
        *_role(base, "id || '_organisation'", "organiser_slug", _node("'main_organiser'", base), "organiser_name IS NOT NULL"),
        *_agent(base, organisation, "second_organiser", None, "second_organiser_name IS NOT NULL", place=False),
        *_role(base, "id || '_organisation'", "second_organiser_slug", _node("'secondary_organiser'", base), "second_organiser_name IS NOT NULL"),
        Template(sale, CRM + "P125_used_objects_of_type", period, guard=period_there),
        Template(period, RDFS + "label", "period", "literal", guard=period_there),
        Template(period, CRM + "P2_has_type", _node("'object_period'", base), guard=period_there),
    ]
    return out


def holding_templates(base: str = BASE) -> list[Template]:
    """Over ``(id, item)``, one row per collection."""
    sale, node = _node("id || '_auction'", base), _node("item_slug", base)
    return [
        Template(sale, CRM + "P16_used_specific_object", node),
        Template(node, RDFS + "label", "item", "literal"),
        Template(node, RDF + "type", f"'{CRM}E78_Curated_Holding'"),
    ]


def auctioneer_templates(base: str = BASE) -> list[Template]:
    """Over ``(id, item)`` with its name, role and role code, one row per auctioneer."""
    sale, act = _node("id || '_auction'", base), _node("id || '_auctioneer'", base)
    return [
        Template(sale, CRM + "P9_consists_of", act),
        Template(act, RDF + "type", f"'{CRM}E7_Activity'"),
        Template(act, CRM + "P2_has_type", _node("'auctioneering'", base)),
        Template(act, CRM + "P14_carried_out_by", _node("item_slug", base)),
        Template(_node("item_slug", base), RDFS + "label", "item_name", "literal"),
        *_role(base, "id || '_auctioneer'", "item_slug", f"('{AAT}' || code)", "item_role IS NOT NULL"),
    ]


def object_type_templates(base: str = BASE) -> list[Template]:
    """Over ``(id, item, code)``, one row per listed object type with a code."""
    sale, node = _node("id || '_auction'", base), _node("'object_type_' || item_slug", base)
    return [
        Template(sale, CRM + "P125_used_objects_of_type", node),
        Template(node, RDFS + "label", "item", "literal"),
        Template(node, CRM + "P2_has_type", _node("'object_type'", base)),
        Template(node, RDFS + "seeAlso", f"('{AAT}' || code)"),
    ]


def century_templates(base: str = BASE) -> list[Template]:
    """Over ``(period, period_slug, code)``, one row per century of a listed period."""
    return [Template(_node("'object_period_' || period_slug", base), RDFS + "seeAlso", f"('{AAT}' || code)")]


def _agent_columns(name: str, source: str, dialect: str) -> str:
    return (
        f"{T.name_part(source, dialect)} AS {name}_name, {T.slug(T.name_part(source, dialect), dialect)} AS {name}_slug, "
        f"{T.place_part(source, dialect)} AS {name}_place, {T.slug(T.place_part(source, dialect), dialect)} AS {name}_place_slug"
    )


def catalogue_sql(table: str, dialect: str = "spark") -> str:
    """One row per catalogue and identifier, with the columns the templates use. Unknown languages give null."""
    ids = f"explode({T.parts('nome_cartella', dialect)})" if dialect == "spark" else f"unnest({T.parts('nome_cartella', dialect)})"
    year = f"cast(try_cast(try_cast({T.strip('data_pubblicazione', dialect)} AS DOUBLE) AS INT) AS {'string' if dialect == 'spark' else 'varchar'})"
    lang = "CASE " + " ".join(f"WHEN lingue = '{k}' THEN '{v}'" for k, v in V.LANGUAGES.items()) + " END"
    agents = ", ".join(_agent_columns(n, c, dialect) for n, c in (("author_person", "autori_principali"), ("author_org", "ente_autore_principale"), ("second_org", "ente_autore_secondario"), ("second_person", "autori_secondari")))
    return f"""SELECT {T.slug("raw_id", dialect)} AS id, titolo AS title, altri_titoli AS other_title, {year} AS year, {lang} AS lang, vendita_asta AS sale, {agents}
FROM (SELECT *, {ids} AS raw_id FROM {table} WHERE nome_cartella IS NOT NULL) x"""


def auction_sql(table: str, dialect: str = "spark") -> str:
    """One row per auction and identifier, with the columns the templates use."""
    ids = f"explode({T.parts('inventario', dialect)})" if dialect == "spark" else f"unnest({T.parts('inventario', dialect)})"
    label = T.date_label("data_inizio_asta", "data_fine_asta", dialect)
    agents = ", ".join(_agent_columns(n, c, dialect) for n, c in (("organiser", "autore_principale"), ("second_organiser", "autore_secondario")))
    return f"""SELECT {T.slug("raw_id", dialect)} AS id, luogo_vendita AS place, {T.slug("luogo_vendita", dialect)} AS place_slug,
{label} AS span_label, {T.span_slug(label, dialect)} AS span_slug, {T.date_begin("data_inizio_asta", dialect)} AS begin_date, {T.date_end("data_inizio_asta", "data_fine_asta", dialect)} AS end_date,
{agents}, collezionisti, banditore, tipi_oggetti, cronologia AS period, {T.slug("cronologia", dialect)} AS period_slug
FROM (SELECT *, {ids} AS raw_id FROM {table} WHERE inventario IS NOT NULL) x"""


def rows_of(df: DataFrame, query: Callable[[str], str]) -> DataFrame:
    """``query(table)`` over ``df``; braces of its patterns are kept from the formatter."""
    sql = query("@table@").replace("{", "{{").replace("}", "}}").replace("@table@", "{t}")
    return df.sparkSession.sql(sql, t=df)


def _emit(rows: DataFrame, templates: list[Template], base: str) -> DataFrame:
    """All templates of a row from one array; templates with a null subject or object or a false guard are left out."""
    structs = [
        f"if(({t.guard}) AND ({t.s}) IS NOT NULL AND ({t.o}) IS NOT NULL, named_struct('s', {t.s}, 'p', '{t.p}', 'o', {t.o}, 'o_kind', '{t.kind}', 'o_lang', {t.lang}, 'o_datatype', {t.datatype}), null)"
        for t in templates
    ]
    made = rows.select(F.expr(f"inline(filter(array({', '.join(structs)}), x -> x is not null))"))
    return made.withColumn("graph", F.lit(base + "catalogues"))


def _items(rows: DataFrame, column: str) -> DataFrame:
    """``(id, item)``: the stripped, non-empty parts of a ``;`` column."""
    return rows.where(F.col(column).isNotNull()).select("id", F.explode(F.expr(T.parts(column))).alias("item")).where("item <> ''")


def catalogue_triples(catalogues: DataFrame, base: str = BASE) -> DataFrame:
    """Distinct triples of the catalogue table. Null titles, names, years and languages give no triple of theirs."""
    rows = rows_of(catalogues, catalogue_sql)
    return _emit(rows, catalogue_templates(base), base).distinct()


def auction_triples(auctions: DataFrame, base: str = BASE) -> DataFrame:
    """Distinct triples of the auction table. A sale without dates has the time span of the empty label."""
    spark = auctions.sparkSession
    rows = rows_of(auctions, auction_sql)
    holdings = _items(rows, "collezionisti").withColumn("item_slug", F.expr(T.slug("item")))
    named = _items(rows, "banditore").select("id", F.expr(T.name_part("item")).alias("item_name"), F.expr(T.place_part("item")).alias("item_role"))
    roles = F.broadcast(V.table(spark, V.ROLES))
    auctioneers = named.join(roles, named["item_role"] == roles["label"], "left").select(
        "id", "item_name", "item_role", F.expr(T.slug("item_name")).alias("item_slug"), F.coalesce("code", F.lit(V.AUCTIONEER)).alias("code")
    )
    listed = F.broadcast(V.table(spark, V.OBJECT_TYPES))
    types = _items(rows, "tipi_oggetti").join(listed, F.col("item") == F.col("label")).withColumn("item_slug", F.expr(T.slug("item")))
    periods = F.broadcast(V.table(spark, V.PERIODS))
    centuries = rows.select("period", "period_slug").distinct().join(periods, F.col("period") == F.col("label"))
    out = _emit(rows, auction_templates(base), base)
    for part, templates in ((holdings, holding_templates(base)), (auctioneers, auctioneer_templates(base)), (types, object_type_templates(base)), (centuries, century_templates(base))):
        out = out.unionByName(_emit(part, templates, base))
    return out.distinct()


def all_triples(catalogues: DataFrame, auctions: DataFrame, base: str = BASE) -> DataFrame:
    """The graph of both tables as a set; they meet in the node ``{id}_auction``."""
    return catalogue_triples(catalogues, base).unionByName(auction_triples(auctions, base)).distinct()


def triple_lines(triples: DataFrame) -> DataFrame:
    """``line``: each triple as one N-Quads line of its graph."""
    value = F.col("o")
    for shown, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        value = F.replace(value, F.lit(shown), F.lit(escaped))
    quoted = F.concat(F.lit('"'), value, F.lit('"'))
    tail = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang"))).when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^<"), F.col("o_datatype"), F.lit(">"))).otherwise("")
    target = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(F.concat(quoted, tail))
    return triples.select(F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> "), target, F.lit(" <"), "graph", F.lit("> .")).alias("line"))


def templates_sql(relation: str, templates: list[Template], base: str = BASE) -> str:
    """The same templates as one SQL query over ``relation``, for the second dialect."""
    parts = [
        f"SELECT {t.s} AS s, '{t.p}' AS p, {t.o} AS o, '{t.kind}' AS o_kind, {t.lang} AS o_lang, {t.datatype} AS o_datatype, '{base}catalogues' AS graph FROM {relation} WHERE ({t.guard}) AND ({t.s}) IS NOT NULL AND ({t.o}) IS NOT NULL"
        for t in templates
    ]
    return "\nUNION ALL ".join(parts)

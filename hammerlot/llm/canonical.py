"""Map typed names to the entries of a reference list; report those that match none. SQL only.

The surnames of labels and of reference spellings meet in the pigeonhole join of ``name_parts.closest``; kind, first
given name and house word then decide which entry is meant. What no entry takes comes out through an anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerlot.llm.name_parts import closest, common_words, nicknames, parse_names, with_formal_names
from hammerlot.plans.materialize import materialize
from hammerlot.plans.parallelism import scatter

# Descriptions of entries that are no person, firm or town, and of towns.
NEVER = ("family name", "street", "building")
TOWN = "town"

_MATCH = """
WITH pairs AS (
  SELECT l.key, r.entity, s.d AS d, l.first AS lf, r.first AS rf, l.house AS lh, r.house AS rh, l.place AS lp, r.place AS rp, l.rest AS lr, r.rest AS rr
  FROM {labels} l JOIN {near} s ON l.one = s.q JOIN {refs} r ON r.one = s.r AND r.kind = l.kind
  WHERE l.kind IN ('person', 'firm')
  UNION ALL
  SELECT l.key, r.entity, s.d + t.d, NULL, NULL, l.house, r.house, l.place, r.place, NULL, NULL
  FROM {labels} l JOIN {near} s ON l.one = s.q JOIN {near} t ON l.two = t.q
  JOIN {refs} r ON r.kind = 'partners' AND r.one = least(s.r, t.r) AND r.two = greatest(s.r, t.r)
  WHERE l.kind = 'partners'
), fit AS (
  SELECT *,
    CASE WHEN lf IS NULL AND rf IS NULL THEN 0 WHEN lf IS NULL OR rf IS NULL THEN 4 WHEN lf = rf THEN 0
         WHEN startswith(rf, lf) OR startswith(lf, rf) THEN 1
         WHEN length(lf) >= 5 AND levenshtein(lf, rf) <= 2 THEN 2 ELSE 9 END AS g,
    CASE WHEN lh = rh OR (lh IS NULL AND rh IS NULL) THEN 0 WHEN lh IS NULL OR rh IS NULL THEN 1 ELSE 9 END AS h,
    CASE WHEN lp = '' OR rp = '' THEN 1 WHEN lp = rp THEN 0 WHEN levenshtein(lp, rp) <= 2 THEN 0 ELSE 2 END AS p,
    CASE WHEN lr IS NULL OR rr IS NULL THEN 1 WHEN startswith(rr, lr) OR startswith(lr, rr) THEN 0 ELSE 2 END AS m
  FROM pairs
), entities AS (SELECT key, entity, min(struct(d, g, h, p, m)) AS c FROM fit WHERE g < 9 AND h < 9 GROUP BY key, entity),
ranked AS (SELECT key, entity, c, rank() OVER (PARTITION BY key ORDER BY c.d, c.g DIV 2, c.h, c.p, c.m, c.g) AS place_in, count(*) OVER (PARTITION BY key, c) AS equals FROM entities)
SELECT key, entity, c.d AS d FROM ranked WHERE place_in = 1 AND equals = 1
"""

_TOWNS = """
WITH pairs AS (SELECT l.key, r.entity, min(s.d) AS d FROM {labels} l JOIN {near} s ON l.one = s.q JOIN {towns} r ON r.one = s.r WHERE l.kind = 'single' GROUP BY 1, 2),
ranked AS (SELECT *, rank() OVER (PARTITION BY key ORDER BY d) AS place_in, count(*) OVER (PARTITION BY key, d) AS equals FROM pairs)
SELECT key, entity, d FROM ranked WHERE place_in = 1 AND equals = 1
"""


def reference_spellings(reference: DataFrame) -> DataFrame:
    """``(entity, label, description, is_alias)``: every label and alias of the entries that may be meant."""
    usable = reference.where(~F.coalesce(F.col("wikidata_description"), F.lit("")).isin(*NEVER))
    names = F.concat(F.array("wikidata_label"), F.coalesce(F.split("aliases", ";"), F.array().cast("array<string>")))
    rows = usable.select(F.col("wikidata_id").alias("entity"), F.posexplode(names).alias("at", "label"), F.coalesce("wikidata_description", F.lit("")).alias("description"))
    return rows.where(F.length(F.trim("label")) > 0).groupBy("entity", "label", "description").agg(F.min(F.when(F.col("at") > 0, 1).otherwise(0)).alias("is_alias"))


def map_to_reference(agents: DataFrame, reference: DataFrame, key: str = "agent_id", label: str = "label", given: str | None = "wikidata_id") -> DataFrame:
    """``(key, wikidata_id, distance, match_type, given_id, given_check)`` for every row: the entry its label denotes.

    A label fits an entry of its kind whose surnames are within Levenshtein distance 2 each, whose first given name
    agrees (equal, abbreviated, a learned nickname, or a slip) and whose house word does not differ. The nearest entry
    is taken; if two are equally near the label denotes neither. ``A || B``, null and empty labels give ``none`` with a
    null distance. match_type: ``label`` or ``alias`` where the entry has the very spelling (but for case and outer
    blanks), ``near`` otherwise, null for ``none``. Repeated labels are matched once and each row gets the result.

    The id a row came with (column ``given``, may be absent) never decides, as it may be wrong; given_check reports it:
    ``right``, ``wrong`` (another entry is meant), ``unsupported`` (the label denotes none), ``missing`` (none given but
    one found), null if neither is there. Extra columns are not read.
    """
    spellings = materialize(reference_spellings(reference), "reference-spellings")
    people = spellings.where(F.col("description") != TOWN)
    givens = common_words(people.select("label"))
    parsed_refs = parse_names(scatter(people.select(F.struct("entity", "description").alias("id"), "label")), givens)
    parsed_refs = materialize(parsed_refs.select("id.entity", "id.description", "label", "place", "house", "company", "surnames", "kind", "given"), "reference-parts")
    nicks = materialize(nicknames(parsed_refs, givens), "nicknames")
    firsts = parsed_refs.where("kind in ('person', 'firm') and size(given) > 0").select(F.get("given", F.lit(0)).alias("r")).groupBy("r").count().where("count >= 4 and length(r) >= 4").select("r")
    refs = with_formal_names(parsed_refs, nicks, firsts)
    # Aliases may lack the house word; an entry is of the kind and has the house its best spelling shows.
    whole = refs.groupBy("entity").agg(F.max("house").alias("own_house"), F.max(F.when(F.col("kind").isin("firm", "partners"), 1).otherwise(0)).alias("firm"))
    town = F.translate(F.lower(F.regexp_extract("description", r" in (.+)$", 1)), *_folding())
    refs = refs.join(whole, "entity").select(
        "entity", F.when((F.col("firm") == 1) & (F.col("kind") == "person"), "firm").otherwise(F.col("kind")).alias("kind"),
        F.get("surnames", F.lit(0)).alias("one"), F.get("surnames", F.lit(1)).alias("two"), "first", F.col("own_house").alias("house"), town.alias("place"), F.get("given", F.lit(1)).alias("rest"),
    ).distinct()
    refs = materialize(refs, "references")
    fold_town = F.translate(F.lower(F.trim("label")), *_folding())
    towns = materialize(spellings.where(F.col("description") == TOWN).select("entity", fold_town.alias("one")), "towns")

    labels = agents.where(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct()
    parsed = parse_names(scatter(labels).select(F.col("label").alias("id"), F.regexp_replace("label", r"\((?i:francia|germania|italia|olanda|inghilterra|belgio)\)", " ").alias("label")), givens)
    parsed = with_formal_names(parsed, nicks, firsts).select(
        F.col("id").alias("key"), "kind", F.get("surnames", F.lit(0)).alias("one"), F.get("surnames", F.lit(1)).alias("two"), "first", "house", "place", F.get("given", F.lit(1)).alias("rest")
    )
    parsed = materialize(parsed, "label-parts")
    asked = parsed.where("kind in ('person', 'firm', 'partners')").select(F.explode(F.array("one", "two")).alias("q"))
    known = refs.select(F.explode(F.array("one", "two")).alias("r"))
    near = materialize(closest(asked, known), "near-surnames")
    near_towns = closest(parsed.where("kind = 'single'").select(F.col("one").alias("q")), towns.select(F.col("one").alias("r")))
    spark = agents.sparkSession
    matched = spark.sql(_MATCH, labels=parsed, near=near, refs=refs).unionByName(spark.sql(_TOWNS, labels=parsed, near=near_towns, towns=towns))
    matched = materialize(matched, "matched-labels")
    own = F.nullif(F.trim(F.col(given).cast("string")), F.lit("")) if given and given in agents.columns else F.lit(None).cast("string")
    rows = agents.select(F.col(key).alias("key"), F.col(label).alias("l"), own.alias("given_id"))
    sql = """
WITH exact AS (SELECT entity, lower(trim(label)) AS l, min(is_alias) AS is_alias FROM {spellings} GROUP BY 1, 2),
typed AS (SELECT m.key, m.entity, m.d, CASE e.is_alias WHEN 0 THEN 'label' WHEN 1 THEN 'alias' ELSE 'near' END AS match_type FROM {matched} m LEFT JOIN exact e ON m.entity = e.entity AND lower(trim(m.key)) = e.l)
SELECT r.key, m.entity AS wikidata_id, m.d AS distance, m.match_type, r.given_id, CASE WHEN r.given_id IS NULL THEN 'missing' WHEN r.given_id = m.entity THEN 'right' ELSE 'wrong' END AS given_check FROM {rows} r JOIN typed m ON r.l = m.key
UNION ALL
SELECT r.key, 'none', cast(NULL AS int), NULL, r.given_id, CASE WHEN r.given_id IS NOT NULL THEN 'unsupported' END FROM {rows} r LEFT ANTI JOIN {matched} m ON r.l = m.key
"""
    return spark.sql(sql, rows=rows, matched=matched, spellings=spellings).withColumnRenamed("key", key)


def _folding() -> tuple[str, str]:
    from hammerlot.llm.leaks import _BASE, _SHOWN

    return _SHOWN, _BASE

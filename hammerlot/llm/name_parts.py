"""Parts of a typed name: kind, surnames, first given name, house word, place. All in SQL expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerlot.llm.leaks import _BASE, _SHOWN
from hammerlot.plans.materialize import materialize

# House words of auction firms in their spellings (folded, lower case), per class.
HOUSES = {
    "casa": r"\b(?:casa|c)\b\.?\s+(?:di?\b\.?\s*)?vendit[ae]\b",
    "impresa": r"\bimpr?(?:esa)?\b\.?\s+(?:di?\b\.?\s*)?vendit[ae]\b",
    "hotel": r"\bh(?:ot(?:el)?)?\b\.?\s+(?:des\s+)?ventes\b",
    "auktion": r"\bau[kc]t(?:ions?)?(?:h(?:aus)?)?\b\.?(?:[\s-]*haus\b)?",
    "kunst": r"\bkunst(?:h(?:dlg|andlung)?)?\b\.?(?:[\s-]*handlung\b)?",
    "antiquar": r"\bantiqu(?:a+r(?:iaa?t)?)?\b\.?",
    "galerie": r"\bgal(?:l|erie|leria|lery)?\b\.?",
}
#: Whole house words that a slip of the hand may have changed, and their class.
HOUSE_WORDS = {
    "auktionshaus": "auktion", "auctionshaus": "auktion", "kunsthandlung": "kunst", "antiquariat": "antiquar", "antiquariaat": "antiquar", "galerie": "galerie", "galleria": "galerie", "gallery": "galerie",
    "vendite": "casa", "vendita": "casa", "impresa": "impresa", "ventes": "hotel", "handlung": "kunst", "antiquar": "antiquar", "auktionsh": "auktion", "kunsthdlg": "kunst",
}
COMPANY = r"(?:(?:&|\bet\b|\bund\b|\bu\b\.?|\band\b|\be\b|-)\s*)?\b(?:cie|c\.\s?ie|comp|co)\b\.?(?!\p{L})"
TITLES = "dr herr hr mr mme cav prof sig comm monsieur signor"
#: Particles are none where a period follows (then they are initials), nor is ``d`` without an apostrophe.
PARTICLES = "de von van di du del della zu der den des ten la le"
_PARTICLE = rf"(?<!\p{{L}})(?:d['’`´]\s*(?=\p{{L}})|(?:{'|'.join(PARTICLES.split())})(?![\p{{L}}.]))"
PARTNERS = r"(\p{L}{5,})\s*(?:&|\+|\bund\b|\bu\b\.?|\bet\b|\band\b|\be\b(?!\.)|-)\s*(\p{L}{5,})"

_PARSE = """
WITH folded AS (
  SELECT id, label, trim(translate(lower(replace(label, '_', ' ')), :shown, :base)) AS s FROM {labels}
), placed AS (
  SELECT id, label, s LIKE '%||%' AS double,
    trim(regexp_extract(s, '<([^<>]*)>', 1)) AS place,
    CASE WHEN trim(regexp_replace(s, '<[^<>]*>', '')) = '' THEN regexp_replace(s, '[<>]', ' ') ELSE regexp_replace(s, '<[^<>]*>?', ' ') END AS s
  FROM folded
), housed AS (
  SELECT id, label, double, place, @HOUSE_CASE@ AS house, s RLIKE :company AS company,
    regexp_replace(regexp_replace(regexp_replace(s, :houses, ' '), :company, ' '), :particle, ' ') AS s
  FROM placed
), cut AS (
  SELECT *, regexp_extract(s, :partners, 1) AS one, regexp_extract(s, :partners, 2) AS two,
    filter(split(regexp_replace(s, '[^\\\\p{{L}}]+', ' '), ' '), t -> t <> '' AND NOT array_contains(split(:titles, ' '), t)) AS words,
    filter(split(regexp_replace(regexp_extract(s, '^([^,]*\\\\p{{L}}[^,]*),\\\\s*[(]?\\\\s*\\\\p{{L}}', 1), '[^\\\\p{{L}}]+', ' '), ' '), t -> t <> '') AS leading
  FROM housed
), fuzzy AS (
  SELECT *, filter(words, t -> length(t) >= 6 AND NOT array_contains(split(:givens, ' '), t) AND exists(split(:house_words, ' '), h -> levenshtein(t, h) <= if(length(h) >= 9, 2, 1))) AS slips FROM cut
), kept AS (
  SELECT id, label, double, place, company, one, two, leading,
    coalesce(house, @SLIP_CASE@) AS house,
    filter(words, t -> NOT array_contains(slips, t)) AS words
  FROM fuzzy
), named AS (
  SELECT *,
    one <> '' AND two <> '' AND NOT array_contains(split(:givens, ' '), one) AND NOT array_contains(split(:givens, ' '), two) AND array_contains(words, one) AND array_contains(words, two) AS partners,
    filter(words, t -> NOT array_contains(split(:givens, ' '), t)) AS rare
  FROM kept
), chosen AS (
  SELECT *,
    CASE WHEN partners THEN array_sort(array(one, two))
      ELSE slice(array_sort(
        CASE WHEN size(leading) > 0 AND size(filter(leading, t -> array_contains(rare, t))) > 0 THEN filter(leading, t -> array_contains(rare, t)) WHEN size(rare) > 0 THEN rare ELSE words END,
        (a, b) -> CASE WHEN length(a) <> length(b) THEN length(b) - length(a) WHEN a < b THEN -1 WHEN a > b THEN 1 ELSE 0 END), 1, 1) END AS surnames
  FROM named
)
SELECT id, label, place, house, company, double, surnames,
  CASE WHEN double THEN 'double' WHEN coalesce(size(surnames), 0) = 0 THEN 'none' WHEN partners THEN 'partners' WHEN house IS NOT NULL OR company THEN 'firm' WHEN size(words) = 1 THEN 'single' ELSE 'person' END AS kind,
  CASE WHEN partners THEN cast(array() AS array<string>) ELSE
    (CASE WHEN size(filter(words, t -> NOT array_contains(surnames, t))) > 1 AND words[0] = 'm' THEN filter(slice(words, 2, size(words)), t -> NOT array_contains(surnames, t))
     ELSE filter(words, t -> NOT array_contains(surnames, t)) END) END AS given
FROM chosen
"""


def common_words(names: DataFrame, share: float = 0.0012, least: int = 4) -> list[str]:
    """Words that a share of all names has and that mostly stand where given names and house words do: not last, and not
    before a comma. At most ``words / share`` of them, the bound of what comes to the driver."""
    bare = F.regexp_replace(F.translate(F.lower("label"), _SHOWN, _BASE), r"<[^<>]*>|\([^()]*\)|_", " ")
    single = names.select(bare.alias("s")).where(~F.col("s").rlike(PARTNERS))
    split = r"[^\p{L}]+"
    head = F.filter(F.split(F.when(F.col("s").rlike(r"\p{L}[^,]*,\s*\p{L}"), F.substring_index("s", ",", 1)).otherwise(""), split), lambda w: w != "")
    words = F.array_distinct(F.filter(F.split("s", split), lambda w: w != ""))
    placed = single.select(head.alias("head"), words.alias("words")).where(F.size("words") > 1)
    family = F.when(F.size("head") > 0, F.col("head")).otherwise(F.slice("words", -1, 1))
    flat = placed.select(F.explode(F.transform("words", lambda w: F.struct(w.alias("w"), F.array_contains(family, w).alias("last")))).alias("x")).select("x.*")
    counted = flat.where(F.length("w") >= 2).groupBy("w").agg(F.count("*").alias("n"), F.count_if("last").alias("lasts"))
    n = names.count()
    return [r.w for r in counted.where((F.col("n") >= max(least, int(n * share))) & (2 * F.col("lasts") < F.col("n"))).select("w").collect()]


def parse_names(names: DataFrame, givens: list[str]) -> DataFrame:
    """Parts of ``names(id, label)``: ``(id, label, place, house, company, double, surnames, kind, given)``.

    kind: ``person``, ``firm`` (one name with a house word or company sign), ``partners`` (two names), ``single`` (one
    word: a place), ``double`` (two labels with ``||``), ``none`` (null or no word). ``givens``: words never taken for a
    surname while another is there.
    """
    house = "CASE " + " ".join(f"WHEN s RLIKE '{p.replace(chr(92), chr(92) * 2)}' THEN '{c}'" for c, p in HOUSES.items()) + " END"
    slip = "CASE " + " ".join(f"WHEN exists(slips, t -> levenshtein(t, '{w}') <= {2 if len(w) >= 9 else 1}) THEN '{c}'" for w, c in HOUSE_WORDS.items()) + " END"
    args = {
        "shown": _SHOWN, "base": _BASE, "company": COMPANY, "houses": "|".join(HOUSES.values()), "partners": PARTNERS,
        "titles": TITLES, "particle": _PARTICLE, "givens": " ".join(givens) or " ", "house_words": " ".join(HOUSE_WORDS),
    }
    query = _PARSE.replace("@HOUSE_CASE@", house).replace("@SLIP_CASE@", slip)
    return names.sparkSession.sql(query, args=args, labels=names)


def closest(asked: DataFrame, known: DataFrame, k: int = 2) -> DataFrame:
    """``(q, r, d)``: for every distinct string ``q`` the strings ``r`` within Levenshtein distance ``k``, complete.

    Pigeonhole: ``r`` is cut into k + 1 segments; one of them stands unchanged in any ``q`` within distance k, shifted
    by k places at most. So the equality join is on (length of r, number of the segment, its text), with the substrings
    of ``q`` at the places it may have moved to, and the built-in ``levenshtein`` verifies. Strings ``r`` of at most k
    letters cannot be cut so: they share a letter with any longer ``q`` within k, or ``q`` is as short, and there every
    pair is within k. Null strings match nothing.
    """
    sql = f"""
WITH r AS (SELECT DISTINCT r FROM {{known}} WHERE r IS NOT NULL AND length(r) > {k}),
q AS (SELECT DISTINCT q FROM {{asked}} WHERE q IS NOT NULL),
cuts AS (
  SELECT r, length(r) AS n, i, cast(floor(i * length(r) / {k + 1}) AS int) AS at, cast(floor((i + 1) * length(r) / {k + 1}) - floor(i * length(r) / {k + 1}) AS int) AS m
  FROM r LATERAL VIEW explode(sequence(0, {k})) AS i
), segments AS (SELECT r, n, i, substring(r, at + 1, m) AS piece FROM cuts),
spots AS (
  SELECT q, n, i, cast(floor(i * n / {k + 1}) AS int) AS at, cast(floor((i + 1) * n / {k + 1}) - floor(i * n / {k + 1}) AS int) AS m
  FROM q LATERAL VIEW explode(sequence(greatest({k + 1}, length(q) - {k}), greatest({k + 1}, length(q) + {k}))) AS n LATERAL VIEW explode(sequence(0, {k})) AS i
), pieces AS (
  SELECT DISTINCT q, n, i, substring(q, at + 1 + shift, m) AS piece
  FROM spots LATERAL VIEW explode(sequence(-{k}, {k})) AS shift WHERE at + shift >= 0 AND at + shift + m <= length(q)
), candidates AS (SELECT DISTINCT q, r FROM pieces JOIN segments USING (n, i, piece)),
short_r AS (SELECT r, c FROM (SELECT DISTINCT r FROM {{known}} WHERE length(r) <= {k}) LATERAL VIEW explode(array_append(split(r, ''), ' ')) AS c),
short_q AS (SELECT q, c FROM q LATERAL VIEW explode(array_append(split(q, ''), if(length(q) <= {k}, ' ', NULL))) AS c WHERE length(q) <= {2 * k} AND c IS NOT NULL)
SELECT q, r, levenshtein(q, r) AS d FROM candidates WHERE levenshtein(q, r) <= {k}
UNION ALL
SELECT q, r, levenshtein(q, r) AS d FROM (SELECT DISTINCT q, r FROM short_q JOIN short_r USING (c)) WHERE levenshtein(q, r) <= {k}
"""
    return asked.sparkSession.sql(sql, asked=asked, known=known)


def nicknames(parsed: DataFrame, givens: list[str]) -> DataFrame:
    """``(nick, formal)`` learned from reference rows ``(entity, kind, surnames, given)`` that name one entity twice.

    Two first names of an entity with the same surname are one name's forms; the form more entities have is the formal
    one. A short form that merely begins the formal one needs no entry. A form of a form is one of the formal name.
    """
    # What is read more than once is written first, as its plan would stand so many times in the plan of the whole.
    spark = parsed.sparkSession
    sql = """
WITH g AS (SELECT DISTINCT entity, array_join(surnames, '+') AS surname, given[0] AS g FROM {parsed} WHERE kind IN ('person', 'firm') AND size(given) > 0 AND length(given[0]) >= 2)
SELECT entity, surname, g, n FROM g JOIN (SELECT g, count(DISTINCT entity) AS n FROM g GROUP BY g) USING (g)
"""
    firsts = materialize(spark.sql(sql, parsed=parsed), "first-names")
    sql = """
WITH p AS (
  SELECT a.g AS nick, b.g AS formal, count(*) AS c FROM {firsts} a JOIN {firsts} b USING (entity, surname)
  WHERE a.g <> b.g AND b.n > a.n AND length(b.g) >= 4 AND NOT startswith(b.g, a.g) GROUP BY 1, 2
)
SELECT nick, max_by(formal, struct(c, formal)) AS formal FROM p WHERE c >= 2 GROUP BY nick
"""
    best = materialize(spark.sql(sql, firsts=firsts), "nickname-forms")
    sql = "SELECT a.nick, coalesce(c.formal, b.formal, a.formal) AS formal FROM {best} a LEFT JOIN {best} b ON a.formal = b.nick LEFT JOIN {best} c ON b.formal = c.nick"
    return spark.sql(sql, best=best)


def with_formal_names(parsed: DataFrame, nicks: DataFrame, givens: DataFrame) -> DataFrame:
    """``parsed`` with ``first``: its first given name, slips undone against ``givens(r)`` and nicknames made formal."""
    first = materialize(parsed.withColumn("g", F.get("given", F.lit(0))), "name-parts")
    sql = """
WITH best AS (SELECT q, min_by(r, struct(d, r)) AS r FROM {near} WHERE d <= if(length(q) >= 6, 2, if(length(q) >= 4, 1, 0)) GROUP BY q)
SELECT f.*, coalesce(n.formal, b.r, f.g) AS first
FROM {first} f LEFT JOIN best b ON f.g = b.q LEFT JOIN {nicks} n ON coalesce(b.r, f.g) = n.nick
"""
    known = materialize(givens.select("r").union(nicks.select("nick")).distinct(), "given-names")
    near = closest(first.select(F.col("g").alias("q")).where(F.length("g") >= 4), known)
    return first.sparkSession.sql(sql, first=first, near=near, nicks=nicks).drop("g")

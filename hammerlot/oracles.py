"""SQL of the core queries for the checking engine, over the same whole tables.

Windows, merges and splits are written in SQL of their own here; scalar definitions and the list of graph templates are
shared with the operators and run in the other dialect.
"""

from __future__ import annotations

from hammerlot.functions import text as T
from hammerlot.functions import vocabularies as V
from hammerlot.operators import chunking, language_guess, pages, triples
from hammerlot.queries import EDITED

D = "duckdb"
# Definitions of their own, not shared with the operators.
_EDGES = "^[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+|[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+$"


def own_strip(x: str) -> str:
    return f"regexp_replace({x}, '{_EDGES}', '', 'g')"


def own_slug(x: str) -> str:
    folded = f"replace({own_strip(x)}, ' ', '_')"
    for plain, shown in (("a", "[àÀ]"), ("e", "[èéÈÉ]"), ("i", "[ìÌ]"), ("o", "[òÒ]"), ("u", "[ùÙ]"), ("_", "[/\\\\]"), ("and", "&"), ("", "[^\\p{L}\\p{N}_-]")):
        folded = f"regexp_replace({folded}, '{shown}', '{plain}', 'g')"
    return f"lower({folded})"


def own_name(x: str) -> str:
    s = own_strip(x)
    return f"CASE WHEN strpos({s}, '<') > 1 THEN {own_strip(f"string_split({s}, '<')[1]")} ELSE {s} END"


def own_place(x: str) -> str:
    s = own_strip(x)
    inner = f"regexp_extract({s}, '^[^<]+<([^>]+)>', 1)"
    return f"nullif({own_strip(inner)}, '')"


def own_day(x: str, sign: str) -> str:
    return f"array_to_string([{x}[1:4], {x}[5:6], {x}[7:8]], '{sign}')"


def own_dates(a: str, b: str) -> tuple[str, str, str]:
    """Label, begin and end."""
    digits = "regexp_full_match({}, '[0-9]+')"
    head = f"CASE WHEN {digits.format(a)} THEN {own_day(a, '/')} ELSE coalesce({own_strip(a)}, '') END"
    tail = f"CASE WHEN {b} IS NULL THEN '' WHEN {digits.format(b)} THEN concat(' - ', {own_day(b, '/')}) WHEN contains({b}, 'idem') THEN '' ELSE concat(' - ', {own_strip(b)}) END"
    begin = f"CASE WHEN {digits.format(a)} THEN {own_day(a, '-')} END"
    end = f"CASE WHEN {digits.format(b)} THEN {own_day(b, '-')} WHEN contains({b}, 'idem') THEN {begin} END"
    return f"concat({head}, {tail})", begin, end
_CLEAN = "translate({}, chr(1) || chr(2), '')"
_INNER = chunking.INNER_LOT.replace("(?=[A-ZÀ-ÖØ-öø-ÿ])", "([A-ZÀ-ÖØ-öø-ÿ])")


def _quoted(pattern: str) -> str:
    return T.literal(pattern, D)


def _chunks(source: str, key: str, pattern: str) -> str:
    """Lots of ``source(key, body, pattern)`` by a pattern given as SQL."""
    return f"""
m AS (SELECT {key}, pattern, string_split(regexp_replace(body, {pattern}, chr(1) || '\\1' || chr(2) || '\\2' || chr(2) || '\\0', 'g'), chr(1)) AS p FROM {source}),
u AS (SELECT {key}, pattern, unnest(p[2:]) AS piece, unnest(range(1, len(p))) AS idx FROM m WHERE len(p) > 1)
SELECT {key}, pattern, CAST(idx AS INTEGER) AS idx, {T.strip("split_part(piece, chr(2), 1)", D)} AS num, {T.strip("split_part(piece, chr(2), 2)", D)} AS title, {T.strip("split_part(piece, chr(2), 3)", D)} AS text FROM u"""


def _best(source: str, key: str) -> str:
    """Each text by its best pattern: one branch per pattern."""
    counts = ", ".join(f"len(regexp_extract_all(body, {_quoted('(?m)' + p)})) AS n_{name}" for name, p in chunking.PATTERNS.items())
    most = "greatest(" + ", ".join(f"n_{name}" for name in chunking.PATTERNS) + ")"
    choice = "CASE " + " ".join(f"WHEN n_{name} = {most} THEN '{name}'" for name in chunking.PATTERNS) + " END"
    marked = "CASE " + " ".join(
        f"WHEN pattern = '{name}' THEN regexp_replace(body, {_quoted('(?m)' + p)}, chr(1) || '\\1' || chr(2) || '\\2' || chr(2) || '\\0', 'g')" for name, p in chunking.PATTERNS.items()
    ) + " END"
    return f"""
counted AS (SELECT {key}, body, {counts} FROM {source}),
chosen AS (SELECT {key}, body, {choice} AS pattern FROM counted),
m AS (SELECT {key}, pattern, string_split({marked}, chr(1)) AS p FROM chosen),
u AS (SELECT {key}, pattern, unnest(p[2:]) AS piece, unnest(range(1, len(p))) AS idx FROM m WHERE len(p) > 1)
SELECT {key}, pattern, CAST(idx AS INTEGER) AS idx, {T.strip("split_part(piece, chr(2), 1)", D)} AS num, {T.strip("split_part(piece, chr(2), 2)", D)} AS title, {T.strip("split_part(piece, chr(2), 3)", D)} AS text FROM u"""


_PAGE_TEXTS = "documents_of AS (SELECT catalogue_id, count(*) AS n_pages, string_agg(text || chr(10), '' ORDER BY idx, chunk_id) AS text FROM chunks WHERE text IS NOT NULL GROUP BY catalogue_id)"

_SPLIT = f"""
lots AS (SELECT catalogue_id, idx, chunk_id, num, title, text, {T.digits_int("num", D)} AS cur FROM chunks),
nexts AS (SELECT *, nullif(lead(cur) OVER (PARTITION BY catalogue_id ORDER BY idx, chunk_id), 0) AS nxt FROM lots),
cut AS (SELECT *, CASE WHEN nxt - cur - 1 > 0 THEN string_split(regexp_replace({_CLEAN.format("text")}, {_quoted(_INNER)}, chr(1) || '\\1' || chr(2) || '\\0', 'g'), chr(1))[2:] END AS pieces FROM nexts),
numbered AS (SELECT *, list_transform(pieces, lambda x: CAST(split_part(x, chr(2), 1) AS BIGINT)) AS ns FROM cut),
judged AS (SELECT *, coalesce(nxt - cur - 1 > 0 AND len(list_distinct(list_filter(ns, lambda n: n > cur AND n < nxt))) = nxt - cur - 1, false) AS hidden FROM numbered),
spread AS (SELECT catalogue_id, idx, chunk_id, num, title, text, cur, nxt, hidden, unnest(CASE WHEN hidden THEN pieces ELSE [''] END) AS piece, unnest(range(CASE WHEN hidden THEN len(pieces) ELSE 1 END)) AS seg FROM judged),
kept AS (SELECT *, CASE WHEN hidden THEN CAST(split_part(piece, chr(2), 1) AS BIGINT) END AS n, {T.strip("split_part(piece, chr(2), 2)", D)} AS body FROM spread),
split_lots AS (
  SELECT catalogue_id, CAST(row_number() OVER (PARTITION BY catalogue_id ORDER BY idx, chunk_id, seg) AS INTEGER) AS idx,
    CASE WHEN hidden THEN CAST(n AS VARCHAR) ELSE num END AS num, CASE WHEN hidden THEN substring(split_part(body, chr(10), 1), 1, 120) ELSE title END AS title, CASE WHEN hidden THEN body ELSE text END AS text
  FROM kept WHERE NOT hidden OR (n >= cur AND n < nxt))"""


def _merge(source: str, order: str) -> str:
    return f"""
strict AS (SELECT *, {T.strict_int("num", D)} AS snum FROM {source}),
sides AS (SELECT *, lag(snum) OVER w AS before, lead(snum) OVER w AS after FROM strict WINDOW w AS (PARTITION BY catalogue_id ORDER BY {order})),
marked AS (SELECT *, coalesce(nullif(before, 0) + 1 = nullif(after, 0) AND (snum IS NULL OR snum <> before + 1), false) AS wrong FROM sides),
islands AS (SELECT *, sum(CASE WHEN wrong THEN 0 ELSE 1 END) OVER (PARTITION BY catalogue_id ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island FROM marked),
merged AS (
  SELECT catalogue_id, CAST(island AS INTEGER) AS idx, (list(num ORDER BY {order}))[1] AS num,
    CASE WHEN count(*) = 1 THEN (list(title ORDER BY {order}))[1] ELSE string_agg(coalesce(title, ''), ' ' ORDER BY {order}) END AS title,
    CASE WHEN count(*) = 1 THEN (list(text ORDER BY {order}))[1] ELSE string_agg(CASE WHEN wrong THEN coalesce({T.strip("text", D)}, '') ELSE coalesce(text, '') END, ' ' ORDER BY {order}) END AS text
  FROM islands GROUP BY catalogue_id, island)"""


_MERGED = _merge("chunks", "idx, chunk_id")
_REPORT = f"""
digits AS (SELECT *, nullif({T.digits_int("num", D)}, 0) AS dnum FROM merged),
lasts AS (SELECT *, last_value(dnum IGNORE NULLS) OVER (PARTITION BY catalogue_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM digits),
report AS (SELECT catalogue_id, last AS prev_num, dnum AS current_num, title, {T.strip("text", D)} AS excerpt FROM lasts WHERE dnum IS NOT NULL AND last IS NOT NULL AND dnum <> last + 1)"""


def _cleaned(x: str) -> str:
    return f"coalesce({T.strip(f'CAST({x} AS VARCHAR)', D)}, 'nan')"


def _flags(source: str) -> str:
    return f"""
flagged AS (SELECT l.*, EXISTS (SELECT 1 FROM report r WHERE {_cleaned("r.catalogue_id")} = {_cleaned("l.catalogue_id")} AND {_cleaned("r.current_num")} = {_cleaned("l.num")} AND {_cleaned("r.excerpt")} = {_cleaned("l.text")}) AS needs_revision FROM {source} l)"""


_HERE = f"catalogue_id = '{EDITED}' AND idx = 2"
_FILES = """files AS (
SELECT filename, regexp_extract(filename, '^([A-Za-z0-9]+_[A-Za-z0-9]+)_', 1) AS folder FROM (
  SELECT DISTINCT filename FROM pages_list WHERE filename IS NOT NULL
  UNION ALL SELECT catalogue_id || '_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || '_l.jpg' FROM documents WHERE catalogue_id IS NOT NULL))"""
_FOLDERED = f"foldered AS (SELECT {T.folder_id('filename', D)} AS folder_id, filename FROM pages_list WHERE {T.folder_id('filename', D)} IS NOT NULL)"


def _items(column: str) -> str:
    return f"(SELECT unnest({T.parts(column, D)}) AS item FROM auctions WHERE {column} IS NOT NULL)"


def _graph(catalogues: bool = True, auctions: bool = True) -> str:
    """``graph(s, p, o, ...)`` of either or both tables."""
    null = "cast(null as varchar)"
    ctes, parts = [], []
    if catalogues:
        ctes.append(f"cat AS ({triples.catalogue_sql('catalogues', D)})")
        parts.append(triples.templates_sql("cat", triples.catalogue_templates()))
    if auctions:
        ctes.append(f"auc AS ({triples.auction_sql('auctions', D)})")

        def spread(column: str) -> str:
            return f"(SELECT id, unnest({T.parts(column, D)}) AS item FROM auc WHERE {column} IS NOT NULL)"

        ctes.append(f"hold AS (SELECT id, item, {T.slug('item', D)} AS item_slug FROM {spread('collezionisti')} x WHERE item <> '')")
        ctes.append(f"hammer AS (SELECT id, {T.name_part('item', D)} AS item_name, {T.place_part('item', D)} AS item_role FROM {spread('banditore')} x WHERE item <> '')")
        ctes.append(f"hammers AS (SELECT h.*, {T.slug('item_name', D)} AS item_slug, coalesce(r.code, '{V.AUCTIONEER}') AS code FROM hammer h LEFT JOIN {V.values_sql(V.ROLES)} r(label, code) ON h.item_role = r.label)")
        ctes.append(f"kinds AS (SELECT x.*, t.code, {T.slug('item', D)} AS item_slug FROM {spread('tipi_oggetti')} x JOIN {V.values_sql(V.OBJECT_TYPES)} t(label, code) ON x.item = t.label)")
        ctes.append(f"spans AS (SELECT DISTINCT period, period_slug, t.code FROM auc JOIN {V.values_sql(V.PERIODS)} t(label, code) ON period = t.label)")
        parts += [
            triples.templates_sql("auc", triples.auction_templates()),
            triples.templates_sql("hold", triples.holding_templates()),
            triples.templates_sql("hammers", triples.auctioneer_templates()),
            triples.templates_sql("kinds", triples.object_type_templates()),
            triples.templates_sql("spans", triples.century_templates()),
        ]
    body = "\nUNION ALL ".join(parts).replace("cast(null as string)", null)
    return "WITH " + ",\n".join(ctes) + f",\ngraph_of AS (SELECT DISTINCT * FROM ({body}) y)"


def _oracles() -> dict[str, str]:
    out = {}
    for name, pattern in chunking.PATTERNS.items():
        body = "'| ' || regexp_replace(text, '^(?:#+|-)\\s*', '')" if name == "pipe_prefix" else "text"
        source = f"WITH src AS (SELECT chunk_id, {_CLEAN.format(body)} AS body, '{name}' AS pattern FROM chunks WHERE text IS NOT NULL),"
        out[f"chunk_{name}"] = f"SELECT * EXCLUDE (pattern) FROM ({source}{_chunks('src', 'chunk_id', _quoted('(?m)' + pattern))})"
    out["chunk_best_pattern"] = f"WITH src AS (SELECT doc_id, {_CLEAN.format('text')} AS body FROM documents WHERE text IS NOT NULL),{_best('src', 'doc_id')}"
    out["chunk_catalogue_texts"] = f"""SELECT catalogue_id, pattern, idx, num, title, md5(text) AS digest FROM (
WITH {_PAGE_TEXTS}, src AS (SELECT catalogue_id, {_CLEAN.format('text')} AS body FROM documents_of),{_best('src', 'catalogue_id')})"""
    out["gap_split"] = f"WITH {_SPLIT} SELECT * FROM split_lots"
    out["merge_sandwiched"] = f"WITH {_MERGED} SELECT * FROM merged"
    out["pipeline_lots"] = f"WITH {_SPLIT}, {_merge('split_lots', 'idx')} SELECT * FROM merged"
    report = f"WITH {_MERGED}, {_REPORT}"
    out["recalc_inconsistencies"] = f"{report} SELECT * FROM report"
    flagged = f"{report}, {_flags('merged')}"
    out["flag_needs_revision"] = f"{flagged} SELECT * FROM flagged"
    out["catalogue_stats"] = f"""{flagged} SELECT catalogue_id, count(*) FILTER (WHERE needs_revision) AS issues, count(*) AS total,
round_even(count(*) FILTER (WHERE needs_revision) / count(*) * 100, 1) AS percent_issues FROM flagged WHERE catalogue_id IS NOT NULL GROUP BY catalogue_id"""
    out["view_catalogue"] = f"{flagged} SELECT *, 'chunk-' || idx AS anchor_id FROM flagged WHERE catalogue_id = '{EDITED}'"
    out["update_chunk"] = f"""{report}, edited AS (SELECT catalogue_id, idx, num, CASE WHEN {_HERE} THEN 'A new title' ELSE title END AS title, CASE WHEN {_HERE} THEN 'A new text' ELSE text END AS text FROM merged), {_flags('edited')} SELECT * FROM flagged"""
    saved = f"""new_rows AS (SELECT catalogue_id, CAST(row_number() OVER (ORDER BY pos NULLS LAST, num NULLS FIRST, title NULLS FIRST, text NULLS FIRST) AS INTEGER) AS idx, num, title, text FROM (
  SELECT catalogue_id, CASE WHEN idx % 5 <> 0 THEN idx // 2 END AS pos, {T.strip("num", D)} AS num, {T.strip("upper(title)", D)} AS title, {T.strip("text", D)} AS text FROM merged WHERE catalogue_id = '{EDITED}') n),
saved AS (SELECT catalogue_id, idx, num, title, text FROM merged WHERE catalogue_id IS DISTINCT FROM '{EDITED}' UNION ALL SELECT * FROM new_rows)"""
    out["save_catalogue"] = f"WITH {_MERGED}, {saved}, {_REPORT.replace('FROM merged', 'FROM saved')}, {_flags('saved')} SELECT * FROM flagged"
    out["pipeline_report"] = f"WITH {_SPLIT}, {_merge('split_lots', 'idx')}, {_REPORT} SELECT * FROM report"
    out["resolve_inconsistency"] = f"{report} SELECT * FROM report WHERE NOT coalesce(catalogue_id = '{EDITED}' AND CAST(prev_num AS VARCHAR) = '1', false)"
    out["concat_pages"] = f"WITH {_PAGE_TEXTS} SELECT catalogue_id, n_pages, length(text) AS n_chars, md5(text) AS digest FROM documents_of"
    out["folder_index"] = f"WITH {_FOLDERED} SELECT folder_id, count(*) AS n_pages, string_agg(filename, ';' ORDER BY filename) AS filenames FROM foldered GROUP BY folder_id"
    out["select_pages"] = f"WITH {_FILES}, {_FOLDERED} SELECT filename, folder FROM files WHERE filename IN (SELECT filename FROM foldered)"
    out["select_pages_of_folders"] = f"WITH {_FILES}, {_FOLDERED} SELECT filename, folder FROM files WHERE filename IN (SELECT filename FROM foldered) AND folder IN ('{EDITED}', 'BX0101_0000001')"
    out["pending_pages"] = f"WITH {_FILES} SELECT filename, folder FROM files f WHERE NOT EXISTS (SELECT 1 FROM pages_list p WHERE p.filename = f.filename)"
    out["slugify"] = f"SELECT agent_id, {own_slug('label')} AS slug FROM reconciled_agents"
    out["name_place"] = f"""SELECT agent, {own_name('agent')} AS name, {own_place('agent')} AS place FROM (
SELECT autori_principali AS agent FROM catalogues UNION SELECT ente_autore_principale FROM catalogues UNION SELECT ente_autore_secondario FROM catalogues UNION SELECT autori_secondari FROM catalogues) x WHERE agent IS NOT NULL"""
    out["role_extract"] = f"SELECT DISTINCT {T.bracketed('item', D)} AS role FROM {_items('banditore')} x WHERE {T.bracketed('item', D)} IS NOT NULL"
    out["multi_value_distinct"] = f"SELECT DISTINCT item FROM {_items('tipi_oggetti')} x"
    out["column_unique"] = "SELECT DISTINCT cronologia FROM auctions WHERE cronologia IS NOT NULL"
    out["number_parsers"] = f"SELECT chunk_id, {T.digits_int('num', D)} AS digits_int, {T.strict_int('num', D)} AS strict_int FROM chunks"
    a, b = "data_inizio_asta", "data_fine_asta"
    label, begin, end = own_dates(a, b)
    span = own_slug(f"replace({own_strip('label')}, ' - ', '-')")
    out["date_normalise"] = f"SELECT *, {span} AS span, try_strptime(begin_date, '%Y-%m-%d') IS NOT NULL AS begin_valid FROM (SELECT DISTINCT inventario, {a}, {b}, {label} AS label, {begin} AS begin_date, {end} AS end_date FROM auctions) x"
    langs = V.values_sql(V.LANGUAGES)
    out["lookup_required"] = f"SELECT lingue, code, count(*) AS n FROM catalogues JOIN {langs} l(label, code) ON lingue = label GROUP BY lingue, code"
    out["lookup_unmatched"] = f"SELECT nome_cartella, lingue, data_pubblicazione FROM catalogues LEFT JOIN {langs} l(label, code) ON lingue = label WHERE label IS NULL OR try_cast({T.strip('data_pubblicazione', D)} AS DOUBLE) IS NULL"
    out["lookup_default"] = f"""SELECT item, role, coalesce(code, '{V.AUCTIONEER}') AS code FROM (SELECT DISTINCT item, {T.place_part('item', D)} AS role FROM {_items('banditore')} x WHERE item <> '') y
LEFT JOIN {V.values_sql(V.ROLES)} r(label, code) ON role = label WHERE role IS NOT NULL"""
    out["lookup_drop_empty"] = f"SELECT item, code, count(*) AS n FROM {_items('tipi_oggetti')} x JOIN {V.values_sql(V.OBJECT_TYPES)} t(label, code) ON item = label GROUP BY item, code"
    out["lookup_one_to_many"] = f"SELECT DISTINCT cronologia, code FROM auctions LEFT JOIN {V.values_sql(V.PERIODS)} t(label, code) ON cronologia = label WHERE cronologia IS NOT NULL"
    out["catalogue_auction_join"] = f"""WITH l AS (SELECT DISTINCT id, title FROM ({triples.catalogue_sql('catalogues', D)}) x), r AS (SELECT DISTINCT id, span_label FROM ({triples.auction_sql('auctions', D)}) x)
SELECT id, title, span_label FROM l FULL OUTER JOIN r USING (id)"""
    out["triples_catalogue"] = _graph(auctions=False) + " SELECT * FROM graph_of"
    out["triples_auction"] = _graph(catalogues=False) + " SELECT * FROM graph_of"
    out["triples_all"] = _graph() + " SELECT * FROM graph_of"
    out["role_assignments"] = _graph() + " SELECT * FROM graph_of WHERE s LIKE '%\\_assignment\\_%' ESCAPE '\\'"
    value = "replace(replace(replace(replace(replace(o, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    target = f"CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE '\"' || {value} || '\"' || CASE WHEN o_lang IS NOT NULL THEN '@' || o_lang WHEN o_datatype IS NOT NULL THEN '^^<' || o_datatype || '>' ELSE '' END END"
    out["trig_lines"] = _graph() + f" SELECT '<' || s || '> <' || p || '> ' || {target} || ' <' || graph || '> .' AS line FROM graph_of"
    out["reconcile_agents"] = f"""WITH names AS (
  SELECT {T.slug('wikidata_label', D)} AS name, 0 AS rank, wikidata_id, wikidata_label FROM authority
  UNION ALL SELECT {T.slug('alias', D)}, 1, wikidata_id, wikidata_label FROM (SELECT wikidata_id, wikidata_label, unnest(string_split(aliases, ';')) AS alias FROM authority WHERE aliases IS NOT NULL) x),
best AS (SELECT * FROM names WHERE name <> '' QUALIFY row_number() OVER (PARTITION BY name ORDER BY rank, wikidata_id, wikidata_label) = 1)
SELECT agent_id, label, b.wikidata_id, b.wikidata_label, CASE rank WHEN 0 THEN 'label' WHEN 1 THEN 'alias' END AS match_type FROM reconciled_agents a LEFT JOIN best b ON {T.slug('a.label', D)} = b.name"""
    out["preview_agents"] = "SELECT agent_id, uri, label FROM reconciled_agents ORDER BY agent_id LIMIT 5"
    out["missing_documents"] = f"""SELECT DISTINCT catalogue_id, 'no text' AS error FROM (SELECT unnest(list_transform(string_split(nome_cartella, ';'), lambda x: {own_strip('x')})) AS catalogue_id FROM catalogues WHERE nome_cartella IS NOT NULL) x
WHERE catalogue_id NOT IN (SELECT catalogue_id FROM documents WHERE catalogue_id IS NOT NULL)"""
    out["required_languages"] = f"SELECT nome_cartella, lingue, code FROM catalogues JOIN {langs} l(label, code) ON lingue = label"
    out["quote_names"] = "SELECT DISTINCT titolo, url_encode(titolo) AS quoted FROM catalogues WHERE titolo IS NOT NULL"
    out["transcribe_pages"] = "SELECT DISTINCT filename, CASE WHEN filename <> '' THEN '## 1 - ' || filename END AS text, CASE WHEN filename = '' THEN 'empty transcription' END AS error FROM pages_list WHERE filename IS NOT NULL"
    out["split_separators"] = f"""SELECT page, CAST(unnest(range(1, len(p) + 1)) AS INTEGER) AS idx, {own_strip('unnest(p)')} AS text FROM (
SELECT chunk_id AS page, list_filter(string_split(replace(text, chr(10) || chr(10), chr(10) || '---------' || chr(10)), '---------'), lambda x: regexp_matches(x, '[^\\s\\p{{Z}}]')) AS p FROM chunks WHERE text IS NOT NULL) x"""
    votes = ", ".join(f"len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in words.split())}))) AS v_{lang}" for lang, words in language_guess.WORDS.items())
    most = "greatest(" + ", ".join(f"v_{lang}" for lang in language_guess.WORDS) + ")"
    scripts = " ".join(f"WHEN len(regexp_extract_all(text, '{letters}')) * 3 > greatest(latin, 1) THEN '{lang}'" for lang, letters in language_guess.SCRIPTS.items())
    by_word = " ".join(f"WHEN v_{lang} > 0 AND v_{lang} = {most} THEN '{lang}'" for lang in language_guess.WORDS)
    out["detect_languages"] = f"""SELECT doc_id, lang, CASE WHEN text IS NULL OR trim(text) = '' THEN NULL {scripts} {by_word} END AS detected FROM (
SELECT *, {votes} FROM (SELECT doc_id, lang, text, len(regexp_extract_all(text, '[A-Za-zÀ-ɏ]')) AS latin, regexp_extract_all(lower(text), '\\p{{L}}+') AS w FROM documents) x) y"""
    prompt = pages.PROMPT.replace("'", "''").split("%s")
    out["prompt_render"] = f"SELECT DISTINCT filename, '{prompt[0]}' || filename || '{prompt[1]}' AS prompt FROM pages_list WHERE filename IS NOT NULL"
    return out


ORACLES: dict[str, str] = _oracles()

"""Repair of text from scanned pages: page furniture, words broken over lines, misread characters.

1. Lines that stand alone and look like running headers or page numbers are candidates; a header is confirmed by
   repetition (of its owner's name within the catalogue, or of its wording over catalogues).
2. Furniture is taken out, words broken by a hyphen-like sign are joined, and the rest is cut into words.
3. The vocabulary is counted over all texts. Every word type is looked up in a trie of the vocabulary by a weighted
   Levenshtein automaton (``vocabulary_trie``); candidates are ranked by cost, by the words beside them, by frequency.
4. The text is put together again as continuous paragraphs.

Counts cover all rows. Nothing that grows with the corpus is broadcast by hand or sent to the driver: types, pairs of
neighbours and corrections are tables, joined by key.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerlot.llm.vocabulary_trie import query_keys, within_shard
from hammerlot.plans.broadcasting import broadcast_if_small
from hammerlot.plans.materialize import materialize
from hammerlot.plans.parallelism import spread

HYPHENS = "-‐‑¬­–"
#: A misread type must be this many times rarer than the word it stands for.
RARER = 6
#: Words of up to three letters have many neighbours and need more evidence.
RARER_SHORT = 25
#: Neighbour counts must favour the other word by this factor where both are common.
CONTEXT_FACTOR = 12
#: Times that a word must stand in the texts to enter the vocabulary.
VOCABULARY_LEAST = 3
#: A word belongs to the wording of headers if capital lines of this share of the catalogues have it.
WORDING_SHARE = 0.004
#: White space at the ends of lines.
BLANKS = " \t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Listed vocabulary words of one task, and word types that ask there; beyond it a task's types are split.
SHARD_WORDS, SHARD_TYPES = 100_000, 50_000
#: Least letters of a word that only its neighbours show to be misread beyond the known confusions.
PLAIN_LETTERS = 6

_PAGE_NUMBER = r"^\s*(?:[-—–~]\s*)?(?:\[\s*|\(\s*)?(?:(?:[Pp]ag(?:e|ina)?|[Pp]|[Ss]eite|[Ss]|[Bb]lz|[Bb]ladz)\b\.?\s*)?[0-9IlOSB]{1,4}(?:\s*\]|\s*\))?(?:\s*[-—–~]|\s+\.)?\s*$"
_NUMBER_AT_END = r"^\s*\d{1,4}\s+|\s+[-—–|]?\s*\d{1,4}\s*$"


def page_number_line(line: Column) -> Column:
    """A line that is only a page number, bare or in brackets, dashes, tildes or after a page sign.

    Years (four digits, 1400 to 2030) are none, nor are numbers with a currency or measure.
    """
    digits = F.translate(F.regexp_replace(line, r"[^0-9IlOSB]", ""), "IlOSB", "11058")
    digits = F.when(line.rlike(r"(?i)pag|seite|\bp\.|blz"), F.regexp_replace(line, r"[^0-9]", "")).otherwise(digits)
    number = digits.try_cast("int")
    paired = ~line.rlike(r"^\s*[\[(][^\])]*$|^[^\[(]*[\])]\s*$")
    return line.rlike(_PAGE_NUMBER) & line.rlike(r"\d") & number.between(1, 1399) & (F.length(digits) <= 4) & paired


def header_key(line: Column) -> Column:
    """Header wording: lower case, without a page number in front or behind, letters and spaces only."""
    bare = F.regexp_replace(F.regexp_replace(line, _NUMBER_AT_END, " "), r"[^\p{L}\p{N} ']", " ")
    return F.lower(F.trim(F.regexp_replace(bare, r"\s+", " ")))


def lines_of(df: DataFrame, text: str, key: str, catalogue: str) -> DataFrame:
    """``(key, catalogue, line_no, line)`` for all lines but the first of every text, blank lines left out."""
    parts = F.split(F.col(text), r"\n")
    exploded = df.select(F.col(key).alias("key"), F.col(catalogue).alias("catalogue"), F.posexplode(parts).alias("line_no", "line"))
    return exploded.where((F.col("line_no") > 0) & (F.length(F.trim("line")) > 0))


def furniture_lines(df: DataFrame, text: str = "text", key: str = "chunk_id", catalogue: str = "catalogue_id") -> DataFrame:
    """``(key, line_no, line, noise)`` with noise ``header`` or ``pageno``, one row per line of page furniture."""
    lines = lines_of(df, text, key, catalogue)
    line = F.col("line")
    lines = lines.withColumn("line", F.trim(line, F.lit(BLANKS)))
    # What can be neither is left out first: long lines, and those with a word in small letters but no three capitals in a row.
    prose = line.rlike(r"(?:^|\s)[\p{Ll}][\p{L}]{3,}")
    lines = lines.where((F.length(line) <= 90) & (~prose | line.rlike(r"\p{Lu}\P{L}*\p{Lu}\P{L}*\p{Lu}") | line.rlike(_PAGE_NUMBER)))
    letters = F.regexp_replace(line, r"[^\p{L}]", "")
    capitals = F.length(F.regexp_replace(letters, r"[^\p{Lu}]", "")) >= 0.8 * F.length(letters)
    hashed = line.startswith("#")
    titled = ~hashed & ~line.rlike(r"(?:^|\s)[\p{Ll}][\p{L}]{3,}") & line.rlike(r"^(?:\d+\s+)?\p{Lu}")
    shape = (
        (F.length(letters) >= 7)
        & (F.length(line) <= 90)
        & line.rlike(r"\p{L}{2}.*[\s,']\p{L}")
        & ~line.rlike(r"^[-*+|(\[<&%$\\`~{=]|[|\\<>`{}=_&$*]|[.;:?]$")
        & ~line.rlike(r"(?i)\b(?:cm|cent|diam|haut|alt|largh?|hoog|breed|höhe|breite|in)\b\s*[.,]|\d\s*[x×]\s*\d")
    )
    marked = lines.select("key", "catalogue", "line_no", line.alias("line"), capitals.alias("capitals"), hashed.alias("hashed"), (shape & (capitals | titled)).alias("headed"), page_number_line(F.col("line")).alias("pageno"))
    numbers = marked.where("pageno").select("key", "line_no", "line", F.lit("pageno").alias("noise"))
    heads = materialize(marked.where("headed and not pageno").withColumn("wording", header_key(F.col("line"))), "head-lines")

    words = heads.select("key", "catalogue", "line_no", (F.col("capitals") & ~F.col("hashed")).alias("capitals"), F.explode(F.array_distinct(F.split("wording", " "))).alias("word"))
    # Wording: words that capital lines of a share of all catalogues have, three at least; names of owners are rarer.
    catalogues = heads.agg(F.count_distinct("catalogue")).first()[0] or 0
    least = max(3, int(catalogues * WORDING_SHARE))
    common = words.where("capitals and catalogue is not null").select("catalogue", "word").distinct().groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("word", F.lit(True).alias("common"))
    # Owner: another word of a capital line that stands in lines of at least two texts of the catalogue.
    owners = words.where("capitals and length(word) >= 5").groupBy("catalogue", "word").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("catalogue", "word", F.lit(True).alias("owner"))
    judged = (
        words.join(common, "word", "left")
        .join(owners, ["catalogue", "word"], "left")
        .groupBy("key", "line_no")
        .agg(
            F.count_if(F.col("common")).alias("n_common"),
            F.count_if(F.col("owner")).alias("n_owner"),
            F.count("*").alias("n_words"),
            F.count_if(F.col("common") & (F.length("word") >= 4)).alias("n_common_long"),
            F.count_if(F.col("common").isNull() & (F.length("word") >= 6)).alias("n_name"),
        )
    )
    # The same wording without a mark, in the catalogue.
    unmarked = heads.where("capitals and not hashed").select("catalogue", "wording").distinct().withColumn("unmarked", F.lit(True))
    headers = (
        heads.join(judged, ["key", "line_no"])
        .join(unmarked, ["catalogue", "wording"], "left")
        .where(
            # A line marked as heading needs both a name and the wording of headers, or stands elsewhere without the mark.
            F.when(F.col("hashed"), F.col("capitals") & (F.col("n_words") >= 2) & (((F.col("n_name") >= 1) & (F.col("n_common_long") >= 1)) | F.col("unmarked")))
            .when(F.col("capitals"), (F.col("n_words") >= 2) & ((F.col("n_common") >= 1) | (F.col("n_owner") >= 1)))
            .otherwise((F.col("n_common_long") >= 1) & ((F.col("n_owner") >= 1) | ((F.col("n_common") == F.col("n_words") - 1) & (F.col("n_name") == 1))))
        )
        .select("key", "line_no", "line", F.lit("header").alias("noise"))
    )
    return numbers.unionByName(headers)


_MASK = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)|\\begin\{(verbatim|equation|tabular)\}.*?\\end\{\1\}|<(pre|math|syntaxhighlight|code)\b.*?</\2>|<span class=\"math\">.*?</span>|<[^<>\n]{1,80}>|\$\$?[^$\n]*\$\$?|\\[\[(].*?\\[\])]|\\[a-zA-Z]+\*?(?:\{[^{}\n]*\}(?=\W))?|&#?\w+;|https?://\S+|\{\{[^}]*\}\}|\[\[[^\]|]*\||\S*_\S*|\{\|.*?\|\}", re.S)
_PART = r"(?:[^\W_]|!(?=[^\W_])|(?<=[^\W\d_])!(?=\s+[a-zà-ÿ]))"
_WORD = re.compile(rf"{_PART}+(?:['’]{_PART}+|-{_PART}+)*")
_JOINT = re.compile(rf"[{HYPHENS}][^\S\n]*\n?[^\S\n]*(?=[^\W\d_]|!|\d[^\W\d_])")
_HYPHEN_SET = frozenset(HYPHENS)
_STOP_BETWEEN = re.compile(r"[.;:?…(),\n]\s*\n|[.;:?…(]")
CONJUNCTIONS = frozenset("und oder u bzw sowie et ou e o ed od en of and or bis y".split())


def cut(text: str, furniture: set[int]) -> tuple[list[str], list[str]]:
    """Words of a text without its furniture lines, and its broken words.

    Words come in order as ``surface`` strings, with ``""`` where a stop separates neighbours. A broken word is given as
    its parts joined by ``\\u0001`` and leaves ``""`` in the row of words.
    """
    if furniture:
        text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in furniture)
        text = re.sub(r"\n{2,}(?=[a-zß-öø-ÿ])", "\n", text)
    text = _MASK.sub(" . ", text)
    words: list[str] = []
    broken: list[str] = []
    at = 0
    pieces: list[str] = []
    while m := _WORD.search(text, at):
        start, end = m.span()
        # Most words are a blank apart.
        if at and not pieces and (start - at != 1 or text[at] != " ") and _STOP_BETWEEN.search(text, at, start):
            words.append("")
        piece = m.group()
        joint = _JOINT.match(text, end) if text[end : end + 1] in _HYPHEN_SET else None
        if joint and not joint.group()[-1:].strip() and not piece.isdigit():
            pieces.append(piece)
            at = joint.end()
            continue
        if pieces:
            broken.append("\u0001".join((*pieces, piece)))
            words.append("")
            pieces = []
        else:
            words.append(piece)
        at = end
    return words, broken


PLACES = 1_000_000
_SEPARATOR = re.compile(r"['’-]")


def parts_of(words: list[str]) -> tuple[list[str], list[int]]:
    """Parts of words between hyphens and apostrophes in one row, ``""`` for a stop, and where each stands: the number of
    its word times ``PLACES`` and its number in the word."""
    parts: list[str] = []
    places: list[int] = []
    for at, word in enumerate(words):
        if word.isalnum():
            parts.append(word)
            places.append(at * PLACES)
        else:
            for j, part in enumerate(_SEPARATOR.split(word)):
                parts.append(part)
                places.append(at * PLACES + j)
    return parts, places


def _fields(df: DataFrame, furniture: DataFrame, text: str, title: str, key: str) -> DataFrame:
    """``(key, field, words, parts, places, broken, alone)``; texts are cut once, after their furniture is gone.

    ``alone`` holds the parts of broken words, which have no neighbours.
    """
    taken = furniture.groupBy("key").agg(F.collect_set("line_no").alias("taken"))
    source = df.select(F.col(key).alias("key"), F.col(text).alias("body"), F.col(title).alias("head")).where("body is not null or head is not null")
    source = spread(source).join(taken, "key", "left")

    def row(k: object, field: str, words: list[str], broken: list[str]) -> tuple:
        return (k, field, words, *parts_of(words), broken, parts_of([b.replace("\u0001", "") for b in broken])[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, body, head, lines in zip(batch["key"], batch["body"], batch["head"], batch["taken"], strict=True):
                if body:
                    rows.append(row(k, "text", *cut(body, set(lines) if lines is not None else set())))
                if head:
                    rows.append(row(k, "title", *cut(head, set())))
            if rows:
                yield pd.DataFrame(rows, columns=["key", "field", "words", "parts", "places", "broken", "alone"])

    kind = df.schema[key].dataType.simpleString()
    return source.mapInPandas(run, f"key {kind}, field string, words array<string>, parts array<string>, places array<bigint>, broken array<string>, alone array<string>")


def _neighbours(fields: DataFrame) -> DataFrame:
    """``(key, field, p, w, n)``: each word part in lower case with its neighbours, ``""`` for none."""
    alone = F.flatten(F.transform("alone", lambda x: F.array(F.lit(""), F.lower(x))))
    flat = fields.select("key", "field", F.concat(F.transform("parts", lambda x: F.lower(x)), alone).alias("x"))
    # The row of words is only looked into, so nothing but the three words leaves this stage.
    placed = flat.select("key", "field", "x", F.posexplode("x").alias("i", "w")).where("w <> ''")
    return placed.select("key", "field", F.when(F.col("i") > 0, F.get("x", F.col("i") - 1)).otherwise("").alias("p"), "w", F.coalesce(F.get("x", F.col("i") + 1), F.lit("")).alias("n"))


SURE = r"(?:\p{L}[0-9!]|[0-9!]\p{L}|ſ)"


def corrections(neighbours: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(p, w, n, v)``: for a word ``w`` between ``p`` and ``n`` that was misread, the word ``v`` the page had. And
    ``(w, number)``: all types that are corrected somewhere or are numbers with letters in them.

    Two words that differ only by scan confusions are compared. A type much rarer than the other is a misreading
    wherever it stands; where both are common, only between neighbours that decide for the other.

    Titles repeat lines of the texts, so frequencies are those of the texts, but words are looked up in the contexts of
    both fields. A type that no text has counts as often as titles have it.
    """
    asked = materialize(neighbours.groupBy("p", "w", "n").agg(F.count_if(F.col("field") == "text").alias("count"), F.count("*").alias("uses")), "contexts")
    contexts = asked.where("count > 0")
    types = materialize(asked.groupBy("w").agg(F.sum("count").alias("c"), F.sum("uses").alias("uses")), "types")
    vocabulary = types.where((F.col("c") >= VOCABULARY_LEAST) & ~F.col("w").rlike(r"[0-9!ſ]"))
    # Number-like types are settled by rule, single letters are no words to look up.
    queries = types.where((F.length("w") >= 2) & F.col("w").rlike(r"\p{L}") & ~F.col("w").rlike(r"^[0-9ilosb]*[0-9][0-9ilosb]*$"))
    found = _candidates(queries.select("w"), vocabulary.select(F.col("w").alias("v")))
    counts = types.select(F.col("w").alias("v"), F.col("c").alias("cv"))
    own = types.select("w", F.when(F.col("c") > 0, F.col("c")).otherwise(F.col("uses")).alias("c"))
    pairs = found.join(own, "w").join(counts, "v")
    sure = F.col("w").rlike(SURE)
    factor = F.when(F.length("w") <= 3, RARER_SHORT).otherwise(RARER)
    pairs = pairs.withColumn("free", F.when(sure, F.col("cv") > F.col("c")).otherwise(F.col("c") * factor * F.col("cost") <= F.col("cv")))
    # A type that cannot be a word may need any edit. A plain one that no confusion explains needs both neighbours for it.
    plain = (F.col("edits") > 0) & ~sure
    pairs = pairs.withColumn("plain", plain).where("free or (edits = 0 and cost = 1 and cv * 2 > c)")
    pairs = materialize(pairs.where(~F.col("plain") | ((F.length("w") >= PLAIN_LETTERS) & (F.col("c") < VOCABULARY_LEAST))), "pairs")

    left_n = contexts.where("p <> ''").groupBy("p", "w").agg(F.sum("count").alias("m"))
    right_n = contexts.where("n <> ''").groupBy("w", "n").agg(F.sum("count").alias("m"))
    seen = asked.join(pairs, "w")
    seen = (
        seen.join(left_n.select("p", F.col("w").alias("v"), F.col("m").alias("pv")), ["p", "v"], "left")
        .join(left_n.select("p", "w", F.col("m").alias("pw")), ["p", "w"], "left")
        .join(right_n.select(F.col("w").alias("v"), "n", F.col("m").alias("vn")), ["v", "n"], "left")
        .join(right_n.select("w", "n", F.col("m").alias("wn")), ["w", "n"], "left")
        .na.fill(0, ["pv", "pw", "vn", "wn"])
    )
    better_left = (F.col("pv") >= CONTEXT_FACTOR * F.col("pw")) & (F.col("pv") > 0)
    better_right = (F.col("vn") >= CONTEXT_FACTOR * F.col("wn")) & (F.col("vn") > 0)
    by_context = better_left & better_right
    by_rarity = F.col("free") & ~F.col("plain") & (sure | (F.col("pv") + F.col("vn") + 2 >= F.col("pw") + F.col("wn")))
    score = F.struct(-F.col("edits"), -F.col("cost"), F.col("pv") + F.col("vn"), F.col("cv"), F.col("v"))
    best = seen.where(by_rarity | by_context).groupBy("p", "w", "n").agg(F.max_by("v", score).alias("v"))
    best = materialize(best, "corrections")
    numbers = types.where(F.col("w").rlike(r"^[0-9ilosb]{2,}$") & F.col("w").rlike(r"\d") & F.col("w").rlike(r"\D")).select("w", F.lit(True).alias("number"))
    return best, materialize(best.select("w", F.lit(False).alias("number")).union(numbers).groupBy("w").agg(F.max("number").alias("number")), "misread-types")


def _candidates(queries: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(w, v, cost, edits)``: every word ``v`` of the vocabulary within the budget of ``w``, but ``w`` itself.

    Both sides are sent to the shards of the trie that their beginnings and ends name. Shards are put into tasks of a
    bounded number of vocabulary words; where more types ask there than one task should take, they are split.
    """

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, w) for w in batch["w"] for k in query_keys(w)]
            yield pd.DataFrame(rows, columns=["key", "w"])

    v = F.col("v")
    keys = F.array(
        F.concat(F.lit("F"), v.substr(1, 2)), F.when(F.length(v) >= 3, F.concat(F.lit("R"), F.right(v, F.lit(2)))),
        F.when(F.length(v).between(2, 4), F.concat(F.lit("S"), F.right(v, F.lit(1)))), F.when(F.length(v) <= 3, F.lit("T")),
    )
    listed = materialize(vocabulary.select(F.explode(F.array_compact(keys)).alias("key"), "v"), "vocabulary-shards")
    tasks = max(64, -(-listed.count() // SHARD_WORDS))
    task = F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task")
    asking = materialize(spread(queries).mapInPandas(keyed, "key string, w string").join(listed.select("key").distinct(), "key", "left_semi").select(task, "key", "w"), "type-shards")
    parts = asking.groupBy("task").agg(F.ceil(F.count("*") / SHARD_TYPES).cast("int").alias("parts"))
    left = asking.join(parts, "task").select("task", F.pmod(F.xxhash64("w"), F.col("parts")).alias("part"), "key", "w")
    right = listed.select(task, "key", "v").join(parts, "task").select("task", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1)).alias("part"), "key", "v")

    def look_up(types: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        words = known.groupby("key")["v"]
        rows: list[tuple[str, str, int, int]] = []
        for key, asked in types.groupby("key")["w"]:
            rows += within_shard(key, words.get_group(key), asked)
        return pd.DataFrame(rows, columns=["w", "v", "cost", "edits"])

    found = left.groupBy("task", "part").cogroup(right.groupBy("task", "part")).applyInPandas(look_up, "w string, v string, cost int, edits int")
    best = found.groupBy("w", "v").agg(F.min(F.struct("edits", "cost")).alias("x"))
    return best.select("w", "v", "x.cost", "x.edits")


def _number(part: Column) -> Column:
    """A number with letters read for digits, as digits; null for anything else."""
    shaped = part.rlike(r"^[0-9IlOoSsBb]{2,}$") & part.rlike(r"\d") & part.rlike(r"[^0-9]") & (2 * F.length(F.regexp_replace(part, r"\D", "")) >= F.length(part))
    return F.when(shaped, F.translate(part, "IlOoSsBb", "11005588"))


def _cased(shown: Column, meant: Column) -> Column:
    """``meant`` in the letter case of ``shown``: all capitals, first capital, or lower."""
    letters = F.regexp_replace(shown, r"[^\p{L}]", "")
    upper = (F.length(letters) >= 2) & (F.length(F.regexp_replace(letters, r"[^\p{Lu}]", "")) >= 0.7 * F.length(letters))
    return F.when(upper & (F.length(letters) > 2), F.upper(meant)).when(shown.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(meant, 1, 1)), meant.substr(F.lit(2), F.length(meant)))).otherwise(meant)


def _repaired_words(fields: DataFrame, fixes: DataFrame, wrong: DataFrame) -> DataFrame:
    """``(key, field, shown, span)``: words with a misread part, as they stand and as the page had them.

    ``wrong(w, number)``: the types in question, which are those of ``fixes`` and numbers with letters in them.
    """
    flat = fields.select("key", "field", "words", "parts", "places", F.transform("parts", lambda x: F.lower(x)).alias("low"))
    # Most words have no correction anywhere; where the types that have are few enough to be sent round, the others stop here.
    placed = flat.select("*", F.posexplode("low").alias("i", "w")).join(broadcast_if_small(wrong), "w")
    place = F.get("places", F.col("i"))
    p = placed.select(
        "key", "field", F.when(F.col("i") > 0, F.get("low", F.col("i") - 1)).otherwise("").alias("p"), "w", F.coalesce(F.get("low", F.col("i") + 1), F.lit("")).alias("n"),
        F.get("parts", F.col("i")).alias("part"), F.get("words", (place / PLACES).cast("int")).alias("x"), F.floor(place / PLACES).alias("at"), F.pmod(place, F.lit(PLACES)).cast("int").alias("j"), "number",
    )
    p = p.join(fixes, ["p", "w", "n"], "left").where("number or v is not null").withColumn("right", F.coalesce(_number(F.col("part")), _cased(F.col("part"), F.col("v"))))
    changed = p.where(F.col("right").isNotNull() & (F.col("right") != F.col("part")))
    # Repeated rows of one key give one entry per part.
    changed = changed.groupBy("key", "field", "at", "x", "j").agg(F.max("right").alias("right"))
    got = changed.groupBy("key", "field", "at", "x").agg(F.map_from_entries(F.collect_list(F.struct("j", "right"))).alias("m"))
    seps = F.concat(F.regexp_extract_all("x", F.lit(r"(['’-])")), F.array(F.lit("")))
    rebuilt = F.array_join(F.transform(F.split("x", r"['’-]"), lambda s, j: F.concat(F.coalesce(F.element_at("m", j), s), F.get(seps, j))), "")
    return got.select("key", "field", F.col("x").alias("shown"), rebuilt.alias("span"))


def _broken_words(fields: DataFrame) -> DataFrame:
    """``(key, field, shown, word)``: broken words put together, with their own hyphen where the corpus writes one."""
    b = fields.select("key", "field", F.explode(F.array_distinct("broken")).alias("shown"))
    shown = b.select("shown").distinct()
    pieces = F.split("shown", "\u0001")
    forms = shown.select("shown", F.size(pieces).alias("k"), pieces.alias("pieces"))
    # Each joint may or may not be a hyphen of the word itself; words of more than five pieces are only joined.
    masks = F.explode(F.expr("sequence(0, if(k <= 5, shiftleft(1, k - 1), 1) - 1)"))
    forms = forms.select("shown", "k", "pieces", masks.alias("mask"))
    joined = F.expr("aggregate(sequence(1, k - 1), pieces[0], (acc, i) -> concat(acc, if((shiftright(mask, i - 1) & 1) = 1, '-', ''), pieces[i]))")
    forms = materialize(forms.select("shown", "mask", joined.alias("word")).withColumn("w", F.lower("word")), "joined-forms")
    # How often the texts write each form; words that are no form stop before they are counted.
    written = fields.where("field = 'text'").select(F.explode("words").alias("x")).where("x <> ''").select(F.lower("x").alias("w"))
    types = written.join(broadcast_if_small(forms.select("w").distinct()), "w", "left_semi").groupBy("w").agg(F.count("*").alias("c"))
    rated = forms.join(types.select("w", "c"), "w", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    second = F.lower(F.element_at(F.split("shown", "\u0001"), -1))
    best = rated.groupBy("shown").agg(F.max_by("word", F.struct("c", -F.col("mask"))).alias("word"), F.max("c").alias("c"))
    best = best.where(~second.isin(*sorted(CONJUNCTIONS)) | (F.col("c") > 0))
    # A capital inside a word in small letters: two words with a hyphen, kept as the corpus writes it, else no case.
    inner = F.col("word").rlike(r"\p{Ll}\p{Lu}\p{Ll}")
    return b.join(best.where(~inner | (F.col("c") > 0)).select("shown", "word"), "shown")


def scan_noise(df: DataFrame, text: str = "text", title: str = "title", key: str = "chunk_id", catalogue: str = "catalogue_id") -> DataFrame:
    """``(key, field, noise, span)``, distinct: every fault of scanning in ``text`` and ``title``.

    noise is ``header`` or ``pageno`` (span: the line, trimmed), ``hyphen`` or ``misread`` (span: the word as the page
    had it). Null and empty texts give no row; a null title or catalogue leaves the other parts as they are (headers of
    a null catalogue are confirmed by their wording only). Repeated rows with one key count once. Extra columns are not
    read. Ties between candidate words go to the more frequent, then to the later in code point order.
    """
    furniture, fields, hyphens, misread = _findings(df, text, title, key, catalogue)
    found = furniture.select("key", F.lit("text").alias("field"), "noise", F.col("line").alias("span"))
    found = found.unionByName(hyphens.select("key", "field", F.lit("hyphen").alias("noise"), F.col("word").alias("span")))
    found = found.unionByName(misread.select("key", "field", F.lit("misread").alias("noise"), "span"))
    return found.distinct().withColumnRenamed("key", key)


def _findings(df: DataFrame, text: str, title: str, key: str, catalogue: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    df = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(title).alias("title"), F.col(catalogue).alias("catalogue"))
    furniture = materialize(furniture_lines(df, "text", "key", "catalogue"), "furniture")
    fields = materialize(_fields(df, furniture, "text", "title", "key"), "fields")
    fixes, wrong_types = corrections(_neighbours(fields))
    hyphens = _broken_words(fields)
    misread = _repaired_words(fields, fixes, wrong_types)
    # A broken word may be misread too: its parts are looked up without neighbours.
    alone = fixes.where("p = '' and n = ''").select("w", "v")
    parts = hyphens.select("key", "field", "shown", "word", F.posexplode(F.split("word", r"['’-]")).alias("j", "part")).withColumn("w", F.lower("part"))
    lost = parts.join(alone, "w", "left")
    lost = lost.withColumn("right", F.coalesce(_number(F.col("part")), _cased(F.col("part"), F.col("v"))))
    wrong = lost.where("right is not null and right <> part").groupBy("key", "field", "shown", "word", "j").agg(F.max("right").alias("right"))
    wrong = wrong.groupBy("key", "field", "shown", "word").agg(F.map_from_entries(F.collect_list(F.struct("j", "right"))).alias("m"))
    seps = F.concat(F.regexp_extract_all("word", F.lit(r"(['’-])")), F.array(F.lit("")))
    rebuilt = F.array_join(F.transform(F.split("word", r"['’-]"), lambda s, j: F.concat(F.coalesce(F.element_at("m", j), s), F.get(seps, j))), "")
    wrong = materialize(wrong.select("key", "field", "shown", rebuilt.alias("span")).distinct(), "broken-misread")
    hyphens = hyphens.join(wrong, ["key", "field", "shown"], "left").select("key", "field", "shown", F.coalesce("span", "word").alias("word"))
    misread = misread.select("key", "field", "shown", "span").unionByName(wrong)
    return furniture, fields, materialize(hyphens, "hyphens"), materialize(misread, "misread")


def reflow(text: str, furniture: set[int], right: dict[str, str]) -> str:
    """``text`` as continuous paragraphs: furniture out, broken words joined, misread words right, line ends undone.

    ``right`` maps a word as it stands (the pieces of a broken one joined by ``\\u0001``) to the word of the page. Marked
    lines (``#``, ``-``, ``*``, ``|``) and lines in brackets stay lines of their own.
    """
    out: list[str] = []
    for i, line in enumerate(text.split("\n")):
        if i in furniture:
            continue
        if not line.strip():
            out.append("\n\n")
        elif i and re.match(r"\s*[#*|(<\[{\\$`~+-]", line) and not re.match(r"\s*-\S", line):
            out.append("\n" + line.strip() + "\n")
        else:
            out.append(line + "\n")
    body = "".join(out)
    # A paragraph cut by furniture goes on in lower case.
    body = re.sub(r"(?<=[^\n.!?:;])\n{2,}(?=[a-zß-öø-ÿ])", "\n", body)
    parts: list[str] = []
    at = copied = 0
    pieces: list[str] = []
    begun = 0
    while m := _WORD.search(body, at):
        if not pieces:
            begun = m.start()
        joint = _JOINT.match(body, m.end())
        if joint and not joint.group()[-1:].strip() and not m.group().isdigit():
            pieces.append(m.group())
            at = joint.end()
            continue
        shown = "\u0001".join((*pieces, m.group()))
        pieces = []
        at = m.end()
        if shown in right:
            parts += [body[copied:begun], right[shown]]
            copied = at
    body = "".join((*parts, body[copied:]))
    body = re.sub(r"\n[^\S\n]*\n\s*", "\u0002", body)
    body = re.sub(r"\n(?=[#*|(<\[{\\$`~+]|- )|(?<=\n)\n", "\u0003", body)
    body = re.sub(r"(\u0003[^\n]*)\n", "\\1\u0003", body)
    body = re.sub(r"[^\S\n]*\n[^\S\n]*", " ", body)
    return re.sub(r"\u0003+", "\n", body.replace("\u0002", "\n\n")).strip()


def repair_scans(df: DataFrame, text: str = "text", title: str = "title", key: str = "chunk_id", catalogue: str = "catalogue_id") -> DataFrame:
    """``(key, repaired_text)`` for every row of ``df``: see ``reflow``. Null stays null."""
    furniture, _, hyphens, misread = _findings(df, text, title, key, catalogue)
    words = hyphens.select("key", "shown", F.col("word").alias("right"), F.col("field")).unionByName(misread.select("key", "shown", F.col("span").alias("right"), "field"))
    right = words.where("field = 'text'").groupBy("key", "shown").agg(F.max("right").alias("right"))
    right = right.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("shown", "right"))).alias("pairs"))
    right = right.select("key", F.col("pairs.shown").alias("shown"), F.col("pairs.right").alias("right"))
    taken = furniture.groupBy("key").agg(F.collect_set("line_no").alias("taken"))
    source = spread(df.select(F.col(key).alias("key"), F.col(text).alias("body"))).join(taken, "key", "left").join(right, "key", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for body, lines, shown, meant in zip(batch["body"], batch["taken"], batch["shown"], batch["right"], strict=True):
                texts.append(body and reflow(body, set(lines) if lines is not None else set(), dict(zip(shown, meant, strict=True)) if shown is not None else {}))
            yield pd.DataFrame({"key": batch["key"], "repaired_text": texts})

    kind = df.schema[key].dataType.simpleString()
    return source.mapInPandas(run, f"key {kind}, repaired_text string").withColumnRenamed("key", key)

"""Lots in catalogue text: detect their boundaries, split hidden ones, merge misread ones, report what is left.

Text is cut without user code: a mark is put in front of every match by one regular-expression replacement, and the text
is split at the marks. Windows run over narrow rows in bounded buckets (``ordered``); texts are only moved to be joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerlot.functions import text as T
from hammerlot.operators import ordered

MATCH, FIELD = "\x01", "\x02"
# The line patterns that results depend on, and the one for lots inside lots.
DASHES = r"[.\-—–]*"
#: A lot number, where a scan may show 1 as I, the signs behind it, and the rest of the line.
NUMBER_AND_TITLE = rf"(I{{1,3}}\p{{Nd}}*|[1-9]\p{{Nd}}*){DASHES}{T.SPACE}*(.+)"
#: The competing line patterns, in the order that breaks ties.
PATTERNS = {
    "generic": rf"^(?:\|?{T.SPACE}*)?(?:#{{1,6}}{T.SPACE}*)?{NUMBER_AND_TITLE}",
    "header": rf"^(?:\|?{T.SPACE}*)?#{{1,6}}{T.SPACE}*{NUMBER_AND_TITLE}",
    "bullet": rf"^(?:\|?{T.SPACE}*)?(?:[-*]{T.SPACE}*)?{NUMBER_AND_TITLE}",
    "pipe_prefix": rf"^\|{T.SPACE}*{NUMBER_AND_TITLE}",
}
#: A lot number inside the text of another lot: one to three digits, a separator, then a capital or accented letter.
INNER_LOT = rf"(?:\A|\n|\| |## |### |# |{T.SPACE}|•)(\p{{Nd}}{{1,3}})(?:{T.SPACE}*[.\-–—]{T.SPACE}*)(?=[A-ZÀ-ÖØ-öø-ÿ])"


def _column(expression: str) -> Column:
    return F.expr(expression)


def _clean(text: Column) -> Column:
    """Text without the two mark characters."""
    return F.translate(text, MATCH + FIELD, "")


def pattern_counts(text: Column) -> dict[str, Column]:
    """Number of matches of each pattern in a text."""
    return {name: F.regexp_count(text, F.lit(f"(?md){pattern}")) for name, pattern in PATTERNS.items()}


def best_pattern(text: Column) -> Column:
    """Name of the pattern with most matches; ties go to the first."""
    counts = pattern_counts(text)
    most = F.greatest(*counts.values())
    best = F.lit(list(PATTERNS)[-1])
    for name in reversed(list(PATTERNS)[:-1]):
        best = F.when(counts[name] == most, F.lit(name)).otherwise(best)
    return best


def _pieces(text: Column, pattern: str) -> Column:
    marked = F.regexp_replace(text, f"(?md){pattern}", f"{MATCH}$1{FIELD}$2{FIELD}$0")
    return _after_first(F.split(marked, MATCH))


def _after_first(pieces: Column) -> Column:
    """All pieces but the one in front of the first mark."""
    return F.filter(pieces, lambda _, i: i > 0)


def chunk(df: DataFrame, text: str = "text", key: str = "catalogue_id", pattern: str | None = None) -> DataFrame:
    """``(key, pattern, idx, num, title, text)``: the lots of each text, numbered from 1 in reading order.

    ``pattern`` names one of ``PATTERNS``; None takes the one with most matches in each text. A lot reaches to the next;
    text before the first is dropped; a text without a match, a null or an empty one gives no row. Repeated rows are cut
    each on their own. Only the pattern that wins is replaced, so the others cost one count each.
    """
    source = df.select(F.col(key).alias("key"), _clean(F.col(text)).alias("body")).where(F.col("body").isNotNull())
    source = source.withColumn("pattern", F.lit(pattern) if pattern else best_pattern(F.col("body")))
    cut = F.lit(None).cast("array<string>")
    for name in reversed(PATTERNS):
        if pattern in (None, name):
            cut = F.when(F.col("pattern") == name, _pieces(F.col("body"), PATTERNS[name])).otherwise(cut)
    pieces = source.select("key", "pattern", F.posexplode(cut).alias("at", "piece"))
    fields = F.split("piece", FIELD, 3)
    parts = pieces.select("key", "pattern", (F.col("at") + 1).alias("idx"), fields[0].alias("n"), fields[1].alias("t"), fields[2].alias("x"))
    return parts.select(F.col("key").alias(key), "pattern", "idx", _column(T.strip("n")).alias("num"), _column(T.strip("t")).alias("title"), _column(T.strip("x")).alias("text"))


def split_gaps(df: DataFrame, key: str = "catalogue_id", order: tuple[str, ...] = ("idx",)) -> DataFrame:
    """``(key, idx, num, title, text)``: rows whose text hides exactly the numbers missing before the next row, split.

    A row is replaced by its segments from its own number up to the next row's, as they stand in the text; text before
    the first inner number and segments out of range are dropped. Everything else passes through. Rows without a number,
    before a row without one, or before a gap that is no gap, pass. Rows are renumbered from 1 in each key. Null texts
    hide nothing. ``order`` must be total, its first column numeric.
    """
    rows = df.select(F.col(key).alias("key"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], "num", "title", "text")
    by = [f"o{i}" for i in range(len(order))]
    narrow = rows.select("key", *by, _column(T.digits_int("num")).alias("cur"))
    narrow = ordered.neighbours(narrow, "key", by, F.col("cur"), following="nxt").withColumn("nxt", F.nullif("nxt", F.lit(0)))
    rows = ordered.rejoin(rows, narrow, ["key", *by])
    marked = F.regexp_replace(_clean(F.col("text")), INNER_LOT, f"{MATCH}$1{FIELD}$0")
    segment = F.transform(
        _after_first(F.split(marked, MATCH)),
        lambda s: F.struct(F.substring_index(s, FIELD, 1).cast("bigint").alias("n"), F.substring_index(s, FIELD, -1).alias("x")),
    )
    gap = F.col("nxt") - F.col("cur") - 1
    # Only a row before a gap is searched at all.
    rows = rows.withColumn("segments", F.when(gap > 0, segment))
    inner = F.array_distinct(F.transform(F.filter("segments", lambda s: (s["n"] > F.col("cur")) & (s["n"] < F.col("nxt"))), lambda s: s["n"]))
    kept = F.filter("segments", lambda s: (s["n"] >= F.col("cur")) & (s["n"] < F.col("nxt")))
    whole = F.array(F.struct(F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("string").alias("x")))
    rows = rows.withColumn("out", F.when(F.coalesce((gap > 0) & (F.size(inner) == gap), F.lit(False)), kept).otherwise(whole))
    flat = rows.select("key", *by, "num", "title", "text", F.posexplode("out").alias("seg", "s"))
    body = _column(T.strip("s.x"))
    split = F.col("s.n").isNotNull()
    flat = flat.select(
        "key", *by, "seg",
        F.when(split, F.col("s.n").cast("string")).otherwise(F.col("num")).alias("num"),
        F.when(split, F.substring(F.substring_index(body, "\n", 1), 1, 120)).otherwise(F.col("title")).alias("title"),
        F.when(split, body).otherwise(F.col("text")).alias("text"),
    )
    places = ordered.running_sum(flat.select("key", *by, "seg"), "key", [*by, "seg"], F.lit(1), "idx")
    placed = ordered.rejoin(flat, places, ["key", *by, "seg"])
    return placed.select(F.col("key").alias(key), "idx", "num", "title", "text")


def merge_sandwiched(df: DataFrame, key: str = "catalogue_id", order: tuple[str, ...] = ("idx",)) -> DataFrame:
    """``(key, idx, num, title, text)``: rows with a wrong number between two consecutive ones, merged into the row before.

    A row is wrong if the numbers before and after it follow each other and its own is not the first of them plus one.
    Neighbours are those of the input, so runs of wrong rows all end in the same survivor, which keeps its number. Titles
    and texts are joined by a blank in reading order, merged texts stripped; a null title or text adds an empty one.
    Rows are renumbered from 1 in each key. Numbers are read strictly: ``I3`` is none.
    """
    by = [f"o{i}" for i in range(len(order))]
    rows = df.select(F.col(key).alias("key"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], "num", "title", "text")
    narrow = rows.select("key", *by, _column(T.strict_int("num")).alias("cur"))
    narrow = ordered.neighbours(narrow, "key", by, F.col("cur"), "before", "after")
    wrong = (F.nullif("before", F.lit(0)) + 1 == F.nullif("after", F.lit(0))) & (F.col("cur").isNull() | (F.col("cur") != F.col("before") + 1))
    narrow = narrow.withColumn("wrong", F.coalesce(wrong, F.lit(False)))
    # The survivors are numbered as they come, so the island of a row is its new place.
    narrow = ordered.running_sum(narrow, "key", by, F.when(F.col("wrong"), 0).otherwise(1), "idx")
    placed = ordered.rejoin(rows, narrow.select("key", *by, "wrong", "idx"), ["key", *by])
    text = F.when(F.col("wrong"), F.coalesce(_column(T.strip("text")), F.lit(""))).otherwise(F.col("text"))
    alone = F.struct(*by, "num", "title", text.alias("text"))
    merged = placed.groupBy("key", "idx").agg(F.array_sort(F.collect_list(alone)).alias("rows"))
    first = F.get("rows", F.lit(0))

    def joined(field: str) -> Column:
        return F.when(F.size("rows") == 1, first[field]).otherwise(F.array_join(F.transform("rows", lambda r: F.coalesce(r[field], F.lit(""))), " "))

    return merged.select(F.col("key").alias(key), "idx", first["num"].alias("num"), joined("title").alias("title"), joined("text").alias("text"))


def inconsistencies(df: DataFrame, key: str = "catalogue_id", order: tuple[str, ...] = ("idx",)) -> DataFrame:
    """``(key, prev_num, current_num, title, excerpt)``: rows whose number does not follow the last number before them.

    Rows without a number, or with 0, neither report nor count as last. Numbers are all digits of ``num``: ``I3`` is 3.
    An empty frame gives an empty one with these columns.
    """
    by = [f"o{i}" for i in range(len(order))]
    rows = df.select(F.col(key).alias("key"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], "num", "title", "text")
    narrow = rows.select("key", *by, F.nullif(_column(T.digits_int("num")), F.lit(0)).alias("cur"))
    narrow = ordered.last_before(narrow, "key", by, F.col("cur"), "last").where("cur is not null and last is not null and cur <> last + 1")
    found = ordered.rejoin(rows, narrow, ["key", *by])
    return found.select(F.col("key").alias(key), F.col("last").alias("prev_num"), F.col("cur").alias("current_num"), "title", _column(T.strip("text")).alias("excerpt"))


def chunk_pipeline(df: DataFrame, text: str = "text", key: str = "catalogue_id") -> tuple[DataFrame, DataFrame]:
    """Lots of whole catalogue texts after both repairs, and the inconsistencies left in them."""
    lots = merge_sandwiched(split_gaps(chunk(df, text, key), key), key)
    return lots, inconsistencies(lots, key)


def separated(df: DataFrame, text: str = "text", key: str = "page", separator: str = "---------") -> DataFrame:
    """``(key, idx, text)``: parts of a transcription between separators, stripped, empty ones left out."""
    parts = df.select(F.col(key), F.filter(F.split(F.col(text), separator), lambda x: x.rlike(r"[^\s\p{Z}]")).alias("p"))
    flat = parts.select(key, F.posexplode("p").alias("at", "part"))
    return flat.select(key, (F.col("at") + 1).alias("idx"), _column(T.strip("part")).alias("text"))

"""Passages of held-out test items inside a corpus, found through a distributed positional inverted index.

The index is stored once for the whole corpus and serves any set of test items. It is cut by document, so a frequent
term is spread over all shards and no list of postings is one task: ``terms`` holds each document's terms in order,
bucketed by document, ``postings (term, doc, pos)`` the inverted lists. Test items are few and are sent to the shards,
after a check of their size; only postings of the rarest terms leave their shard.

For every window of the wanted length in a test passage the two rarest of its terms are looked up; their lists, moved by
the place of the term in the passage, are intersected to ``(doc, part, shift)``. Only these are compared with the
document's terms, and runs of consecutive matches are read off as exact phrases.

Proximity matches have candidates of their own. A passage of which ``m`` words must match hits any ``size - m + k`` of
its places at least ``k`` times (prefix filter); its rarest places are taken, and hits may lie off their shift.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hammerlot.plans.broadcasting import broadcast_if_small
from hammerlot.plans.materialize import bucketed, materialize

#: Letters that fold to more than one letter.
LIGATURES = {"ß": "ss", "æ": "ae", "œ": "oe", "ĳ": "ij", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "þ": "th"}

#: Hits that the rarest places of a passage must have near one shift before the whole passage is compared.
PREFIX_HITS = 12


def _folding() -> tuple[str, str]:
    """Each lower-case letter with a diacritic and its base letter, by Unicode decomposition and for crossed letters."""
    shown, base = [], []
    for code in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)):
        char = chr(code)
        bare = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if len(bare) == 1 and bare != char and bare.islower():
            shown.append(char)
            base.append(bare)
    return "".join(shown) + "øłđħŧı", "".join(base) + "oldhti"


_SHOWN, _BASE = _folding()
#: Combining marks: what stands in the first list of a translation and has no counterpart in the second is left out.
_MARKS = "".join(chr(c) for c in range(0x300, 0x1F000) if unicodedata.category(chr(c)).startswith("M"))


def terms_of(text: Column) -> Column:
    """Words of a text as an array: runs of letters and digits, without case and diacritics."""
    folded = F.translate(F.lower(text), _SHOWN + _MARKS, _BASE)
    for shown, meant in LIGATURES.items():
        folded = F.replace(folded, F.lit(shown), F.lit(meant))
    return F.regexp_extract_all(folded, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


@dataclass(frozen=True)
class PositionalIndex:
    """``terms(doc, words)``, bucketed by document, and ``postings(term, doc, pos)``."""

    terms: DataFrame
    postings: DataFrame


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> PositionalIndex:
    """Index all terms of all documents; null texts and null keys have none. The texts are shuffled once."""
    texts = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).alias("text"))
    terms = bucketed(texts, "leak-terms", "doc", lambda df: df.select("doc", terms_of(F.col("text")).alias("words")), buckets)
    postings = terms.select("doc", F.posexplode("words").alias("pos", "term")).select("term", "doc", "pos")
    return PositionalIndex(terms, materialize(postings, "leak-postings"))


def _exact(passages: DataFrame, rated: DataFrame, index: PositionalIndex, least: int) -> DataFrame:
    """``(doc, item, kind, n_words, doc_from, item_from)``: maximal runs of at least ``least`` words of a passage."""
    # Two rarest terms of each window of `least` words. Both must meet, and a window with a term the corpus lacks cannot match.
    by_place = W.partitionBy("part").orderBy("ipos").rowsBetween(0, least - 1)
    window = rated.withColumn("w", F.array_sort(F.collect_list(F.struct("n", "ipos", "term")).over(by_place))).where(F.size("w") == least)
    pairs = window.select("part", F.slice("w", 1, min(2, least)).alias("pair")).where("pair[0].n > 0")
    # A place is a bit; two places of one bit only let more through to the comparison.
    anchors = materialize(pairs.select("part", F.explode("pair").alias("x")).select("part", "x.ipos", "x.term").distinct().withColumn("bit", F.expr("shiftleft(1L, ipos % 63)")), "leak-anchors")
    both = pairs.select("part", F.expr("aggregate(pair, 0L, (m, x) -> m | shiftleft(1L, x.ipos % 63))").alias("m")).groupBy("part").agg(F.collect_set("m").alias("masks"))
    asked = materialize(passages.join(both, "part"), "leak-asked")
    met = index.postings.join(broadcast_if_small(anchors), "term").groupBy("doc", "part", (F.col("pos") - F.col("ipos")).alias("shift")).agg(F.bit_or("bit").alias("bits"))
    # Tested on narrow rows; two places of one bit pass the count only through the masks, so it is not asked first.
    shifts = met.join(broadcast_if_small(asked.select("part", "masks")), "part").where(F.expr("exists(masks, m -> bits & m = m)")).select("doc", "part", "shift")
    compared = index.terms.join(shifts, "doc").join(broadcast_if_small(asked.drop("masks")), "part")
    hit = F.transform("passage", lambda t, i: F.when(F.get("words", i + F.col("shift")).eqNullSafe(t), "1").otherwise("0"))
    masked = compared.select("doc", "item", "shift", F.array_join(hit, "").alias("mask")).where(F.col("mask").contains("1" * least))
    runs = masked.select("doc", "item", "shift", F.posexplode(F.split("mask", "0")).alias("at", "run"), F.split("mask", "0").alias("all")).where(F.length("run") >= least)
    begin = F.aggregate(F.slice("all", F.lit(1), F.col("at")), F.lit(0), lambda n, x: n + F.length(x) + 1)
    found = runs.select("doc", "item", F.lit("exact").alias("kind"), F.length("run").alias("n_words"), (begin + F.col("shift")).cast("int").alias("doc_from"), begin.cast("int").alias("item_from"))
    return materialize(found, "leak-exact")


def near_match(words: list[str], passage: list[str], slop: int) -> tuple[int, int, int]:
    """``(n_words, shift, item_from)``: the shift with most words of ``passage`` within ``slop`` places, then the lowest."""
    at: dict[str, list[int]] = defaultdict(list)
    wanted = set(passage)
    for pos, word in enumerate(words):
        if word in wanted:
            at[word].append(pos)
    votes: Counter[int] = Counter()
    first: dict[int, int] = {}
    for ipos, word in enumerate(passage):
        for shift in {pos - ipos + d for pos in at.get(word, ()) for d in range(-slop, slop + 1)}:
            votes[shift] += 1
            first.setdefault(shift, ipos)
    if not votes:
        return 0, 0, 0
    shift = min(votes, key=lambda s: (-votes[s], s))
    return votes[shift], shift, first[shift]


def _near(passages: DataFrame, rated: DataFrame, index: PositionalIndex, least: int, slop: int, near_share: float, exact: DataFrame) -> DataFrame:
    """Pairs with enough words at some shift, complete but for those of ``exact``: the best shift of each."""
    size = F.size("passage")
    sized = passages.withColumn("needed", F.greatest(F.lit(least), F.ceil(near_share * size)).cast("int")).where(F.col("needed") <= size)
    wanted = min(PREFIX_HITS, max(1, least))
    rare = rated.join(sized.select("part", size.alias("size"), "needed"), "part").withColumn("rank", F.row_number().over(W.partitionBy("part").orderBy("n", "ipos")))
    rare = rare.where(F.col("rank") <= F.col("size") - F.col("needed") + wanted).where("n > 0").select("part", "ipos", "term")
    rare = materialize(rare, "leak-rare-places")
    # Hits of one match lie in a band of 2 * slop + 1 shifts, so in two neighbouring bins of that width.
    hits = index.postings.join(broadcast_if_small(rare), "term").select("doc", "part", F.floor((F.col("pos") - F.col("ipos")) / (2 * slop + 1)).alias("bin"))
    binned = hits.groupBy("doc", "part", "bin").agg(F.count("*").alias("n")).select("doc", "part", "n", F.explode(F.array(F.col("bin"), F.col("bin") - 1)).alias("bin"))
    pairs = binned.groupBy("doc", "part", "bin").agg(F.sum("n").alias("n")).where(F.col("n") >= wanted).select("doc", "part").distinct()
    asked = index.terms.join(pairs, "doc").join(broadcast_if_small(sized), "part")
    asked = asked.join(exact.select("doc", "item").distinct(), ["doc", "item"], "left_anti").select("doc", "item", "words", "passage", "needed")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, item, words, passage, needed in batch.itertuples(index=False):
                n, shift, item_from = near_match(list(words), list(passage), slop)
                if n >= needed:
                    rows.append((doc, item, n, shift, item_from))
            if rows:
                yield pd.DataFrame(rows, columns=["doc", "item", "n_words", "shift", "item_from"])

    kinds = {c: asked.schema[c].dataType.simpleString() for c in ("doc", "item")}
    close = asked.mapInPandas(compare, f"doc {kinds['doc']}, item {kinds['item']}, n_words int, shift int, item_from int")
    best = close.groupBy("doc", "item").agg(F.max_by(F.struct("n_words", "shift", "item_from"), F.struct("n_words", -F.col("shift"))).alias("x"))
    return best.select("doc", "item", F.lit("near").alias("kind"), "x.n_words", (F.col("x.item_from") + F.col("x.shift")).alias("doc_from"), "x.item_from")


def leaks_in(
    index: PositionalIndex, items: DataFrame, least: int = 12, slop: int = 3, near_share: float = 0.75, near: bool = True, doc_key: str = "doc_id", item_key: str = "item_id", item_text: str = "passage"
) -> DataFrame:
    """``leaks`` against an index that is there already."""
    part = F.monotonically_increasing_id()
    passages = items.where(F.col(item_text).isNotNull()).select(F.col(item_key).alias("item"), part.alias("part"), terms_of(F.col(item_text)).alias("passage"))
    passages = materialize(passages.where(F.size("passage") >= least), "leak-items")
    places = passages.select("part", F.posexplode("passage").alias("ipos", "term"))
    frequency = index.postings.join(broadcast_if_small(places.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    rated = materialize(places.join(frequency, "term", "left").na.fill(0, ["n"]), "leak-places")
    found = _exact(passages, rated, index, least)
    if near:
        found = found.unionByName(_near(passages, rated, index, least, slop, near_share, found))
    return found.withColumnsRenamed({"doc": doc_key, "item": item_key})


def leaks(
    docs: DataFrame, items: DataFrame, least: int = 12, slop: int = 3, near_share: float = 0.75, near: bool = True, doc_key: str = "doc_id", doc_text: str = "text", item_key: str = "item_id", item_text: str = "passage"
) -> DataFrame:
    """``(doc, item, kind, n_words, doc_from, item_from)``: matches of item passages in documents.

    kind ``exact``: a maximal run of at least ``least`` consecutive words of the passage; n_words is its length.
    kind ``near``: no such run, but a share ``near_share`` of the words of the passage (``least`` words at least) within
    ``slop`` places of one shift. ``near`` False leaves these out and costs less.
    Passages shorter than ``least`` words cannot match. Null texts, passages and document keys match nothing; repeated
    documents each match on their own; repeated items with one key are one item with all their passages' rows.
    """
    return leaks_in(build_index(docs, doc_key, doc_text), items, least, slop, near_share, near, doc_key, item_key, item_text)

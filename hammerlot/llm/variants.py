"""Link variant spellings of names: sparse cosine join of character n-gram vectors, then average-linkage clustering.

Each distinct name is a vector of the character n-grams of its surnames, weighted by rarity. The join is a sparse product
of the vectors of a block in cells of bounded size: a name meets the others through the lists of names that have its
n-grams, and only pairs that reach the threshold leave a cell. So what is sent and stored grows with the names, not with
their pairs. Similar names are merged by average linkage in rounds of mutual nearest neighbours, which gives the same
clusters as merging one closest pair at a time. No cluster is gathered in one task while the edges of all are more than
one task may hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hammerlot.llm.canonical import reference_spellings
from hammerlot.llm.name_parts import closest, common_words, nicknames, parse_names, with_formal_names
from hammerlot.plans.broadcasting import broadcast_if_small
from hammerlot.plans.materialize import bucketed, materialize
from hammerlot.plans.parallelism import scatter
from hammerlot.plans.skew import salted

GRAMS = (2, 3)
#: Grams rarer than this share of the names weigh no more: most of them are slips.
RARE_SHARE = 0.002
RARE_LEAST = 6
#: Pairs below this cosine count as 0 in the averages.
CANDIDATE = 0.5
#: Clusters merge while their average similarity reaches this.
LINK = 0.57
#: Names of a block that one cell compares with each other, or with as many others: bounds a worker's memory and time.
CELL_ROWS = 8_192
#: Pairs after which a cell hands on what it found.
CELL_PAIRS = 1 << 18
#: Edges up to which one task does the rest of the linkage: bounds its memory.
TASK_EDGES = 1 << 19


def ngrams(text: Column, n: int) -> Column:
    """Character n-grams of a string with a blank at both ends, the letters of each in alphabetical order.

    So a pair of letters typed the wrong way round changes few of them. A string shorter than n is one gram.
    """
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    count = F.greatest(F.length(padded) - n + 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(F.lit(str(n)), F.array_join(F.array_sort(F.split(F.substring(padded, i, F.lit(n)), "")), "")))


def _cell(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compares one cell: its pairs, as ``(a, b, cosine)`` with a < b, whose cosine reaches ``threshold``."""

    def batch(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        return pa.record_batch([np.concatenate(x) for x in zip(*found, strict=True)], ["a", "b", "cosine"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = pa.Table.from_batches(batches)
        ids, part = cell["id"].to_numpy(), cell["part"].to_numpy()
        one, other = cell["i"][0].as_py(), cell["j"][0].as_py()
        lists, n = cell["g"].combine_chunks(), len(ids)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        known, gram = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        w = cell["w"].combine_chunks().flatten().to_numpy()
        # The names that have a gram, gram by gram.
        row = np.repeat(np.arange(n), sizes)
        right = np.flatnonzero(part[row] == other)
        right = right[np.argsort(gram[right], kind="stable")]
        having, weight = row[right], w[right]
        starts = np.searchsorted(gram[right], np.arange(len(known) + 1))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for k in np.flatnonzero(part == one):
            own = gram[ends[k] : ends[k + 1]]
            counts = starts[own + 1] - starts[own]
            at = np.arange(counts.sum()) + np.repeat(starts[own] - np.cumsum(counts) + counts, counts)
            cosine = np.bincount(having[at], weights=weight[at] * np.repeat(w[ends[k] : ends[k + 1]], counts), minlength=n)
            near = np.flatnonzero(cosine >= threshold)
            near = near[near > k] if one == other else near
            if len(near):
                found.append((np.minimum(ids[k], ids[near]), np.maximum(ids[k], ids[near]), cosine[near]))
                held += len(near)
            if held >= CELL_PAIRS:
                yield batch(found)
                found, held = [], 0
        if found:
            yield batch(found)

    return compare


def cosine_pairs(nodes: DataFrame, blocks: DataFrame, threshold: float = CANDIDATE, top_n: int | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(a, b, cosine)``, a < b: pairs of ``nodes(id, grams)`` that share a block and whose cosine reaches ``threshold``.

    ``blocks(id, block)``: one or more blocks of each node. Complete by default. ``top_n`` keeps each node's best n
    partners (ties by id): a pair stays if either end has it among its best, so with n at least the largest number of
    partners the result is the complete one. A block of more than ``cell_rows`` nodes is cut into parts, and each two
    parts are a cell; a node's vector is sent once per part of its block. ``nodes`` bucketed by id are not sent otherwise.
    """
    n = nodes.count()
    df = nodes.select(F.explode(F.array_distinct("grams")).alias("g")).groupBy("g").agg(F.count("*").alias("df"))
    rarity = F.sqrt(F.log1p(F.lit(float(n)) / F.greatest("df", F.lit(max(RARE_SHARE * n, RARE_LEAST)))))
    rated = broadcast_if_small(materialize(df.select("g", F.xxhash64("g").alias("hash"), rarity.alias("rarity")), "gram-weights"))
    flat = nodes.select("id", F.explode("grams").alias("g")).groupBy("id", "g").agg(F.count("*").alias("tf"))
    weighted = flat.join(rated, "g").select("id", F.col("hash").alias("g"), (F.col("tf") * F.col("rarity")).alias("w"))
    # Grams in one order everywhere: a pair that shares two blocks has the same sum in both.
    vector = F.array_sort(F.collect_list(F.struct("g", "w")))
    vectors = weighted.groupBy("id").agg(vector.alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    vectors = vectors.select("id", F.col("v.g").alias("g"), F.transform("v.w", lambda w: w / F.col("norm")).alias("w"))
    blocks = materialize(blocks, "name-blocks")
    parts = blocks.groupBy("block").agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("parts"))
    placed = vectors.join(blocks.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "id")
    cells = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("block", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"), "part", "id", "g", "w")
    scored = cells.groupBy("block", "i", "j").applyInArrow(_cell(threshold), "a bigint, b bigint, cosine double").dropDuplicates(["a", "b"])
    if top_n is None:
        return scored
    ends = scored.select(F.col("a").alias("i"), "a", "b", "cosine").unionByName(scored.select(F.col("b").alias("i"), "a", "b", "cosine"))
    best = ends.withColumn("k", F.row_number().over(W.partitionBy("i").orderBy(F.desc("cosine"), "a", "b"))).where(F.col("k") <= top_n)
    return best.select("a", "b", "cosine").distinct()


def _rounds(link: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rounds of ``average_linkage`` over all its edges in one task: ``(c, to)`` of each cluster that ends in another."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := list(batches)):
            return
        edges = pa.Table.from_batches(held)
        s = edges["s"].to_numpy()
        ids, both = np.unique(np.concatenate([edges["a"].to_numpy(), edges["b"].to_numpy()]), return_inverse=True)
        a, b = np.split(both, 2)
        n, last = np.ones(len(ids), np.int64), np.arange(len(ids))
        n[a], n[b] = edges["na"].to_numpy(), edges["nb"].to_numpy()
        while True:
            avg = s / (n[a] * n[b])
            close = np.flatnonzero(avg >= link)
            edge, end = np.concatenate([close, close]), np.concatenate([a[close], b[close]])
            order = np.lexsort((b[edge], a[edge], -np.round(avg[edge], 9), end))
            best = edge[order[np.flatnonzero(np.diff(end[order], prepend=-1))]]
            merged = np.flatnonzero(np.bincount(best, minlength=len(a)) == 2)
            if not len(merged):
                break
            to = np.arange(len(ids))
            to[b[merged]] = a[merged]
            n[a[merged]] += n[b[merged]]
            last, a, b = to[last], to[a], to[b]
            apart = a != b
            a, b, s = np.minimum(a, b)[apart], np.maximum(a, b)[apart], s[apart]
            pairs, pair = np.unique(a * len(ids) + b, return_inverse=True)
            a, b, s = pairs // len(ids), pairs % len(ids), np.bincount(pair, weights=s, minlength=len(pairs))
        gone = np.flatnonzero(last != np.arange(len(ids)))
        yield pa.record_batch([ids[gone], ids[last[gone]]], ["c", "to"])

    return merge


def average_linkage(nodes: DataFrame, edges: DataFrame, link: float = LINK, task_edges: int = TASK_EDGES) -> DataFrame:
    """``(id, cluster)`` for every node of ``nodes(id)``; ``edges(a, b, s)`` holds the similarities, absent pairs are 0
    and negative ones keep clusters apart.

    Each round merges all clusters that are each other's nearest, ties going to the edge with the smaller ids, so a
    round always merges at least the closest pair of all. An edge carries the sizes of its clusters, so a round reads
    and writes the edges once and the merged pairs once. When at most ``task_edges`` edges are left, one task does all
    further rounds: each round of Spark costs the driver three more plans. Where a cluster went is followed to its end in
    steps that double, so no plan grows with the rounds.
    """
    sums = materialize(edges.select("a", "b", F.col("s").cast("double").alias("s"), F.lit(1).cast("bigint").alias("na"), F.lit(1).cast("bigint").alias("nb")), "linkage-0")
    gone: list[DataFrame] = []
    while sums.count() > task_edges:
        close = sums.withColumn("avg", F.col("s") / (F.col("na") * F.col("nb"))).where(F.col("avg") >= link)
        ends = close.select(F.explode(F.array("a", "b")).alias("x"), "a", "b", "avg", (F.col("na") + F.col("nb")).alias("n"))
        best = ends.groupBy("x").agg(F.max_by(F.struct("a", "b", "n"), F.struct(F.round("avg", 9), -F.col("a"), -F.col("b"))).alias("e"))
        merged = best.groupBy("e").count().where("count = 2").select(F.explode(F.array("e.a", "e.b")).alias("c"), F.col("e.a").alias("to"), F.col("e.n").alias("n"))
        merged = materialize(merged, f"linkage-merged-{len(gone)}")
        if merged.isEmpty():
            break
        gone.append(merged.where("c <> to").select("c", "to"))

        def moved(frame: DataFrame, end: str) -> DataFrame:
            new = merged.select(F.col("c").alias(end), "to", "n")
            return frame.join(new, end, "left").withColumn(end, F.coalesce("to", end)).withColumn(f"n{end}", F.coalesce("n", f"n{end}")).drop("to", "n")

        both = moved(moved(sums, "a"), "b").where("a <> b")
        turned = F.col("a") > F.col("b")
        both = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s", F.when(turned, F.col("nb")).otherwise(F.col("na")).alias("na"), F.when(turned, F.col("na")).otherwise(F.col("nb")).alias("nb"))
        sums = materialize(both.groupBy("a", "b").agg(F.sum("s").alias("s"), F.max("na").alias("na"), F.max("nb").alias("nb")), f"linkage-{len(gone)}")
    else:
        gone.append(materialize(sums.repartition(1).mapInArrow(_rounds(link), "c bigint, to bigint"), "linkage-rest"))
    if not gone:
        return nodes.select("id", F.col("id").alias("cluster"))
    went = reduce(DataFrame.unionByName, gone)
    for k in range((len(gone) - 1).bit_length()):
        went = materialize(went, f"linkage-went-{k}")
        further = went.select(F.col("c").alias("to"), F.col("to").alias("last"))
        went = went.join(further, "to", "left").select("c", F.coalesce("last", "to").alias("to"))
    return nodes.select("id").join(went.withColumnRenamed("c", "id"), "id", "left").select("id", F.coalesce("to", "id").alias("cluster"))


def _agree(x: Column, y: Column) -> Column:
    """First given names that one person may have: equal, one the start of the other, or a slip apart."""
    slip = (F.length(x) >= 5) & (F.length(y) >= 5) & (F.levenshtein(x, y) <= 2)
    return F.coalesce(F.startswith(x, y) | F.startswith(y, x) | slip, x.isNull() & y.isNull())


def _blocks(nodes: DataFrame) -> DataFrame:
    """``(id, block)`` of ``nodes(id, kind, one, two, first)``: any two names of one kind whose given names may agree share
    a block; where there is no given name, any two with surnames that begin alike or are two edits apart at most.

    A block is a kind and a first letter. A word a slip away from one with another letter is in that one's block too; the
    pigeonhole join of all these words finds them completely.
    """
    names = F.when(F.col("first").isNotNull(), F.array("first")).otherwise(F.array_compact(F.array("one", F.nullif(F.col("two"), F.lit("")))))
    own = nodes.select("id", F.concat("kind", F.when(F.col("first").isNull(), "||").otherwise("|")).alias("kind"), F.explode(names).alias("name"))
    words = materialize(own.where(F.length("name") >= 5).select("name").distinct(), "block-words")
    near = closest(words.select(F.col("name").alias("q")), words.select(F.col("name").alias("r")))
    slips = near.select(F.col("q").alias("name"), F.substring("r", 1, 1).alias("letter")).where("letter <> substring(name, 1, 1)").distinct()
    more = own.join(slips, "name").select("id", "kind", "letter")
    return own.select("id", "kind", F.substring("name", 1, 1).alias("letter")).unionByName(more).select("id", F.concat("kind", "letter").alias("block")).distinct()


#: Columns that make two spellings one name.
NAME = ["kind", "one", "two", "first", "house"]


def _compared(agents: DataFrame, reference: DataFrame | None, key: str, label: str, kind: str | None, top_n: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows, the parts of their spellings, the distinct names, and the similar pairs of these."""
    is_place = F.coalesce(F.col(kind).contains("Place"), F.lit(False)) if kind else F.lit(False)
    rows = agents.select(F.col(key).alias("key"), F.col(label).alias("label"), is_place.alias("place_row"))
    spelled = materialize(rows.where("label is not null and not place_row").select("label").distinct(), "spellings")
    if reference is not None:
        taught = materialize(reference_spellings(reference).select("entity", "label").distinct(), "taught-names")
        givens = common_words(taught)
        parts = materialize(parse_names(scatter(taught.select(F.col("entity").alias("id"), "label")), givens).withColumnRenamed("id", "entity"), "taught-parts")
        nicks = materialize(nicknames(parts, givens), "taught-nicknames")
    else:
        givens = common_words(spelled)
        parts, nicks = None, spelled.sparkSession.createDataFrame([], "nick string, formal string")
    named = parse_names(scatter(spelled.select(F.col("label").alias("id"), "label")), givens)
    if parts is None:
        # Given names of at least two spellings teach which ones are slips.
        named = materialize(named, "spelling-names")
    taught_firsts = (named if parts is None else parts).where("kind in ('person', 'firm') and size(given) > 0").select(F.get("given", F.lit(0)).alias("r")).groupBy("r").count()
    firsts = taught_firsts.where(f"count >= {2 if parts is None else 4} and length(r) >= 4").select("r")
    parsed = with_formal_names(named, nicks, firsts)
    parsed = materialize(
        parsed.where("kind in ('person', 'firm', 'partners')").select(
            "label", "kind", F.get("surnames", F.lit(0)).alias("one"), F.coalesce(F.get("surnames", F.lit(1)), F.lit("")).alias("two"), "first", "house"
        ),
        "spelling-parts",
    )
    nodes = materialize(parsed.groupBy(*NAME).agg(F.min("label").alias("l")).withColumn("id", F.xxhash64(*[F.coalesce(c, F.lit("\u0000")) for c in NAME])), "spelling-nodes")
    grams = F.concat(*[F.concat(ngrams(F.col("one"), n), F.when(F.col("two") != "", ngrams(F.col("two"), n)).otherwise(F.array().cast("array<string>"))) for n in GRAMS])
    spelled_out = bucketed(nodes.select("id", "one", "two"), "name-grams", "id", lambda names: names.select("id", grams.alias("grams")))
    pairs = cosine_pairs(spelled_out, _blocks(nodes), top_n=top_n)
    return rows, parsed, nodes, pairs


def spelling_clusters(agents: DataFrame, reference: DataFrame | None = None, key: str = "agent_id", label: str = "label", kind: str | None = "agent_type") -> DataFrame:
    """``(key, cluster, n_links)`` for each row: rows of one cluster name the same person or firm.

    A row with a null or empty label, a ``A || B`` label or a place is a cluster of its own. ``n_links`` counts the
    similar spellings that the row's spelling was compared with and passed the check. ``reference`` (labels and aliases
    of known names) teaches given names and nicknames; without it given names are learned from
    the labels and no nicknames are known.
    Repeated rows share their spelling's cluster; extra columns are not read.
    """
    rows, parsed, nodes, pairs = _compared(agents, reference, key, label, kind)
    name = NAME
    x = nodes.select(F.col("id").alias("a"), F.col("first").alias("x_first"), F.col("house").alias("x_house"))
    y = nodes.select(F.col("id").alias("b"), F.col("first").alias("y_first"), F.col("house").alias("y_house"))
    checked = pairs.join(x, "a").join(y, "b")
    houses = F.coalesce(F.col("x_house") == F.col("y_house"), F.lit(True))
    # Names of one surname that cannot be one person or firm count against the clusters they would join.
    fits = houses & _agree(F.col("x_first"), F.col("y_first"))
    edges = checked.select("a", "b", F.when(fits, F.col("cosine")).otherwise(-F.col("cosine")).alias("s"))
    edges = materialize(edges, "spelling-edges")
    clusters = average_linkage(nodes, edges)
    links = edges.where("s > 0").select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    by_label = parsed.join(nodes.select("id", *name).withColumnsRenamed({c: f"n_{c}" for c in name}), on=[F.col(c).eqNullSafe(F.col(f"n_{c}")) for c in name])
    found = materialize(by_label.select("label", "id").join(clusters, "id").join(links, "id", "left").select("label", "cluster", F.coalesce("n_links", F.lit(0)).alias("n_links")), "spelling-clusters")
    placed = rows.join(found, "label", "left").withColumn("linked", F.col("cluster").isNotNull() & ~F.col("place_row"))
    alone = F.xxhash64("key", F.lit("alone"))
    return placed.select(F.col("key").alias(key), F.when(F.col("linked"), F.col("cluster")).otherwise(alone).alias("cluster"), F.when(F.col("linked"), F.col("n_links")).otherwise(F.lit(0)).alias("n_links"))


def nearest_spellings(agents: DataFrame, reference: DataFrame | None = None, top_n: int = 10, key: str = "agent_id", label: str = "label", kind: str | None = "agent_type") -> DataFrame:
    """``(spelling, other, cosine)``: a report of the ``top_n`` nearest names of each name by cosine, each name shown by its
    first spelling. The same join as ``spelling_clusters``, which takes all partners. Places and null labels have none."""
    _, _, nodes, pairs = _compared(agents, reference, key, label, kind, top_n)
    shown = nodes.select("id", "l")
    named = pairs.join(shown.withColumnsRenamed({"id": "a", "l": "spelling"}), "a").join(shown.withColumnsRenamed({"id": "b", "l": "other"}), "b")
    return named.select("spelling", "other", F.round("cosine", 6).alias("cosine"))


def pairs_of_clusters(clusters: DataFrame, key: str = "agent_id") -> DataFrame:
    """``(key_a, key_b)``, a < b: all pairs of rows in one cluster. Its size is the number of answers asked for; a large
    cluster is split over tasks."""
    x, y = salted(clusters.select(key, "cluster"), ["cluster"])
    x, y = x.withColumnRenamed(key, f"{key}_a"), y.withColumnRenamed(key, f"{key}_b")
    return x.join(y, ["cluster", "salt"]).where(F.col(f"{key}_a") < F.col(f"{key}_b")).select(f"{key}_a", f"{key}_b")

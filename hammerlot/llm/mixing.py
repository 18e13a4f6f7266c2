"""Mix the documents of several sources to target shares of the total tokens, by pivotal dependent rounding.

Each source needs a number of copies per document that is seldom whole. Its whole part every document gets; the
fractions are rounded together: two documents meet, mass moves at random from one to the other until one of them is
whole, and the other goes on to meet the next. Sums are kept exactly, and as neighbours in size meet, so are tokens
nearly. Buckets of a source run apart and each leaves one fraction, which a reduction tree combines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hammerlot.plans.broadcasting import broadcast_if_small
from hammerlot.plans.materialize import materialize
from hammerlot.plans.parallelism import spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts text before byte-pair merging, as published with the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKET_ROWS = 20_000
FAN_IN = 64
WHOLE = 1e-9


@lru_cache(maxsize=2)
def _encoding(path: str):  # noqa: ANN202
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), tokenizer: str = TOKENIZER) -> DataFrame:
    """``(key, *keep, n_tokens)`` of every row; a null or empty text has 0 tokens."""
    source = spread(df.select(F.col(key), *keep, F.col(text).alias("__text")))
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (key, *keep)) + ", n_tokens bigint"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoding(tokenizer).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch["__text"]]
            yield batch.drop(columns="__text").assign(n_tokens=n)

    return source.mapInPandas(count, schema)


def source_name(source: Column) -> Column:
    """One spelling per source: trimmed, lower case, runs of blanks and hyphens as one underscore."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s\-_]+", "_")


def allotments(available: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """``(source, target_share, max_repeats, n_docs, available_tokens, planned_tokens, copies)`` per target source.

    ``available``: ``(source, n_docs, available_tokens)``. With ``total`` None the mix is the largest in which every
    source that has tokens gets its exact share of the sum of those sources' shares. With a given ``total`` a source
    that its cap keeps short gives the rest to the others in proportion, as far as their caps go.
    """
    rows = targets.join(available, "source", "left").na.fill(0, ["n_docs", "available_tokens"]).toPandas()  # one row per target source
    cap = rows["max_repeats"].clip(lower=0) * rows["available_tokens"].astype(float)
    share = rows["target_share"].fillna(0.0).clip(lower=0.0).where(cap > 0, 0.0)
    planned = share * 0.0
    if share.sum() > 0:
        share = share / share.sum()
        if total is None:
            planned = share * (cap[share > 0] / share[share > 0]).min()
        else:
            left, open_ = float(total), share > 0
            while left > 1e-6 and open_.any():
                step = share.where(open_, 0.0) / share[open_].sum() * left
                grown = (planned + step).where(planned + step < cap, cap).where(open_, planned)
                left -= float((grown - planned).sum())
                open_ = open_ & (grown < cap - 1e-9)
                planned = grown
    rows["planned_tokens"] = planned.astype(float)
    rows["copies"] = (planned / rows["available_tokens"].where(rows["available_tokens"] > 0, 1)).astype(float)
    schema = "source string, target_share double, max_repeats int, n_docs bigint, available_tokens bigint, planned_tokens double, copies double"
    names = [c.split()[0] for c in schema.split(", ")]
    return targets.sparkSession.createDataFrame([tuple(r[n].item() if hasattr(r[n], "item") else r[n] for n in names) for _, r in rows.iterrows()], schema)


def _chance(seed: int, *key: object) -> float:
    return int.from_bytes(hashlib.blake2b(repr((seed, *key)).encode(), digest_size=8).digest(), "big") / 2**64


def pivot(fractions: list[float], ids: list[int], seed: int) -> tuple[list[int], tuple[int, float] | None]:
    """Round ``fractions`` in [0, 1) in their order. Returns 0/1 per entry and the entry left with a fraction, if any.

    Two open entries p, q meet. p + q <= 1: one takes all, the other becomes 0; else one becomes 1 and the other keeps
    p + q - 1. The chances keep the expectation of both. Ids only seed the chances.
    """
    rounded = [0] * len(fractions)
    open_at, p = -1, 0.0
    for i, q in enumerate(fractions):
        if q <= WHOLE or q >= 1 - WHOLE:
            rounded[i] = int(q > 0.5)
            continue
        if open_at < 0:
            open_at, p = i, q
            continue
        u, both = _chance(seed, ids[open_at], ids[i]), p + q
        if both <= 1:
            if u * both >= p:
                open_at = i
            p = both
        else:
            if u * (2 - both) < 1 - q:
                rounded[open_at] = 1
                open_at = i
            else:
                rounded[i] = 1
            p = both - 1
        if p >= 1 - WHOLE or p <= WHOLE:
            rounded[open_at] = int(p > 0.5)
            open_at = -1
    return rounded, (open_at, p) if open_at >= 0 else None


def _round(units: DataFrame, seed: int, kind: str) -> DataFrame:
    """One level of the tree: round the units of each ``(source, bucket)``; ``rest`` marks the one left open."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        # Largest first, so that the entry left open is a small one.
        group = group.sort_values(["n_tokens", "id"], ascending=False, ignore_index=True)
        rounded, left = pivot(group["fraction"].tolist(), group["id"].tolist(), seed)
        group["extra"] = rounded
        group["rest"] = 0.0
        if left:
            group.loc[left[0], "rest"] = left[1]
        return group[["source", "bucket", "id", "n_tokens", "extra", "rest"]]

    return units.groupBy("source", "bucket").applyInPandas(run, f"source string, bucket bigint, id {kind}, n_tokens bigint, extra int, rest double")


def mix(
    docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 0, key: str = "doc_id", text: str = "text", source: str = "source", tokenizer: str = TOKENIZER
) -> tuple[DataFrame, DataFrame]:
    """Uses of each document ``(key, source, n_tokens, uses)`` and shares of each target source.

    Documents of a null or unlisted source are in neither; a listed source without documents has share 0; null texts
    have no tokens and no use. Every use count is at most the source's ``max_repeats``. Keys are unique; the same seed
    gives the same mix. Shares: ``(source, target_share, max_repeats, n_docs, available_tokens, planned_tokens,
    used_tokens, actual_share)``.
    """
    kind = docs.schema[key].dataType.simpleString()
    listed = targets.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    named = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), source_name(F.col(source)).alias("source"))
    named = named.join(broadcast_if_small(listed.select("source")), "source", "left_semi")
    sized = materialize(token_counts(named, "id", "text", ("source",), tokenizer).where("n_tokens > 0"), "mix-sizes")
    plan = allotments(sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("available_tokens")), listed, total)
    planned = sized.join(broadcast_if_small(plan.select("source", "copies", "n_docs", "max_repeats")), "source")
    whole = F.floor(F.col("copies") + WHOLE)
    fraction = F.greatest(F.lit(0.0), F.col("copies") - whole)
    buckets = F.ceil(F.col("n_docs") / BUCKET_ROWS)
    units = planned.select("source", "id", "n_tokens", whole.alias("whole"), fraction.alias("fraction"), F.pmod(F.xxhash64("id"), buckets).alias("bucket"))

    level = materialize(_round(units, seed, kind), "mix-level-0")
    widest = level.agg(F.max("bucket")).first()[0]
    extras = level.where("extra > 0").select("id", "extra")
    depth = 0
    while widest is not None:
        rest = level.where("rest > 0").select("source", F.floor(F.col("bucket") / FAN_IN).alias("bucket"), "id", "n_tokens", F.col("rest").alias("fraction"))
        if widest == 0:
            # One open document per source: it is rounded by itself.
            chance = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
            extras = extras.unionByName(rest.where(chance < F.col("fraction")).select("id", F.lit(1).alias("extra")))
            break
        depth += 1
        level = materialize(_round(rest, seed + depth, kind), f"mix-level-{depth}")
        extras = extras.unionByName(level.where("extra > 0").select("id", "extra"))
        widest = widest // FAN_IN
    uses = units.join(extras.groupBy("id").agg(F.sum("extra").alias("extra")), "id", "left")
    uses = uses.select("id", "source", "n_tokens", (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("int").alias("uses"))
    uses = materialize(uses, "mix-uses")
    used = uses.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("used_tokens"))
    shares = plan.join(used, "source", "left").na.fill(0, ["used_tokens"])
    # One row per target source: a window over all of them is small.
    shares = shares.withColumn("all_tokens", F.sum("used_tokens").over(W.partitionBy(F.lit(1)))).select(
        "source", "target_share", "max_repeats", "n_docs", "available_tokens", F.round("planned_tokens").cast("bigint").alias("planned_tokens"), "used_tokens",
        F.coalesce(F.try_divide(F.col("used_tokens"), F.col("all_tokens")), F.lit(0.0)).alias("actual_share"),
    )
    return uses.withColumnRenamed("id", key), shares

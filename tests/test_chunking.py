"""Lots: patterns, hidden lots, merges, reports, flags; one small case per branch."""

from __future__ import annotations

import random

import pytest

from hammerlot.operators import chunking, ordered, quality
from hammerlot.operators.chunking import best_pattern, chunk, inconsistencies, merge_sandwiched, separated, split_gaps

LOT = "catalogue_id string, idx int, num string, title string, text string"


def lots(spark, rows):  # noqa: ANN001, ANN201
    return spark.createDataFrame([("c", i, *r) for i, r in enumerate(rows, 1)], LOT)


def numbered(spark, nums):  # noqa: ANN001, ANN201
    return lots(spark, [(n, f"t{i}", f"x{i}") for i, n in enumerate(nums)])


CASES = [
    ("intro\n## 1 - Alpha\nbody\n## 2. Beta", "generic", [("1", "- Alpha", "## 1 - Alpha\nbody"), ("2", "Beta", "## 2. Beta")]),
    ("- 1. A\n- 2. B\n3. C", "bullet", [("1", "A", "- 1. A"), ("2", "B", "- 2. B"), ("3", "C", "3. C")]),
    ("1843.\n## SPRINGER", "generic", [("1843", "## SPRINGER", "1843.\n## SPRINGER")]),
    ("Il est\n2 — Foo", "generic", [("I", "l est", "Il est"), ("2", "— Foo", "2 — Foo")]),
    ("12", "generic", [("1", "2", "12")]),
    ("12\n13. Foo", "generic", [("12", "13. Foo", "12\n13. Foo")]),
    ("0. zero\n10. Ten", "generic", [("10", "Ten", "10. Ten")]),
    ("* 5) Five", "bullet", [("5", ") Five", "* 5) Five")]),
    ("no lots here", "generic", []),
    ("", "generic", []),
]


@pytest.mark.parametrize(("text", "pattern", "expected"), CASES)
def test_chunk(spark, text, pattern, expected):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([("c", text)], "catalogue_id string, text string")
    assert df.select(best_pattern(df["text"])).first()[0] == pattern
    rows = chunk(df).orderBy("idx").collect()
    assert [(r.num, r.title, r.text) for r in rows] == expected
    assert [r.idx for r in rows] == list(range(1, len(rows) + 1))


def test_chunk_nulls_extra_columns_and_marks(spark):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([("a", None, "x", 1), ("b", "1. A\x01b\x02c", "y", 2), ("b", "1. A\x01b\x02c", "y", 2)], "catalogue_id string, text string, key string, pattern int")
    rows = chunk(df).collect()
    assert [(r.catalogue_id, r.num, r.title) for r in rows] == [("b", "1", "Abc")] * 2
    assert chunk(df.limit(0)).collect() == []


def test_chunks_cover_the_text(spark):  # noqa: ANN001, ANN201
    chance = random.Random(3)
    texts = ["\n".join(chance.choice(["## 3 - Vase", "4. Urn", "plain words", "* 7 Cup", "Ivory", "", "| 9 Box |"]) for _ in range(20)) for _ in range(20)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "catalogue_id string, text string")
    for i, text in enumerate(texts):
        parts = [r.text for r in chunk(df.where(f"catalogue_id = '{i}'")).orderBy("idx").collect()]
        if parts:
            squeezed = "".join(text.split())
            assert squeezed.endswith("".join("".join(parts).split()))


GAPS = [
    ("## 10 - Alpha\n- 11 - Beta", ["10", "11"], ["10 - Alpha", "11 - Beta"]),
    ("10 alpha\n11. Beta", ["11"], ["11. Beta"]),
    ("10. Alpha 11. Beta 11. Gamma", ["10", "11", "11"], None),
    ("10. Alpha\n99. Stray\n11. Beta", ["10", "11"], None),
    ("10. Alpha\n11. beta", ["10"], None),
    ("10. Alpha\n11. été", ["10", "11"], None),
]


@pytest.mark.parametrize(("text", "nums", "titles"), GAPS)
def test_split_gaps(spark, text, nums, titles):  # noqa: ANN001, ANN201
    rows = split_gaps(lots(spark, [("10", "t", text), ("12", "u", "12. End")])).orderBy("idx").collect()
    assert [r.num for r in rows] == [*nums, "12"]
    assert [r.idx for r in rows] == list(range(1, len(nums) + 2))
    if titles:
        assert [r.title.lstrip("#- ") for r in rows[:-1]] == titles


def test_split_gaps_passes(spark):  # noqa: ANN001, ANN201
    rows = [("x", "t", "1. A"), ("1", None, None), ("3", "t", ""), (None, "t", "4. D"), ("5", "t", "x"), ("0", "t", "y")]
    out = split_gaps(lots(spark, rows)).orderBy("idx").collect()
    assert [(r.num, r.title, r.text) for r in out] == rows
    assert split_gaps(lots(spark, rows).limit(0)).collect() == []


MERGES = [
    (["5", "9", "6", "10"], ["5", "10"]),
    (["11", "1843", "12"], ["11", "12"]),
    (["7", "I", "8"], ["7", "8"]),
    (["12", "1513", "I3", "14"], ["12", "1513", "I3", "14"]),
    (["1", "2", "3"], ["1", "2", "3"]),
    (["5", "9", "6", "10", "11", "1843", "12"], ["5", "10", "11", "12"]),
]


@pytest.mark.parametrize(("nums", "left"), MERGES)
def test_merge(spark, nums, left):  # noqa: ANN001, ANN201
    out = merge_sandwiched(numbered(spark, nums)).orderBy("idx").collect()
    assert [r.num for r in out] == left
    assert " ".join(r.title for r in out).split() == [f"t{i}" for i in range(len(nums))]
    assert [r.idx for r in out] == list(range(1, len(left) + 1))


REPORTS = [
    (["1", "2", "4"], [(2, 4)]),
    (["1", "x", "2"], []),
    (["1", "I3", "4"], [(1, 3)]),
    (["3", "3"], [(3, 3)]),
    (["5", "4"], [(5, 4)]),
    ([], []),
]


@pytest.mark.parametrize(("nums", "found"), REPORTS)
def test_inconsistencies(spark, nums, found):  # noqa: ANN001, ANN201
    df = inconsistencies(numbered(spark, nums) if nums else numbered(spark, ["1"]).limit(0))
    assert df.columns == ["catalogue_id", "prev_num", "current_num", "title", "excerpt"]
    assert sorted((r.prev_num, r.current_num) for r in df.collect()) == sorted(found)


def test_flags_and_stats(spark):  # noqa: ANN001, ANN201
    df = numbered(spark, ["1", "2", "I4", "4", "9"])
    flagged = quality.flag_needs_revision(df, inconsistencies(df))
    assert [r.needs_revision for r in flagged.orderBy("idx").collect()] == [False, False, False, True, True]
    row = quality.catalogue_stats(flagged).first()
    assert (row.issues, row.total, row.percent_issues) == (2, 5, 40.0)
    assert quality.catalogue_stats(flagged.limit(0)).collect() == []


def test_separated(spark):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([("p", "---------\n1. A\n---------\n\n2. B"), ("q", None), ("r", "")], "page string, text string")
    assert [(r.page, r.idx, r.text) for r in separated(df).orderBy("idx").collect()] == [("p", 1, "1. A"), ("p", 2, "2. B")]


def test_ordered_across_buckets(spark):  # noqa: ANN001, ANN201
    chance = random.Random(1)
    rows = [(chance.choice(["a", "b", None]), i, chance.choice([None, 1, 2, 3])) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    out = ordered.neighbours(df, "k", ["i"], df["v"], "p", "n", bucket=7)
    out = ordered.last_before(out, "k", ["i"], out["v"], "l", bucket=7)
    out = ordered.running_sum(out, "k", ["i"], chunking.F.coalesce(out["v"], chunking.F.lit(0)), "s", bucket=7)
    got = {r.i: (r.p, r.n, r.l, r.s) for r in out.collect()}
    assert len(got) == len(rows)
    for key in ("a", "b", None):
        own = [(i, v) for k, i, v in rows if k == key]
        last, total = None, 0
        for j, (i, v) in enumerate(own):
            total += v or 0
            before, after = own[j - 1][1] if j else None, own[j + 1][1] if j + 1 < len(own) else None
            assert got[i] == (before, after, last, total)
            last = v if v is not None else last

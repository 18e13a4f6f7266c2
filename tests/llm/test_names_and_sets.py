"""Names, reference mapping, leaks, mixing: against brute force and by their invariants."""

from __future__ import annotations

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hammerlot.llm import canonical, leaks, mixing, name_parts, variants
from hammerlot.plans.skew import salted

AUTHORITY = "wikidata_id string, wikidata_label string, wikidata_description string, aliases string"


def lev(a, b):  # noqa: ANN001, ANN201
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("k", [1, 2])
def test_closest_is_complete(spark, k):  # noqa: ANN001, ANN201
    chance = random.Random(k)
    words = ["".join(chance.choice("abc") for _ in range(chance.randint(0, 7))) for _ in range(90)]
    q, r = words[:45], words[45:]
    got = {(x.q, x.r, x.d) for x in name_parts.closest(spark.createDataFrame([(w,) for w in [*q, None]], "q string"), spark.createDataFrame([(w,) for w in [*r, None]], "r string"), k).collect()}
    expected = {(a, b, lev(a, b)) for a in q for b in r if lev(a, b) <= k}
    assert got == expected


@pytest.mark.parametrize(
    ("label", "kind", "surnames", "given", "house"),
    [
        ("Gantolkamp, Pasco", "person", ["gantolkamp"], ["pasco"], None),
        ("T.M.Bloemvrichs", "person", ["bloemvrichs"], ["t", "m"], None),
        ("Dr. Leopold von Lodigobregate <Rom>", "person", ["lodigobregate"], ["leopold"], None),
        ("H. des ventes Zieglusco-Ferridigolschlag", "partners", ["ferridigolschlag", "zieglusco"], [], "hotel"),
        ("Zieglusco u. Ferridigolschlag", "partners", ["ferridigolschlag", "zieglusco"], [], None),
        ("Bellonganderellini, Humphrey (Antiquar.)", "firm", ["bellonganderellini"], ["humphrey"], "antiquar"),
        ("Casa d. vendite J. Zaborobreozzo & Co.", "firm", ["zaborobreozzo"], ["j"], "casa"),
        ("Auct.-Haus Innocenzo Knollmobreoux", "firm", ["knollmobreoux"], ["innocenzo"], "auktion"),
        ("Kunsthandlnug X. Merzozzo", "firm", ["merzozzo"], ["x"], "kunst"),
        ("A B || C D", "double", None, None, None),
        ("<Senkingen>", "single", ["senkingen"], [], None),
        ("", "none", None, None, None),
        (None, "none", None, None, None),
    ],
)
def test_parse_names(spark, label, kind, surnames, given, house):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([(1, label)], "id int, label string")
    row = name_parts.parse_names(df, ["humphrey", "innocenzo", "leopold", "pasco"]).first()
    assert row.kind == kind
    if surnames is not None:
        assert (row.surnames, row.given, row.house) == (surnames, given, house)


def authority(spark):  # noqa: ANN001, ANN201
    given = ["Friedrich", "Innocenzo", "Humphrey", "Pascal"]
    rows = [(f"Q{i}", f"{given[i % 4]} Zz{chr(97 + i // 4)}morellini", "art dealer in Rom", None) for i in range(40)]
    rows += [
        ("P1", "Friedrich Zenobiettinwick", "art expert in Montrain", "Fritz Zenobiettinwick;Zenobiettinwick, F."),
        ("P2", "Friedrich Wendelumont", None, "Fritz Wendelumont"),
        ("P3", "Friedrich Bocchiardent", None, "Fritz Bocchiardent"),
        ("F1", "Galerie Humphrey Stavelbach & Cie", "art gallery in Rom", None),
        ("F2", "Hôtel des ventes Zieglusco & Ferridschlag", "auction house in Rom", None),
        ("N1", "Gantolkamp", "family name", None),
        ("T1", "Senkingen", "town", "Senkinga"),
        ("A1", "Pascal Uhlenoldi", None, None),
        ("A2", "Philipp Uhlenoldi", None, None),
    ]
    return spark.createDataFrame(rows, AUTHORITY)


def test_map_to_reference(spark):  # noqa: ANN001, ANN201
    cases = [
        ("Zenobiettinnwick, F.,", "P1"), ("FRITZ ZENOBIETTINWICK", "P1"), ("Friedrich Zenoibettinwick <Montrain>", "P1"), ("Pascal Zenobiettinwick", "none"), ("Galerie Friedrich Zenobiettinwick", "none"),
        ("Stavelbach, Humphrey (Gal.)", "F1"), ("Auktionshaus Humphrey Stavelbach", "none"), ("Humphrey Stavelbach", "none"),
        ("Ferridschlag und Zieglusco", "F2"), ("Gantolkamp", "none"), ("Pascal Gantolkamp", "none"), ("<Senkingen>", "T1"), ("Senkniga", "T1"),
        ("P. Uhlenoldi", "none"), ("Pascal Uhlenoldi", "A1"), ("Friedrich Wendelumont || Pascal Uhlenoldi", "none"), (None, "none"), ("", "none"),
    ]
    df = spark.createDataFrame([(i, label, "x") for i, (label, _) in enumerate([*cases, cases[0]])], "agent_id bigint, label string, wikidata_id string")
    got = {r.agent_id: r.wikidata_id for r in canonical.map_to_reference(df, authority(spark)).collect()}
    assert {cases[i % len(cases)][0]: q for i, q in got.items()} == dict(cases)
    assert len(got) == len(cases) + 1
    assert canonical.map_to_reference(df.limit(0), authority(spark)).isEmpty()


def test_cosine_pairs_against_all_pairs(spark):  # noqa: ANN001, ANN201
    chance = random.Random(8)
    names = list({"".join(chance.choice("abcde") for _ in range(chance.randint(3, 9))) for _ in range(70)})
    df = spark.createDataFrame([(i, "b", n) for i, n in enumerate(names)], "id bigint, block string, n string")
    nodes = df.select("id", variants.ngrams(F.col("n"), 2).alias("grams"))
    # A second block that some share must not repeat their pairs.
    blocks = df.select("id", "block").unionByName(df.where("id < 20").select("id", F.lit("c").alias("block")))
    got = {(r.a, r.b): r.cosine for r in variants.cosine_pairs(nodes, blocks, 0.4).collect()}
    grams = [Counter("".join(sorted(f" {n} "[i : i + 2])) for i in range(len(n) + 1)) for n in names]
    seen = Counter(g for x in grams for g in x)
    vectors = []
    for x in grams:
        v = {g: c * math.sqrt(math.log1p(len(names) / max(seen[g], variants.RARE_SHARE * len(names), variants.RARE_LEAST))) for g, c in x.items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        vectors.append({g: w / norm for g, w in v.items()})
    expected = {(i, j): c for i in range(len(names)) for j in range(i + 1, len(names)) if (c := sum(w * vectors[j].get(g, 0) for g, w in vectors[i].items())) >= 0.4}
    assert got.keys() == expected.keys()
    assert all(got[p] == pytest.approx(expected[p]) for p in got)
    # With n at least the largest number of partners the best n are all; with fewer, each end keeps its best.
    partners = Counter(i for p in expected for i in p)
    most = variants.cosine_pairs(nodes, blocks, 0.4, top_n=max(partners.values())).collect()
    assert {(r.a, r.b) for r in most} == expected.keys()
    two = {(r.a, r.b) for r in variants.cosine_pairs(nodes, blocks, 0.4, top_n=2).collect()}
    best = {i: sorted((p for p in expected if i in p), key=lambda p: (-round(expected[p], 9), p))[:2] for i in partners}
    assert {tuple(p) for ps in best.values() for p in ps} >= two and len(two) < len(expected)


@pytest.mark.parametrize("cell_rows", [1, 7, 40, 1000])
def test_cosine_pairs_in_cells(spark, cell_rows):  # noqa: ANN001, ANN201
    chance = random.Random(5)
    names = ["".join(chance.choice("abcd") for _ in range(chance.randint(1, 8))) for _ in range(60)]
    df = spark.createDataFrame([(i * 31 % 60 - 9, n) for i, n in enumerate(names)], "id bigint, n string")
    nodes = df.select("id", F.when(F.col("id") != 3, variants.ngrams(F.col("n"), 2)).alias("grams"))
    blocks = df.select("id", F.explode(F.array(F.lit("x"), F.when(F.col("id") % 2 == 0, "y").otherwise("z"))).alias("block"))
    whole = {(r.a, r.b): r.cosine for r in variants.cosine_pairs(nodes, blocks, 0.3).collect()}
    cut = variants.cosine_pairs(nodes, blocks, 0.3, cell_rows=cell_rows).collect()
    assert len(cut) == len(whole) > 100 and {(r.a, r.b): r.cosine for r in cut} == whole
    assert all(a < b and 3 not in (a, b) for a, b in whole)
    assert variants.cosine_pairs(nodes.limit(0), blocks.limit(0), 0.3, cell_rows=cell_rows).isEmpty()


def test_cell_hands_on_pairs_in_batches(monkeypatch):  # noqa: ANN001, ANN201
    monkeypatch.setattr(variants, "CELL_PAIRS", 4)
    n, one = 12, [1.0]
    cell = pa.table({"i": [0] * n, "j": [0] * n, "part": [0] * n, "id": list(range(n, 0, -1)), "g": [[k % 2] for k in range(n)], "w": [one] * n})
    found = list(variants._cell(0.5)(iter(cell.to_batches(max_chunksize=5))))
    got = [(r["a"], r["b"], r["cosine"]) for x in found for r in x.to_pylist()]
    assert sorted(got) == [(a, b, 1.0) for a in range(1, n + 1) for b in range(a + 2, n + 1, 2)]
    assert len(found) > 1 and all(x.num_rows < 4 + n for x in found)


def test_cosine_pairs_send_names_not_pairs(spark):  # noqa: ANN001, ANN201
    """What is shuffled grows with the grams of the names, not with the pairs of names that share some."""
    chance = random.Random(6)
    names = ["".join(chance.choice("abcdefgh") for _ in range(9)) for _ in range(500)]
    nodes = spark.createDataFrame(list(enumerate(names)), "id bigint, n string").select("id", variants.ngrams(F.col("n"), 2).alias("grams")).cache()
    blocks = nodes.select("id", F.lit("b").alias("block"))
    grams = nodes.select(F.explode("grams")).count()
    context = spark.sparkContext._jsc.sc()

    def stages() -> dict[int, int]:
        context.listenerBus().waitUntilEmpty(30_000)
        seen = context.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return {seen.apply(i).stageId(): seen.apply(i).shuffleWriteRecords() for i in range(seen.size())}

    before = max(stages())
    found = variants.cosine_pairs(nodes, blocks, 0.5).collect()
    sent = sum(n for stage, n in stages().items() if stage > before)
    assert len(found) < grams
    assert 0 < sent < 8 * grams


@pytest.mark.parametrize("key_rows", [1, 3, 1000])
def test_salted_pairs_meet_once(spark, key_rows):  # noqa: ANN001, ANN201
    rows = [(i, "hot" if i < 9 else f"k{i % 3}") for i in range(15)] + [(3, "hot"), (99, None)]
    x, y = salted(spark.createDataFrame(rows, "i int, k string"), ["k"], key_rows)
    got = Counter((r.a, r.b) for r in x.withColumnRenamed("i", "a").join(y.withColumnRenamed("i", "b"), ["k", "salt"]).collect())
    assert got == Counter((a, b) for a, k in rows for b, m in rows if k == m and k is not None)


@pytest.mark.parametrize("name", [*name_parts.PARTICLES.split(), "d"])
def test_initial_is_no_particle(spark, name):  # noqa: ANN001, ANN201
    """A period makes it an initial, before or behind the surname; without one only ``d`` is."""
    labels = [f"{name.title()}. Gallimigolennec", f"Gallimigolennec, {name.title()}.", f"Karl {name} Gallimigolennec", f"{name.title()}. A. Gallimigolennec", "Karl d'Gallimigolennec"]
    df = spark.createDataFrame(list(enumerate(labels)), "id int, label string")
    got = {r.id: (r.kind, r.surnames, r.given) for r in name_parts.parse_names(df, ["karl"]).collect()}
    assert got[0] == got[1] == ("person", ["gallimigolennec"], [name])
    assert got[2] == ("person", ["gallimigolennec"], ["karl", "d"] if name == "d" else ["karl"])
    assert got[3] == ("person", ["gallimigolennec"], [name, "a"])
    assert got[4] == ("person", ["gallimigolennec"], ["karl"])


def test_names_without_reference(spark):  # noqa: ANN001, ANN201
    """A surname that comes often is no given name, and a slip in the first letter of a given name parts nobody."""
    groups = [
        ["Domenico Gallimigolennec", "Gallimigolennec, Domenico", "D. Gallimigolennec", "Gallimigolennec, D.", "Tomenico Gallimigolennec"],
        ["Eberhard Ostiananderstraat", "Ostiananderstraat, Eberhard", "E. Ostiananderstraat", "Ostiananderstraat, E."],
        ["Eberhard Gallimigolennec"],
    ]
    df = spark.createDataFrame([(i * 100 + j, label, "x/E21_Person") for i, g in enumerate(groups) for j, label in enumerate(g)], "agent_id bigint, label string, agent_type string")
    got = {(r.agent_id_a, r.agent_id_b) for r in variants.pairs_of_clusters(variants.spelling_clusters(df)).collect()}
    assert got == {(i * 100 + a, i * 100 + b) for i, g in enumerate(groups) for a in range(len(g)) for b in range(a + 1, len(g))}


def test_given_ids_are_reported(spark):  # noqa: ANN001, ANN201
    cases = [("Friedrich Zenobiettinwick", "P1", "label", "right"), ("Fritz Zenobiettinwick", "P2", "alias", "wrong"), ("Fritz Zenobiettinwik", None, "near", "missing"), ("Pascal Gantolkamp", "N1", None, "unsupported"), (None, None, None, None)]
    df = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "agent_id bigint, label string, wikidata_id string")
    got = {r.agent_id: (r.match_type, r.given_check) for r in canonical.map_to_reference(df, authority(spark)).collect()}
    assert got == {i: (c[2], c[3]) for i, c in enumerate(cases)}
    assert {r.given_check for r in canonical.map_to_reference(df.drop("wikidata_id"), authority(spark)).collect()} == {"missing", None}


def test_forms_of_forms_are_one_name(spark):  # noqa: ANN001, ANN201
    forms = {"mathurin": "abcdefg", "thurin": "abchi", "math": "hi"}
    rows = [(e, "person", ["x" + e], [g]) for g, entities in forms.items() for e in entities]
    nicks = name_parts.nicknames(spark.createDataFrame(rows, "entity string, kind string, surnames array<string>, given array<string>"), [])
    got = {r.nick: r.formal for r in nicks.collect()}
    assert got == {"thurin": "mathurin", "math": "mathurin"}


def test_average_linkage_against_plain(spark):  # noqa: ANN001, ANN201
    chance = random.Random(9)
    n = 18
    sims = {(i, j): round(chance.uniform(-0.5, 1), 3) for i in range(n) for j in range(i + 1, n) if chance.random() < 0.6}
    clusters = [{i} for i in range(n)]

    def average(x, y):  # noqa: ANN001, ANN202
        return sum(sims.get((min(a, b), max(a, b)), 0) for a in x for b in y) / len(x) / len(y)

    while True:
        best = max(((average(x, y), i, j) for i, x in enumerate(clusters) for j, y in enumerate(clusters) if i < j), default=(0, 0, 0))
        if best[0] < 0.4:
            break
        clusters[best[1]] |= clusters.pop(best[2])
    nodes = spark.range(n)
    edges = spark.createDataFrame([(a, b, s) for (a, b), s in sims.items()], "a bigint, b bigint, s double")
    found: dict[int, set[int]] = {}
    for r in variants.average_linkage(nodes, edges, 0.4).collect():
        found.setdefault(r.cluster, set()).add(r.id)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, clusters))


def joins(df):  # noqa: ANN001, ANN201
    return sum(line.lstrip(" :+-|").startswith("Join ") for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines())


@pytest.mark.parametrize("task_edges", [0, 3, 25, 60, 1000])
def test_average_linkage_in_rounds_and_in_one_task(spark, task_edges):  # noqa: ANN001, ANN201
    chance = random.Random(10)
    ids = [chance.randrange(-(1 << 62), 1 << 62) for _ in range(16)]
    sims = {(min(x, y), max(x, y)): chance.choice([-0.5, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) for i, x in enumerate(ids) for y in ids[:i] if chance.random() < 0.7}
    size, cluster, left = dict.fromkeys(ids, 1), {x: x for x in ids}, dict(sims)
    while left:
        (a, b), s = max(left.items(), key=lambda e: (round(e[1] / size[e[0][0]] / size[e[0][1]], 9), -e[0][0], -e[0][1]))
        if s / size[a] / size[b] < 0.4:
            break
        size[a] += size.pop(b)
        cluster = {x: a if c == b else c for x, c in cluster.items()}
        summed: Counter = Counter()
        for pair, t in left.items():
            x, y = sorted(a if c == b else c for c in pair)
            if x != y:
                summed[x, y] += t
        left = summed
    nodes = spark.createDataFrame([(x,) for x in [*ids, 7]], "id bigint")
    edges = spark.createDataFrame([(a, b, s) for (a, b), s in sims.items()], "a bigint, b bigint, s double")
    got = {r.id: r.cluster for r in variants.average_linkage(nodes, edges, 0.4, task_edges).collect()}
    assert got == cluster | {7: 7} and 2 < len(set(got.values())) < 14
    assert {(r.id, r.cluster) for r in variants.average_linkage(nodes, edges.limit(0), 0.4, task_edges).collect()} == {(x, x) for x in [*ids, 7]}


def test_plans_do_not_grow_with_the_rounds(spark):  # noqa: ANN001, ANN201
    """The driver's memory holds its plans: names that join one after another must not cost some for each."""
    n = 12
    edges = spark.createDataFrame([(a, b, 1 - 0.01 * b) for b in range(n) for a in range(b)], "a bigint, b bigint, s double")
    seen = spark._jsparkSession.sharedState().statusStore().executionsCount
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = seen()
    clusters = variants.average_linkage(spark.range(n), edges)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert seen() - before < n / 2
    assert joins(clusters) <= 2
    assert {r.cluster for r in clusters.collect()} == {0}
    in_rounds = variants.average_linkage(spark.range(n), edges, task_edges=0)
    assert joins(in_rounds) <= 2
    assert {r.cluster for r in in_rounds.collect()} == {0}


def test_nicknames_are_planned_once(spark):  # noqa: ANN001, ANN201
    rows = [(e, "person", ["x" + e], [g]) for g, entities in {"mathurin": "abcdefg", "thurin": "abchi"}.items() for e in entities]
    nicks = name_parts.nicknames(spark.createDataFrame(rows, "entity string, kind string, surnames array<string>, given array<string>"), [])
    assert joins(nicks) <= 2
    assert [tuple(r) for r in nicks.collect()] == [("thurin", "mathurin")]


def test_spelling_clusters(spark):  # noqa: ANN001, ANN201
    groups = [
        ["Zenobiettinwick, F.", "Fritz Zenobiettinwick", "FRIEDRICH ZENOBIETTINWICK", "Friedrich Zenoibettinwick", "Zenobiettinwick Friedrich"],
        ["Galerie Friedrich Zenobiettinwick", "Zenobiettinwick, F. (Gal.)"],
        ["Zieglusco & Ferridschlag", "Hôtel des ventes Ferridschlag et Zieglusco"],
        ["Pascal Zenobiettinwick"],
        ["Friedrich Wendelumont || Pascal Uhlenoldi"],
        ["Pascal Uhlenoldi", "Pascal Uhlenoldi"],
    ]
    rows = [(i * 100 + j, label, "x/E21_Person") for i, g in enumerate(groups) for j, label in enumerate(g)]
    rows += [(900, "Senkingen", "x/E53_Place"), (901, "Senkingen", "x/E53_Place"), (902, None, None), (903, None, None), (904, "", None)]
    df = spark.createDataFrame(rows, "agent_id bigint, label string, agent_type string")
    got = {(r.agent_id_a, r.agent_id_b) for r in variants.pairs_of_clusters(variants.spelling_clusters(df, authority(spark))).collect()}
    expected = {(i * 100 + a, i * 100 + b) for i, g in enumerate(groups) for a in range(len(g)) for b in range(a + 1, len(g))}
    assert got == expected
    assert variants.spelling_clusters(df.limit(0), authority(spark)).isEmpty()
    assert variants.spelling_clusters(df).count() == len(rows)


def test_leaks_against_plain(spark):  # noqa: ANN001, ANN201
    chance = random.Random(10)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(chance.choice(vocabulary) for _ in range(chance.choice([3, 8, 14])))) for i in range(12)]
    docs = []
    for d in range(60):
        words = [chance.choice(vocabulary) for _ in range(30)]
        if d % 3 == 0:
            passage = items[chance.randrange(12)][1].split()
            start = chance.randrange(max(1, len(passage) - 5))
            words[5:5] = passage[start : start + chance.randint(4, 9)]
        docs.append((d, " ".join(words)))
    found = leaks.leaks(spark.createDataFrame([*docs, (99, None), (98, "")], "doc_id bigint, text string"), spark.createDataFrame([*items, (77, None)], "item_id bigint, passage string"), least=5)
    got = {(r.doc_id, r.item_id) for r in found.where("kind = 'exact'").collect()}
    expected = set()
    for d, text in docs:
        w = text.split()
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        expected |= {(d, i) for i, p in items if any(tuple(p.split()[k : k + 5]) in grams for k in range(len(p.split()) - 4))}
    assert got == expected
    for r in found.where("kind = 'exact'").collect():
        doc, item = docs[r.doc_id][1].split(), items[r.item_id][1].split()
        assert doc[r.doc_from : r.doc_from + r.n_words] == item[r.item_from : r.item_from + r.n_words]


def near_of(doc, passage, least, slop, share):  # noqa: ANN001, ANN201
    if any(passage[i : i + least] == doc[j : j + least] for i in range(len(passage) - least + 1) for j in range(len(doc) - least + 1)):
        return None
    best = None
    for shift in range(-len(passage) - slop, len(doc) + slop):
        got = [i for i, w in enumerate(passage) if w in doc[max(0, i + shift - slop) : max(0, i + shift + slop + 1)]]
        if len(got) >= max(least, share * len(passage)) and (best is None or len(got) > best[0]):
            best = (len(got), got[0] + shift, got[0])
    return best


def test_near_leaks_against_plain(spark):  # noqa: ANN001, ANN201
    chance = random.Random(11)
    common = [f"w{i}" for i in range(40)]
    items, docs = [], [[chance.choice(common) for _ in range(40)] for _ in range(20)]
    for i in range(8):
        words = [chance.choice(common) for _ in range(28)]
        for k in range(0, 28, 6):
            words[k : k + 2] = [f"name{i}x{k}", f"number{i}x{k}"]
        items.append(words)
        # Both names of each window replaced by words that stand nowhere else, or by common ones; names seen elsewhere.
        docs.append([w if w in common or k > 23 else f"other{i}x{k}" for k, w in enumerate(words)])
        docs.append([w if w in common or k > 20 else "w1" for k, w in enumerate(words)])
        docs.append([w for w in words if w not in common])
        # A word put in, or left out, every few words; any word changed.
        docs.append([x for k, w in enumerate(words) for x in ([w, "inserted"] if k % 4 == 3 else [w])])
        docs.append([w for k, w in enumerate(words) if k % 7 != 6])
        docs += [[w if chance.random() > changed else chance.choice(common) for w in words] for changed in (0.1, 0.2, 0.3)]
    docs = [[chance.choice(common) for _ in range(chance.randint(0, 9))] + d for d in docs]
    frames = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id bigint, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, passage string")
    found = leaks.leaks(*frames).where("kind = 'near'").collect()
    expected = {(d, i): x for d, doc in enumerate(docs) for i, item in enumerate(items) if (x := near_of(doc, item, 12, 3, 0.75))}
    assert len(expected) > 20 and len(found) == len(expected)
    assert {(r.doc_id, r.item_id): (r.n_words, r.doc_from, r.item_from) for r in found} == expected


def test_leaks_see_through_typing(spark):  # noqa: ANN001, ANN201
    passage = "À la mort de Jean, le notaire öffnete straße cœur und zwölf Kisten — sofort wieder heute."
    docs = [(1, "x A LA MORT DE JEAN le   notaire offnete STRASSE coeur und zwolf kisten sofort wieder heute y"), (2, passage.replace("notaire", "clerc")), (3, passage.replace("zwölf", "elf oder zwölf"))]
    found = leaks.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(7, passage)], "item_id bigint, passage string"))
    assert {(r.doc_id, r.kind) for r in found.collect()} == {(1, "exact"), (2, "near"), (3, "near")}
    empty = spark.createDataFrame([], "item_id bigint, passage string")
    assert leaks.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), empty).isEmpty()


def test_pivot_keeps_sums_and_chances():  # noqa: ANN201
    chance = random.Random(11)
    fractions = [chance.random() for _ in range(40)]
    hits = [0] * 40
    for seed in range(400):
        rounded, left = mixing.pivot(fractions, list(range(40)), seed)
        assert abs(sum(rounded) + (left[1] if left else 0) - sum(fractions)) < 1e-6
        hits = [h + r for h, r in zip(hits, rounded, strict=True)]
        if left:
            hits[left[0]] += left[1]
    assert all(abs(h / 400 - f) < 0.13 for h, f in zip(hits, fractions, strict=True))
    assert mixing.pivot([], [], 0) == ([], None)


def test_mix(spark, monkeypatch):  # noqa: ANN001, ANN201
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 30)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    chance = random.Random(12)
    rows = [(i, "word " * chance.randint(5, 30), "Big Source" if i < 260 else " small") for i in range(300)]
    rows += [(400, "word word", "unlisted"), (401, "word word", None), (402, None, "small"), (403, "", "small")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, uses int")
    targets = spark.createDataFrame([("big_source", 0.5, 1), ("small", 0.4, 3), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    uses, shares = mixing.mix(docs, targets, seed=1)
    got = {r.source: r for r in shares.collect()}
    assert got["absent"].actual_share == 0
    assert sum(r.actual_share for r in got.values()) == pytest.approx(1)
    assert got["big_source"].actual_share == pytest.approx(5 / 9, abs=0.01)
    for r in uses.collect():
        assert 0 <= r.uses <= (1 if r.source == "big_source" else 3)
    assert uses.where("doc_id >= 400").count() == 0 and uses.count() == 300
    again = mixing.mix(docs.repartition(7), targets, seed=1)[0]
    assert again.exceptAll(uses).count() == 0
    capped = {r.source: r for r in mixing.mix(docs, targets, total=10**9)[1].collect()}
    assert capped["small"].used_tokens == 3 * capped["small"].available_tokens
    assert mixing.mix(docs.limit(0), targets)[0].isEmpty()

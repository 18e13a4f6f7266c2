"""Scalar functions, curation, pages, graph, reconciliation, sources and sinks, stream."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hammerlot.functions import text as T
from hammerlot.functions import vocabularies as V
from hammerlot.operators import curation, pages, reconcile, triples
from hammerlot.operators.chunking import inconsistencies
from hammerlot.operators.language_guess import detect_language
from hammerlot.operators.lookups import required_lookup
from hammerlot.plans.broadcasting import broadcast_if_small
from hammerlot.plans.materialize import bucketed, materialize, release
from hammerlot.sources import readers, writers
from hammerlot.streaming.incoming import run_incoming


def value(spark, expression, *cells):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([cells], ", ".join(f"c{i} string" for i in range(len(cells))))
    return df.select(F.expr(expression)).first()[0]


@pytest.mark.parametrize(
    ("label", "slug"),
    [("Frederik Muller & Cie", "frederik_muller_and_cie"), (" Hôtel d'Été, (Paris) ", "hôtel_dete_paris"), ("A/B\\C", "a_b_c"), ("Köln-Süd!", "köln-süd"), ("", ""), (None, None)],
)
def test_slug(spark, label, slug):  # noqa: ANN001, ANN201
    assert value(spark, T.slug("c0"), label) == slug


@pytest.mark.parametrize(
    ("text", "name", "place"),
    [
        ("Helbing <München>", "Helbing", "München"),
        ("<Parigi>", "<Parigi>", None),
        ("Name <Place", "Name", None),
        ("A <B> C", "A", "B"),
        (" Rossi, M. <perito antiquario> ", "Rossi, M.", "perito antiquario"),
        (None, None, None),
    ],
)
def test_name_place(spark, text, name, place):  # noqa: ANN001, ANN201
    assert (value(spark, T.name_part("c0"), text), value(spark, T.place_part("c0"), text)) == (name, place)


@pytest.mark.parametrize(
    ("start", "end", "label", "span", "begin", "finish"),
    [
        ("19120304", "19120306", "1912/03/04 - 1912/03/06", "1912_03_04-1912_03_06", "1912-03-04", "1912-03-06"),
        ("19120304", "idem", "1912/03/04", "1912_03_04", "1912-03-04", "1912-03-04"),
        ("s.d.", None, "s.d.", "sd", None, None),
        (None, "19120306", " - 1912/03/06", "-_1912_03_06", None, "1912-03-06"),
        ("1912", None, "1912//", "1912__", "1912--", None),
        (None, None, "", "", None, None),
    ],
)
def test_dates(spark, start, end, label, span, begin, finish):  # noqa: ANN001, ANN201
    made = T.date_label("c0", "c1")
    got = [value(spark, e, start, end) for e in (made, T.span_slug(made), T.date_begin("c0"), T.date_end("c0", "c1"))]
    assert got == [label, span, begin, finish]


@pytest.mark.parametrize(("text", "digits", "strict"), [("I3", 3, None), ("12.", 12, 12), (" - 7 –", 7, 7), ("1a2", 12, None), ("", None, None), (None, None, None), ("+5", 5, 5)])
def test_numbers(spark, text, digits, strict):  # noqa: ANN001, ANN201
    assert (value(spark, T.digits_int("c0"), text), value(spark, T.strict_int("c0"), text)) == (digits, strict)


def test_folder_id_and_strip(spark):  # noqa: ANN001, ANN201
    assert value(spark, T.folder_id("c0"), "AB01_84261_000007_l.jpg") == "84261"
    assert value(spark, T.folder_id("c0"), "plain.jpg") is None
    assert value(spark, T.strip("c0"), " \t x  \n") == "x"


def test_curation(spark):  # noqa: ANN001, ANN201
    rows = [("a", 1, "1", "t", "x"), ("a", 2, "3", "u", "y"), ("b", 1, "1", "v", "z"), (None, 1, "1", "n", "n")]
    lots = spark.createDataFrame(rows, "catalogue_id string, idx int, num string, title string, text string")
    found = inconsistencies(lots)
    assert found.count() == 1
    changed = curation.update_chunk(lots, found, "a", 2, " new ", " y ")
    row = changed.where("catalogue_id = 'a' and idx = 2").first()
    assert (row.title, row.text, row.needs_revision) == ("new", "y", True)
    assert not curation.update_chunk(lots, found, "a", 2, "new", "other").where("needs_revision").count()
    assert curation.update_chunk(lots, found, "zz", 2, "new", "other").drop("needs_revision").exceptAll(lots).count() == 0
    edited = spark.createDataFrame([(20, " 8 ", " B ", "b"), (10, "7", "A", " a ")], "pos int, num string, title string, text string")
    saved = curation.save_catalogue(lots, edited, "a")
    assert [(r.idx, r.num, r.title, r.text) for r in saved.where("catalogue_id = 'a'").orderBy("idx").collect()] == [(1, "7", "A", "a"), (2, "8", "B", "b")]
    assert saved.count() == 4 and saved.where("catalogue_id is null").count() == 1
    left = curation.resolve_inconsistency(found, "a", "1")
    assert left.count() == 0 and curation.removed_any(found, left)
    assert curation.resolve_inconsistency(found, "a", "3", by="current_num").count() == 0
    assert curation.resolve_inconsistency(found, "a", "3").count() == 1
    with pytest.raises(ValueError, match="prev_num"):
        curation.resolve_inconsistency(found, "a", "3", by="title")
    assert curation.view_catalogue(lots, "b").first().anchor_id == "chunk-1"
    assert curation.view_catalogue(lots, "none").isEmpty()


def test_pages(spark):  # noqa: ANN001, ANN201
    listed = spark.createDataFrame([("X_1_02_l.jpg",), ("X_1_01_l.jpg",), ("X_1_01_l.jpg",), ("X_2_01.jpg",), ("none.jpg",), (None,)], "filename string")
    index = {r.folder_id: (r.n_pages, r.filenames) for r in pages.folder_index(listed).collect()}
    assert index == {"1": (3, ["X_1_01_l.jpg", "X_1_01_l.jpg", "X_1_02_l.jpg"]), "2": (1, ["X_2_01.jpg"])}
    files = spark.createDataFrame([("X_1_01_l.jpg", "X_1"), ("other.jpg", "X_1"), ("X_2_01.jpg", "X_2"), (None, "X_1")], "filename string, folder string")
    assert pages.select_pages(files, listed).count() == 2
    assert pages.select_pages(files, listed, ["X_2"]).count() == 1
    assert pages.pending_pages(files, listed, "filename").count() == 2
    texts = spark.createDataFrame([("c", "02.md", "b"), ("c", "01.md", "a"), ("c", "all.md", "old"), ("c", "03.md", None)], "catalogue_id string, page string, text string")
    assert pages.concat_pages(texts).first()["text"] == "a\nb\n"

    def broken():  # noqa: ANN202
        def read(name, _):  # noqa: ANN001, ANN202
            if name == "X_2_01.jpg":
                raise ValueError("bad page")
            return "" if name == "none.jpg" else name.upper()

        return read

    done = {r.filename: (r.text, r.error) for r in pages.transcribe(listed.where("filename is not null"), broken).collect()}
    assert done["X_1_02_l.jpg"] == ("X_1_02_L.JPG", None)
    assert done["X_2_01.jpg"] == (None, "ValueError: bad page") and done["none.jpg"] == (None, "empty transcription")
    assert "none.jpg" in pages.render_prompts(listed.where("filename = 'none.jpg'")).first().prompt
    assert pages.grey(np.array([(255, 255, 255), (0, 0, 0), (255, 0, 0)])).tolist() == [255, 0, 76]


def test_triples(spark):  # noqa: ANN001, ANN201
    cats = spark.createDataFrame(
        [("A 1; B2", "Title", None, "1912.0", "fre", "Sale", "Rossi <Roma>", None, None, None), (None, "x", "y", "z", "q", "r", "s", "t", "u", "v"), ("C", None, "Other", None, "xx", None, None, "Haus", None, "P")],
        "nome_cartella string, titolo string, altri_titoli string, data_pubblicazione string, lingue string, vendita_asta string, autori_principali string, ente_autore_principale string, ente_autore_secondario string, autori_secondari string",
    )
    out = triples.catalogue_triples(cats, "n:")
    assert out.columns == list(triples.COLUMNS)
    assert out.count() == out.distinct().count()
    # Per id of the first row: 6 of the document, 2 + 2, 4 of creation and sale, 4 + 5 of the author.
    first = out.where("s like 'n:a_1%'").count()
    assert first == out.where("s like 'n:b2%'").count() == 20
    assert {(r.o, r.o_kind, r.o_datatype) for r in out.where("s = 'n:a_1_creation' and o_kind = 'literal'").collect()} == {("1912", "literal", triples.XSD + "gYear")}
    assert out.where("s = 'n:rossi' and o = 'n:roma'").count() == 1
    assert out.where("s = 'n:c' and p like '%label'").count() == 0
    auctions = spark.createDataFrame(
        [("A 1", "Roma", "19120304", "idem", "Coll X; ; Coll Y", "Org <Z>", None, "Bo <esperto>; Al; Cy <odd>", "DIPINTI; NIENTE; LIBRI", "Sec. XIX"), ("D", None, None, None, None, None, "Two", None, None, "new")],
        "inventario string, luogo_vendita string, data_inizio_asta string, data_fine_asta string, collezionisti string, autore_principale string, autore_secondario string, banditore string, tipi_oggetti string, cronologia string",
    )
    sale = triples.auction_triples(auctions, "n:")
    seen = {(r.s, r.p.rsplit("/", 1)[-1], r.o) for r in sale.collect()}
    assert ("n:d_auction", "P4_has_time-span", "n:") in seen
    assert ("n:1912_03_04", "P82b_end_of_the_end", "1912-03-04") in seen
    assert ("n:a_1_auction", "P16_used_specific_object", "n:coll_y") in seen
    assert {o for s, p, o in seen if s.startswith("n:a_1_auctioneer_assignment") and p == "P2_has_type"} == {triples.AAT + V.ROLES["esperto"], triples.AAT + V.AUCTIONEER}
    assert not any(s == "n:a_1_auctioneer_assignment_al" for s, _, _ in seen)
    assert not any("niente" in s for s, _, _ in seen)
    lines = [r.line for r in triples.triple_lines(triples.all_triples(cats, auctions, "n:")).collect()]
    assert '<n:a_1> <http://www.w3.org/2000/01/rdf-schema#label> "Title"@fr <n:catalogues> .' in lines
    assert triples.auction_triples(auctions.limit(0), "n:").isEmpty()


def test_reconcile(spark):  # noqa: ANN001, ANN201
    agents = spark.createDataFrame([(1, "Al. Bo"), (2, "al bo"), (3, "Ali"), (4, "Zed"), (5, None), (1, "Al. Bo")], "agent_id bigint, label string")
    authority = spark.createDataFrame([("Q2", "Al Bo", None), ("Q1", "Al  Bo", "x"), ("Q3", "Cy", "Ali;Al Bo")], "wikidata_id string, wikidata_label string, aliases string")
    got = sorted((r.agent_id, r.wikidata_id or "", r.match_type or "") for r in reconcile.reconcile_agents(agents, authority).collect())
    assert got == [(1, "Q2", "label"), (1, "Q2", "label"), (2, "Q2", "label"), (3, "Q3", "alias"), (4, "", ""), (5, "", "")]


def test_detect_language(spark):  # noqa: ANN001, ANN201
    rows = [("Le livre est dans la salle avec les autres", "fr"), ("Der Krug ist mit einem Deckel und die Dose auch", "de"), ("高さは18センチである", "ja"), ("", None), (None, None), ("zzz", None)]
    df = spark.createDataFrame(rows, "t string, lang string")
    assert [r[0] for r in df.select(detect_language(F.col("t"))).collect()] == [lang for _, lang in rows]


def test_sources_and_sinks(spark, tmp_path):  # noqa: ANN001, ANN201
    lots = spark.createDataFrame([(1, "1", 'a "b"\nc', "x,y", "k"), (2, None, "t", "", "l")], readers.LOTS)
    writers.write_csv(lots, f"{tmp_path}/csv")
    back = readers.read_csv(spark, f"{tmp_path}/csv", readers.LOTS)
    assert back.where("idx = 1").first() == lots.where("idx = 1").first() and back.count() == 2
    writers.write_lots(lots, f"{tmp_path}/lots")
    assert spark.read.parquet(f"{tmp_path}/lots").where("catalogue_id = 'k'").count() == 1
    writers.write_snapshot(lots, f"{tmp_path}/snap")
    again = spark.read.parquet(f"{tmp_path}/snap")
    writers.write_snapshot(again.where("idx = 1"), f"{tmp_path}/snap")
    assert spark.read.parquet(f"{tmp_path}/snap").count() == 1
    writers.append_errors(lots.select("title"), f"{tmp_path}/bad")
    writers.append_errors(lots.select("title"), f"{tmp_path}/bad")
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 4
    writers.write_lines(lots.select("num").where("num is not null"), f"{tmp_path}/lines")
    assert spark.read.text(f"{tmp_path}/lines").first()[0] == "1"
    for name, text in (("c1", "## 1 - A\n## 2 - B\n"), ("c2", "1. X\n")):
        (tmp_path / "docs" / name / "md").mkdir(parents=True)
        (tmp_path / "docs" / name / "md" / "all.md").write_text(text)
        (tmp_path / "docs" / name / "md" / "p1.md").write_text("page")
    found = {r.catalogue_id: r.text for r in readers.read_documents(spark, f"{tmp_path}/docs").collect()}
    assert found == {"c1": "## 1 - A\n## 2 - B\n", "c2": "1. X\n"}
    assert readers.read_documents(spark, f"{tmp_path}/docs", ["c2"]).count() == 1
    assert readers.read_pages(spark, f"{tmp_path}/docs").count() == 4
    (tmp_path / "img" / "c1").mkdir(parents=True)
    (tmp_path / "img" / "c1" / "p.jpg").write_bytes(b"123")
    assert readers.read_images(spark, f"{tmp_path}/img").select("folder", "filename").first() == ("c1", "p.jpg")
    assert readers.page_list(spark, ["a", "b"]).count() == 2
    for _ in range(2):  # the second run finds nothing new
        run_incoming(spark, f"{tmp_path}/docs", f"{tmp_path}/out", f"{tmp_path}/report", f"{tmp_path}/ck").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_plans(spark):  # noqa: ANN001, ANN201
    df = spark.range(50)
    kept = materialize(df, "x")
    assert kept.count() == 50
    assert "shared" in kept.inputFiles()[0]
    assert "BroadcastHashJoin" in spark.range(9).join(broadcast_if_small(df), "id")._jdf.queryExecution().toString()
    assert broadcast_if_small(df, 10) is df


def test_core_parity(spark):  # noqa: ANN001, ANN201
    """Every core query agrees with its SQL on the smallest tables."""
    parity = pytest.importorskip("parity")
    import os

    from hammerlot.oracles import ORACLES
    from hammerlot.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    con = parity.engine(folder)
    bad = {name: d for name in sorted(ORACLES) if (d := parity.compare(spark, con, QUERIES[name], ORACLES[name], folder))}
    assert not bad
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, folder).count() >= 0


def test_save_keeps_repeated_and_null_positions(spark):  # noqa: ANN001, ANN201
    lots = spark.createDataFrame([("a", 1, "1", "t", "x"), ("b", 1, "7", "t", "y"), (None, 1, "3", "t", "z")], "catalogue_id string, idx int, num string, title string, text string")
    edited = spark.createDataFrame([(1, "2", "b", " two "), (1, "1", "a", "one"), (None, "9", None, "nine"), (None, "9", None, "nine")], "pos int, num string, title string, text string")
    got = curation.save_catalogue(lots, edited, "a").collect()
    assert sorted((r.idx, r.num, r.text, r.needs_revision) for r in got if r.catalogue_id == "a") == [(1, "1", "one", False), (2, "2", "two", False), (3, "9", "nine", True), (4, "9", "nine", True)]
    assert sorted(r.text for r in got if r.catalogue_id != "a") == ["y", "z"]
    assert curation.save_catalogue(lots, edited.limit(0), "a").count() == 2


def test_form_rows_are_cut_to_the_shortest(spark):  # noqa: ANN001, ANN201
    assert [tuple(r) for r in curation.form_rows(spark, ["1", "2"], ["a", "b", "c"], ["x", "y"]).orderBy("pos").collect()] == [(1, "1", "a", "x"), (2, "2", "b", "y")]
    assert curation.form_rows(spark, [], ["a"], ["x"]).isEmpty()


def test_required_lookup_stops(spark):  # noqa: ANN001, ANN201
    codes = spark.createDataFrame([("ger", "de"), ("abs", None)], "label string, code string")
    rows = spark.createDataFrame([("ger",), ("abs",)], "lingue string")
    assert {tuple(r) for r in required_lookup(rows, codes, "lingue").collect()} == {("ger", "de"), ("abs", None)}
    with pytest.raises(Exception, match="no entry for lingue xxx"):
        required_lookup(spark.createDataFrame([("xxx",)], "lingue string"), codes, "lingue").collect()


def test_missing_documents_and_page_order(spark):  # noqa: ANN001, ANN201
    listed = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "catalogue_id string")
    assert [tuple(r) for r in pages.missing_documents(listed, spark.createDataFrame([("a", "x")], "catalogue_id string, text string")).collect()] == [("b", "no text")]
    names = spark.createDataFrame([(1, "X_f1_b.jpg"), (2, "X_f1_a.jpg"), (3, "none"), (4, None)], "line int, filename string")
    assert pages.folder_index(names, order="line").first().filenames == ["X_f1_b.jpg", "X_f1_a.jpg"]
    assert pages.folder_index(names).first().filenames == ["X_f1_a.jpg", "X_f1_b.jpg"]


def test_pages_are_run_once(spark, tmp_path):  # noqa: ANN001, ANN201
    image = b"P6 2 1 255\n" + bytes([255, 0, 0, 10, 20, 30])
    for name, data in (("p1.jpg", image), ("p2.jpg", image), ("bad.jpg", b"no image"), ("empty.jpg", image)):
        path = tmp_path / "in" / "cat" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)

    def transcriber():  # noqa: ANN202
        return lambda name, content: "" if name == "empty.jpg" else f"{name} {len(content)}"

    images = readers.read_images(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    got = {r.filename: r.error for r in pages.run_pages(images, out, transcriber).collect()}
    assert got["p1.jpg"] is None and got["p2.jpg"] is None and got["empty.jpg"] == "empty transcription" and "ValueError" in got["bad.jpg"]
    assert (tmp_path / "out/cat/md/p1.md").read_text() == "p1.jpg 13"
    assert (tmp_path / "out/cat/grey/p1.jpg").read_bytes() == b"P5 2 1 255\n" + bytes([76, 18])
    assert sorted(p.name for p in (tmp_path / "out/cat/md").iterdir()) == ["p1.md", "p2.md"]
    done = readers.read_pages(spark, out).select(F.col("catalogue_id").alias("folder"), F.regexp_replace("page", r"\.md$", "").alias("page"))
    assert {r.filename for r in pages.run_pages(images, out, transcriber, done).collect()} == {"bad.jpg", "empty.jpg"}


def test_release_removes_what_was_written(spark):  # noqa: ANN001, ANN201
    import os

    table = bucketed(spark.range(20).withColumnRenamed("id", "k"), "b", "k", buckets=3)
    path = table.inputFiles()[0].removeprefix("file:")
    assert table.count() == 20 and os.path.exists(path)
    assert "Exchange" not in table.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    release()
    assert not os.path.exists(path)

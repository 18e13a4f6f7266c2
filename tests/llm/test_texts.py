"""Sentences, markup, scan noise, languages: branches, edge cases, comparison with plain versions."""

from __future__ import annotations

import itertools
import random
import time

import pytest

from hammerlot.llm import languages, markup, scan_noise, sentences
from hammerlot.llm.vocabulary_trie import CONFUSIONS, Trie, query_keys, within_shard, word_keys


def cut(text, lang=None):  # noqa: ANN001, ANN201
    at, out = 0, []
    for end in sentences.sentence_ends(text, lang):
        out.append(text[at:end].strip())
        at = end
    return out


SENTENCES = [
    ("Dr. A. B. Muhl kam am 12. März. Das Los ging an Hrn. Ott.", ["Dr. A. B. Muhl kam am 12. März.", "Das Los ging an Hrn. Ott."]),
    ("Im Protokoll heißt es: „Das Los ist weg. Man ging.“ Ende gut.", ["Im Protokoll heißt es: „Das Los ist weg. Man ging.“", "Ende gut."]),
    ("« Voilà un morceau ! » s'écria Jean. Et quel prix !!! Fini.", ["« Voilà un morceau ! » s'écria Jean.", "Et quel prix !!!", "Fini."]),
    ("It was sold.The next came (see p. 3, fig. 4). (See pl. 5.) End", ["It was sold.", "The next came (see p. 3, fig. 4).", "(See pl. 5.)", "End"]),
    ("Heading\n\nText one. Text\ntwo.\n\n- item a\n- item b", ["Heading", "Text one.", "Text\ntwo.", "- item a", "- item b"]),
    ("高さは8.3センチである。「これは本物か。見せてくれ。」と客が尋ねた。次。", ["高さは8.3センチである。", "「これは本物か。見せてくれ。」と客が尋ねた。", "次。"]),
    ("买主问道：“这是真品吗？请让我看看。”保存完好……高3.2厘米。", ["买主问道：“这是真品吗？请让我看看。”", "保存完好……", "高3.2厘米。"]),
    ("สูง 63.5 เซนติเมตร กว้าง 83 เซนติเมตร ด้านหลังมีจารึกปี 1884 ชิ้นนี้อยู่ในบัญชี", ["สูง 63.5 เซนติเมตร กว้าง 83 เซนติเมตร", "ด้านหลังมีจารึกปี 1884", "ชิ้นนี้อยู่ในบัญชี"]),
    ('डॉ. शर्वेल ने कहा, "यह बिका नहीं। आगे बढ़ो।" और सब चुप हो गए। पीछे 6.2 से.मी. है।', ['डॉ. शर्वेल ने कहा, "यह बिका नहीं। आगे बढ़ो।" और सब चुप हो गए।', "पीछे 6.2 से.मी. है।"]),
    ("Высота 2,51 см, т. е. мало! Сказал г-н И. П. Брусколь.", ["Высота 2,51 см, т. е. мало!", "Сказал г-н И. П. Брусколь."]),
    ("Ποιος αγόρασε το κουτί; Ο κ. Βρουσκόλ είπε: «Όχι. Ναι.» και βγήκε.", ["Ποιος αγόρασε το κουτί;", "Ο κ. Βρουσκόλ είπε: «Όχι. Ναι.» και βγήκε."]),
    ("كتب د. سروال على ظهرها سنة 1808. من اشترى؟ نعم", ["كتب د. سروال على ظهرها سنة 1808.", "من اشترى؟", "نعم"]),
    ("", []),
    (" \n ", []),
    ("...", ["..."]),
]


@pytest.mark.parametrize(("text", "expected"), SENTENCES)
def test_sentences(text, expected):  # noqa: ANN001, ANN201
    assert cut(text) == expected


def test_sentences_cover_long_text():  # noqa: ANN201
    chance = random.Random(5)
    words = ["Dr.", "ging", "weg.", "Was?", "(so.)", "„Ja.“", "3.5", "\n\n", "- x\n", "Ende!", "ab"]
    text = " ".join(chance.choice(words) for _ in range(4000))
    ends = sentences.sentence_ends(text)
    assert ends == sorted(set(ends))
    assert not text[ends[-1] :].strip() and all(not text[e - 1].isspace() for e in ends)
    # A rule table decides the same whether its rules are merged or asked one by one.
    rules = [*sentences.SCRIPT_RULES["latin"], *itertools.chain(*(sentences.LANGUAGE_RULES[x] for x in ("de", "fr"))), *sentences.DEFAULT_RULES]
    merged = sentences.compiled(rules)
    single = [c for r in rules for c in sentences.compiled([r])]
    for e in range(1, min(len(text), 3000)):
        first = [next((c.breaks for c in table if c.after.match(text, e) and c.before.search(text, sentences._word_start(text, e, 0), e)), False) for table in (merged, single)]
        assert first[0] == first[1]


@pytest.mark.parametrize("length", [5, 51, 296, 3000])
def test_long_quotations_are_like_short_ones(length):  # noqa: ANN001, ANN201
    said = "客" * length
    assert cut(f"买主问道：“{said}。请看？”保存完好。", "zh") == [f"买主问道：“{said}。请看？”", "保存完好。"]
    assert cut(f"「{said}。」と客が尋ねた。次。", "ja") == [f"「{said}。」と客が尋ねた。", "次。"]
    assert cut(f"Es war am{' ' * length}12. März. Gut.") == [f"Es war am{' ' * length}12. März.", "Gut."]
    assert cut(f"Ende{'!' * length}{' ' * length}Neu.") == [f"Ende{'!' * length}", "Neu."]


def test_long_runs_take_linear_time():  # noqa: ANN201
    for text in ("1.2" * 20_000, "「そう。」と" * 6_000, "a! " * 20_000, "เก่า " * 15_000, "” . " * 15_000):
        began = time.perf_counter()
        assert sentences.sentence_ends(text)
        assert time.perf_counter() - began < 10


def test_split_sentences_frame(spark):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([(1, "A b. C d.", None, 5), (2, None, "de", 5), (3, "", "xx", 5), (1, "A b. C d.", None, 5)], "doc_id bigint, text string, lang string, sent_no int")
    rows = [tuple(r) for r in sentences.split_sentences(df).orderBy("doc_id", "sent_no").collect()]
    assert rows == [(1, 1, 0, 4, "A b."), (1, 1, 0, 4, "A b."), (1, 2, 5, 9, "C d."), (1, 2, 5, 9, "C d.")]
    assert sentences.split_sentences(df.limit(0)).isEmpty()


MARKUP = [
    ("1 - A lot\n\n<h3><b>Old &amp; New 9</b></h3>\n\n<ul><li>a, 1</li><li><b>b, 2</b></li></ul>", [("heading", "Old & New 9"), ("list_item", "a, 1"), ("list_item", "b, 2")]),
    ("1\n<UL>\n<LI>a\n<LI>b</UL>\n<pre><code>x &lt; y\n</code></pre>", [("list_item", "a"), ("list_item", "b"), ("code", "x < y")]),
    ("# 1 lot\n## NAME\n### Head 3 ###\n+ **x, 4**\n* y\n```sql\nSELECT 1\n```\n$$\na^2\n$$\n$h = 1$", [("heading", "Head 3"), ("list_item", "x, 4"), ("list_item", "y"), ("code", "SELECT 1"), ("formula", "a^2"), ("formula", "h = 1")]),
    ("1\n== Sale 2 ==\n** '''z, 5'''\n<math>\\frac{1}{2}</math>\n{|\n|-\n| a || 2\n|}\n{{Lot|num=1}}", [("heading", "Sale 2"), ("list_item", "z, 5"), ("formula", "\\frac{1}{2}")]),
    ("1\n\\section{S 1}\n\\begin{itemize}\n  \\item a\n  \\item \\textbf{b}\n\\end{itemize}\n\\begin{verbatim}\nq\n\\end{verbatim}\n\\(x\\)", [("heading", "S 1"), ("list_item", "a"), ("list_item", "b"), ("code", "q"), ("formula", "x")]),
    ("1\nTitle 7\n-------\n\ntext `word` here", [("heading", "Title 7")]),
    ("1\nsee [this](http://x.example/1) and &eacute;", []),
]


@pytest.mark.parametrize(("text", "expected"), MARKUP)
def test_markup_elements(text, expected):  # noqa: ANN001, ANN201
    parsed = markup.parse(text)
    assert parsed.residue
    assert markup.elements(parsed) == expected


@pytest.mark.parametrize(
    "text",
    ["## 12 - Une soupière.\n\nVente de M. *** <Valmorane>.\n\n## NAME\n\n(FIRST) 1600. - 1700.", "- 3 . Lot A***, Inv. no_14_b <Brück>, 5 < 6, at $ 12 or $ 13 & Co. [sic]", "", None, "1\n- 34 -\n[97]\n~ 3 ~", "1 *** 2\n***\ntext goes on"],
)
def test_plain_text_is_no_markup(text):  # noqa: ANN001, ANN201
    parsed = markup.parse(text)
    assert not parsed.residue
    assert markup.render(parsed) == (text or "").strip("\n") or "***" in text


def test_render():  # noqa: ANN201
    text = "1 - Lot\n<p>One <i>two.</p><ul><li>a<li>b</ul><table><tr><td>aa</td><td>1</td></tr><tr><td>b</td><td>22</td></tr></table><!-- x --><span style=\"display:none\">gone</span>end"
    assert markup.render(markup.parse(text)) == "1 - Lot\n\nOne two.\n\n- a\n- b\n\naa  1\nb   22\n\nend"


def test_markup_survives_anything():  # noqa: ANN201
    chance = random.Random(2)
    bits = ["<b>", "</b>", "<li>", "\\begin{itemize}", "\\item", "{|", "|}", "|", "$", "$$", "**", "_", "`", "```", "\n", "# x", "== y ==", "[[", "]]", "&amp;", "<!--", "{", "}", "text", "<table>", "</td>", "\\("]
    for _ in range(300):
        text = "".join(chance.choice(bits) for _ in range(40))
        markup.render(markup.parse(text))


def test_markup_frames(spark):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([(1, "1\n<b>x</b>", "e"), (2, None, "e"), (3, "plain", "e"), (1, "1\n<b>x</b>", "e")], "chunk_id bigint, text string, elem string")
    assert [tuple(r) for r in markup.markup_elements(df).collect()] == [(1, "none", "")] * 2
    got = {r.chunk_id: (r.clean_text, r.had_markup) for r in markup.render_markup(df).collect()}
    assert got == {1: ("1\n\nx", True) if got[1][0] == "1\n\nx" else ("1\nx", True), 2: (None, False), 3: ("plain", False)}
    assert markup.markup_elements(df.limit(0)).isEmpty()


def plain_cost(shown, meant, budget):  # noqa: ANN001, ANN201
    """Least cost by dynamic programming over both strings."""
    table = {(0, 0): 0}
    for i in range(len(shown) + 1):
        for j in range(len(meant) + 1):
            here = table.get((i, j), 99)
            steps = [(i + 1, j, 2), (i, j + 1, 2)]
            if i < len(shown) and j < len(meant):
                steps.append((i + 1, j + 1, 0 if shown[i] == meant[j] else 2))
            steps += [(i + len(a), j + len(b), 1) for a, b in CONFUSIONS if shown.startswith(a, i) and meant.startswith(b, j)]
            for x, y, c in steps:
                if x <= len(shown) and y <= len(meant):
                    table[x, y] = min(table.get((x, y), 99), here + c)
    cost = table[len(shown), len(meant)]
    return cost if cost <= budget else None


def test_trie_finds_every_candidate():  # noqa: ANN201
    chance = random.Random(4)
    words = {"".join(chance.choice("abcelmnrti") for _ in range(chance.randint(1, 6))) for _ in range(250)}
    trie = Trie(words)
    for _ in range(60):
        query = "".join(chance.choice("abcelmnrti1!h") for _ in range(chance.randint(1, 6)))
        expected = {w: c for w in words if (c := plain_cost(query, w, 2)) is not None}
        assert trie.within(query) == expected
        # The shards that the query names find the same, and a word is in few of them.
        shards: dict[str, list[str]] = {}
        for word in words:
            assert len(word_keys(word)) <= 4
            for key in word_keys(word):
                shards.setdefault(key, []).append(word)
        parted: dict[str, int] = {}
        for key in query_keys(query):
            for _, word, cost, _ in within_shard(key, shards.get(key, []), [query]):
                parted[word] = min(cost, parted.get(word, 9))
        if len(query) > 1:
            assert parted == {w: c for w, c in expected.items() if c}


def test_neighbours_rank_general_edits(spark):  # noqa: ANN001, ANN201
    """A letter misread beyond the known confusions is repaired where both neighbours speak for it, and only there."""
    rows = [(i, f"c{i % 3}", None, "1 - X\n\nDavor die weite landschaft bei Abendlicht gemalt.") for i in range(40)]
    rows += [(100, "c0", None, "1 - X\n\nDavor die weite landschxft bei Abendlicht gemalt."), (101, "c0", None, "1 - X\n\nManche enge landschxft vor Morgenrot gemalt.")]
    df = spark.createDataFrame(rows, "chunk_id bigint, catalogue_id string, title string, text string")
    assert {(r.chunk_id, r.noise, r.span) for r in scan_noise.scan_noise(df).collect()} == {(100, "misread", "landschaft")}


def scans(spark):  # noqa: ANN001, ANN201
    line = "Le pied, en cuivre repoussé, repose sur quatre griffes et porte encore palmettes ajourées avec une soupière couverte."
    rows = [(i, f"c{i % 3}", f"- Une soupière {i}.", f"{i} - Une soupière.\n\n{line}") for i in range(60)]
    rows += [
        (100, "c0", "- Une s0upière.", "1 - Une s0upière.\n\nLe pied, en cuivre repous-\n- 34 -\nCOLLECTION DE M. DE MAZZURIGOLD\nsé, repose sur qnatre griffes et portc encore palmettes.\n\n1636."),
        (101, "c0", None, "2 - X\n\nCOLLECTION DE M. DE MAZZURIGOLD — 35\n\nLe pied, en cuivre."),
        (102, "c1", None, "3 - X\n\nCOLLECTION DE M. DE BRANDIGOLWICK\n\np. 12"),
        (103, "c2", None, "4 - X\n\nCOLLECTION DE M. DE HALVERGREBE\n\nGold- und Silber."),
        (104, None, None, None),
        (105, "c2", "", ""),
    ]
    return spark.createDataFrame([(*r, "extra") for r in rows], "chunk_id bigint, catalogue_id string, title string, text string, noise string")


def test_scan_noise(spark):  # noqa: ANN001, ANN201
    df = scans(spark)
    got = {(r.chunk_id, r.field, r.noise, r.span) for r in scan_noise.scan_noise(df.unionAll(df)).collect()}
    assert {x for x in got if x[0] == 100} == {
        (100, "title", "misread", "soupière"), (100, "text", "misread", "soupière"), (100, "text", "misread", "quatre"), (100, "text", "misread", "porte"),
        (100, "text", "hyphen", "repoussé"), (100, "text", "pageno", "- 34 -"), (100, "text", "header", "COLLECTION DE M. DE MAZZURIGOLD"),
    }
    assert (101, "text", "header", "COLLECTION DE M. DE MAZZURIGOLD — 35") in got
    assert (102, "text", "pageno", "p. 12") in got
    assert not {x for x in got if x[0] in (104, 105) or x[2] == "hyphen" and x[0] == 103}
    assert scan_noise.scan_noise(df.limit(0)).isEmpty()


def test_misread_titles_have_contexts_of_their_own(spark):  # noqa: ANN001, ANN201
    rows = [(i, "c0", f"Kabinettschrank {i}.", f"## {i} - Kabinettschrank {i}.") for i in range(10, 40)]
    rows += [(50, "c0", "Kab!nettschrank.", "## 20 - Kab!nettschrank."), (51, "c0", "Kab1nettschrank.", None), (52, "c0", "Kabinettschrank.", None)]
    df = spark.createDataFrame(rows, "chunk_id bigint, catalogue_id string, title string, text string")
    got = {(r.chunk_id, r.field, r.noise, r.span) for r in scan_noise.scan_noise(df).collect()}
    assert got == {(50, "text", "misread", "Kabinettschrank"), (50, "title", "misread", "Kabinettschrank"), (51, "title", "misread", "Kabinettschrank")}


def test_repair_scans(spark):  # noqa: ANN001, ANN201
    got = {r.chunk_id: r.repaired_text for r in scan_noise.repair_scans(scans(spark)).collect()}
    assert got[100] == "1 - Une soupière.\n\nLe pied, en cuivre repoussé, repose sur quatre griffes et porte encore palmettes.\n\n1636."
    assert got[104] is None and got[105] == "" and len(got) == 66


@pytest.mark.parametrize(("line", "is_number"), [("- 34 -", True), ("(140)", True), ("Seite 12", True), ("182 .", True), ("~ 20 ~", True), ("[97]", True), ("121", True), ("1636.", False), ("(1716)", False), ("Mk. 318", False), ("332 fr.", False), ("39 × 44", False), ("(12", False)])
def test_page_numbers(spark, line, is_number):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(scan_noise.page_number_line(df["line"])).first()[0] == is_number


FR = "Le pied en cuivre repose sur quatre griffes et porte encore une guirlande dans le goût du temps."
DE = "Der Fuß besteht aus vergoldetem Holz und ist mit Blattranken und Masken an den Ecken verziert."
LA = "Hic iacet virgo prudens, cuius fama per omnes terras volavit et adhuc vivit."


def test_language_spans(spark):  # noqa: ANN001, ANN201
    rows = [(i, f"1 - Titel\n\n{FR} {FR}", "fre") for i in range(20)] + [(i, f"1 - Titre\n\n{DE} {DE}", "ger") for i in range(20, 40)] + [(i, f"1\n\n{LA}", "la") for i in range(40, 50)]
    rows += [(60, f"1 - T\n\n{FR}\n\n{DE} {LA}\n\n{FR}\n\nToile. Haut., 3 cent.", "fr"), (61, f"1\n\n{DE}", "fr"), (62, f"1\n\n{DE}", None), (63, None, None), (64, "", "de"), (65, "1 - X\n\n## NAME\n\n(OTTO)", "?"), (66, f"1\n\n{FR}", "und"), (67, f"1\n\n{FR}", "FRA")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "chunk_id bigint, text string, lang_label string, lang int")
    spans = languages.language_spans(df)
    got = sorted((r.chunk_id, r.seg_no, r.lang) for r in languages.mislabelled(spans).collect())
    assert got == [(60, 1, "fr"), (60, 2, "de"), (60, 3, "la"), (60, 4, "fr"), (61, 1, "de"), (62, 1, "de"), (66, 1, "fr")]
    assert all(0 < r.confidence <= 1 for r in spans.collect())
    assert languages.language_spans(df.limit(0)).isEmpty()


def test_viterbi_is_best_path():  # noqa: ANN201
    chance = random.Random(6)
    langs = languages.LATIN
    for _ in range(30):
        model = languages.Model({w: tuple(chance.uniform(-2, 2) for _ in langs) for w in "abcdef"})
        text = [[chance.choice("abcdef") for _ in range(chance.randint(1, 2))] for _ in range(3)]
        got = [lang for lang, _ in languages.viterbi(text, model)]

        def score(path):  # noqa: ANN001, ANN202
            total = sum(model.of(w)[lang] for words, lang in zip(text, path, strict=True) for w in words)  # noqa: B023
            return total - languages.SWITCH * sum(a != b for a, b in itertools.pairwise(path))

        assert score(got) == pytest.approx(max(score(p) for p in itertools.product(langs, repeat=3)))


def test_paths_by_sentence_and_by_word_agree():  # noqa: ANN201
    """Where no switch inside a sentence can pay, the quick walk over sentences gives the walk over words."""
    chance = random.Random(7)
    slow = 0
    for _ in range(200):
        scores = {w: tuple(chance.uniform(-3, 2) for _ in languages.LATIN) for w in "abcdefgh"}
        model = languages.Model(scores)
        text = [[chance.choice("abcd" if chance.random() < 0.5 else "efgh") for _ in range(chance.choice((2, 5, 40)))] for _ in range(4)]
        rows = [languages.np.array([model.table[languages.cell(w)] for w in words]) for words in text]
        if any(languages._may_switch_inside(x) for x in rows):
            slow += 1
            continue
        sums = [x.sum(axis=0, dtype=float).tolist() for x in rows]
        path = languages.latin_path(sums)
        expected = languages.viterbi(text, model)
        assert [languages.LATIN[i] for i in path] == [lang for lang, _ in expected]
        assert [languages._confidence(s, i, len(w), len(w)) for s, i, w in zip(sums, path, text, strict=True)] == pytest.approx([c for _, c in expected], abs=1e-4)
    assert slow < 150


def test_confidence_tells_how_often_a_sentence_is_right():  # noqa: ANN201
    """Words drawn from two languages that overlap: the share of right sentences grows with the confidence."""
    chance = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    fr, de = ([1.0 / (1 + abs(i - m)) for i in range(40)] for m in (12, 28))
    scores = {}
    for i, w in enumerate(words):
        logs = [languages.math.log(fr[i]), languages.math.log(de[i]), *[languages.math.log(0.01)] * 4]
        scores[w] = tuple(max(-5.0, x - max(logs)) for x in logs)
    model = languages.Model({w: tuple(x - sum(v) / 6 for x in v) for w, v in scores.items()})
    bands: dict[bool, list[bool]] = {True: [], False: []}
    for _ in range(600):
        lang, weights = chance.choice((("fr", fr), ("de", de)))
        [(got, confidence)] = languages.viterbi([chance.choices(words, weights, k=5)], model)
        bands[confidence >= 0.7].append(got == lang)
    high, low = (sum(x) / len(x) for x in (bands[True], bands[False]))
    assert len(bands[True]) > 50 < len(bands[False]) and high > 0.9 and high > low + 0.05


def test_scripts_narrow_candidates():  # noqa: ANN201
    model = languages.Model({})
    assert [x for x, _ in languages.viterbi([["высота"], ["高", "さ"], ["สูง"]], model)][::2] == ["ru", "th"]

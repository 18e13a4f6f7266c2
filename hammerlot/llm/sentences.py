"""Sentence boundaries by cascading tables of break and no-break rules.

A rule is a pair of regular expressions, one for the text before a position and one for the text after it, with the
verdict "break" or "no break". Tables are ordered and cascade: the table of the script in front of the position, then
the tables of the languages written in that script (the document's own language first, since its label may be wrong
and texts change language), then the default table. The first rule that matches decides the position.

Positions that the rules judge are the ends of stop signs (with closing quotes and brackets) and, in Thai, white space.
Blank lines and list lines end a sentence before any rule is asked; quotations and brackets are kept whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerlot.plans.parallelism import spread


@dataclass(frozen=True)
class Rule:
    """``before`` must match up to the position, ``after`` from it on; ``breaks`` is the verdict."""

    before: str
    after: str
    breaks: bool
    quoted: bool = False


@dataclass(frozen=True)
class Compiled:
    before: re.Pattern[str]
    after: re.Pattern[str]
    breaks: bool
    quoted: bool


def rule(before: str, after: str, breaks: bool, quoted: bool = False) -> Rule:
    """``quoted``: ``before`` holds a whole quotation; other rules hold a word or number and the signs behind it."""
    return Rule(before, after, breaks, quoted)


def compiled(rules: list[Rule]) -> tuple[Compiled, ...]:
    """Rules ready to run: within a stretch of one verdict, those with the same ``after`` become one alternation.

    Inside such a stretch the order has no effect on the verdict, so first match still decides.
    """
    out: list[Compiled] = []
    stretch: dict[tuple[str, bool], list[str]] = {}
    verdict = None
    for r in [*rules, None]:
        if r is None or r.breaks != verdict:
            out += [Compiled(re.compile(rf"(?:{'|'.join(x)})\Z"), re.compile(after), bool(verdict), quoted) for (after, quoted), x in stretch.items()]
            stretch = {}
        if r is not None:
            verdict = r.breaks
            stretch.setdefault((r.after, r.quoted), []).append(r.before)
    return tuple(out)


def abbreviations(always: str, before_number: str = "") -> list[Rule]:
    """No-break rules: words that take a period and never end a sentence, and words that do so only before a number."""
    rules = []
    if always:
        rules.append(rule(rf"(?<![^\W_])(?:{'|'.join(always.split())})\.", r"\s*\S", False))
    if before_number:
        rules.append(rule(rf"(?<![^\W_])(?:{'|'.join(before_number.split())})\.", r"\s*(?:\d|[IVXLC]+\b)", False))
    return rules


# Abbreviations of each language as regular expressions, blank-separated.
ABBREVIATIONS: dict[str, tuple[str, str]] = {
    "de": (
        r"[Dd]r [Pp]rof Hr Hrn Fr Frl Frhr St Hl hl sel Sel geb Gebr lt Lt [Vv]gl vgl z Z d u\.\s?a u\.\s?A i [Nn]rn? Bd Bde Bdn Taf Tafn Abb [Kk]at gen sog bzw ca vorm nachm Ing Dipl [Ss]tr insbes evtl",
        r"S Art Kap Los Fig Sp H Jan Feb Febr Mär Apr Aug Sept Okt Nov Dez Jg u ff? um Anm Z",
    ),
    "fr": (
        r"M MM Mme Mmes Mlle Mlles Mgr Me Mes Dr Pr St Ste Sts Vve cf Cf p\.\s?ex [ée]d [Éé]d anc env [Bb]d av\.\s?J",
        r"pp? pl planche fig n no nos t vol f fol ff art chap janv f[ée]vr avr juill sept oct nov d[ée]c h fr suppl",
    ),
    "it": (
        r"[Ss]ig [Ss]igg sig\.ra [Dd]ott [Pp]rof [Aa]vv [Cc]av [Cc]omm [Ii]ng [Aa]rch on mons cfr Cfr es p\.\s?es [Ss]ecc? ca ed S SS",
        r"pp? tavv? figg? voll? n nn nr L art cap genn? febbr? mar apr magg? giu lugl? ag sett? ott nov dic ff? m",
    ),
    "en": (
        r"Mr Mrs Ms Messrs Dr Prof Capt Col Gen Lt Maj Sgt Rev Hon St Sts cf Cf vs viz e\.\s?g i\.\s?e Esq approx",
        r"[Nn]os? pp? pl pls fig figs vol vols ed eds c ca ch sec Jan Feb Mar Apr Jun Jul Aug Sept? Oct Nov Dec ff? art",
    ),
    "nl": (
        r"dhr Dhr mevr Mevr mej mr Mr dr Dr prof Prof ir jhr Jhr St vgl Vgl nrs? Nrs? o\.\s?a d\.\s?w\.\s?z bijv bv m\.\s?a\.\s?w resp zgn ca",
        r"pll? dln? blz bl p f fl afb hfst jan febr mrt apr aug sept okt nov dec u",
    ),
    "ru": (r"т\.\s?е т\.\s?к [Гг]р? гг? им акад проф [Сс]м [Сс]р ул просп", r"[Сс]тр рис табл с н[оº]? руб коп илл г кн вып т"),
    "el": (r"[Κκ] [Κκ]α [Κκ]ος Δρ [Αα]γ π\.\s?χ [Ββ]λ", r"σελ εικ αρ τ [Ππ]ίν"),
}

#: Script of a letter by range, as a fixed order of tests; the first that matches names the table.
SCRIPTS = (
    ("thai", re.compile(r"[฀-๿]")),
    ("cjk", re.compile(r"[぀-ヿ㐀-鿿豈-﫿가-힯]")),
    ("indic", re.compile(r"[ऀ-෿]")),
    ("arabic", re.compile(r"[֐-ࣿיִ-﷿ﹰ-﻿]")),
    ("cyrillic", re.compile(r"[Ѐ-ԯ]")),
    ("greek", re.compile(r"[Ͱ-Ͽἀ-῿]")),
    ("latin", re.compile(r"[A-Za-zÀ-ɏḀ-ỿ]")),
)
SCRIPT_LANGUAGES = {"latin": ("de", "fr", "it", "en", "nl"), "cyrillic": ("ru",), "greek": ("el",)}

_UPPER = "A-ZÀ-ÖØ-ÞΑ-ΫΆ-ΏА-ЯЁ"
_LOWER = "a-zß-öø-ÿά-ώа-џ"
_MONTH = r"(?:Jan|Feb|Mär|Apr|Mai|Jun|Jul|Aug|Sep|Okt|Nov|Dez|Jahrh|Jh|Jhs|Jhd)"

SCRIPT_RULES: dict[str, list[Rule]] = {
    "thai": [
        rule(r".", r"\s*(?:\d|[๐-๙])", False),
        rule(r"[\d๐-๙]", r"\s+(?:เซนติเมตร|มิลลิเมตร|เมตร|นิ้ว|ซม|ม\.|บาท|กิโลกรัม|กรัม|ชิ้น(?!นี้)|รายการ|คน|วัน|เดือน|พ\.ศ|ค\.ศ|หน้า(?=\s*\d))", False),
        rule(r".", r"\s+(?:กว้าง|ยาว|ลึก|หนา|และ|หรือ|แต่|ซึ่ง|โดย|จึง|เพราะ|ๆ|ฯ)", False),
        rule(r"[,;:ๆ–—-]", r"\s", False),
        rule(r"(?:นาย|นาง|นางสาว|ดร\.|พ\.ศ\.|ค\.ศ\.|น\.)", r"\s", False),
        rule(r".", r"\s+[฀-๿" + _UPPER + r"\"“«(]", True),
        rule(r".", r"\s*", False),
    ],
    "cjk": [
        rule(r"[:：]\s*[“「『\"«][^“「『]*[。！？!?…][”」』\"»]+", r"\s*\S", True, quoted=True),
        rule(r"[。！？!?…][”」』\"»]+", r"\s*[぀-ヿ㐀-鿿，、]", False),
        rule(r"[。！？!?…][”’」』）)\]\"»]*", r"", True),
        rule(r"\.[”’」』）)\]\"»]*", r"\s+\S", True),
        rule(r".", r"", False),
    ],
    "indic": [
        rule(r"[।॥?!…][”’\"»)\]]+", r"\s*(?:और|तथा|एवं|लेकिन|परन्तु|कहकर|कह|ऐसा|यों)", False),
        rule(r"[।॥?!…][”’\"»)\]]*", r"", True),
        rule(r"\.", r"", False),
    ],
    "arabic": [
        rule(r"(?<!\w)[ء-ي]\.", r"\s", False),
        rule(r"[.؟?!…۔][”’\"»«)\]]*", r"\s+[,،؛:]", False),
        rule(r"[.؟?!…۔][”’\"»«)\]]+", r"\s+(?:و\S|ثم\b|فقال|قال)", False),
        rule(r"[.؟?!…۔][”’\"»«)\]]*", r"\s", True),
        rule(r"[؟?!۔][”’\"»«)\]]*", r"", True),
        rule(r".", r"", False),
    ],
    "greek": [rule(r"[;·][”’\"»)\]]*", rf"\s*[{_UPPER}«“\"(]|\s*$", True), rule(r"[;·]", r"", False)],
    "cyrillic": [],
    "latin": [
        # German ordinals: a number of one or two digits with a period is no end before a month or after an article.
        rule(r"(?<!\d)\d{1,2}\.", rf"\s+{_MONTH}", False),
        rule(r"(?:\b[Dd](?:er|ie|as|es|em|en)|\b(?:[Aa]m|[Vv]om|[Zz]um|[Ii]m|[Bb]eim|[Zz]ur|und|oder|bis))\s+\d{1,2}\.", r"\s+\S", False),
    ],
}

DEFAULT_RULES: list[Rule] = [
    # Initials: one capital with a period.
    rule(rf"(?<![^\W_])(?<!\d)[{_UPPER}]\.", r"\s*\S", False),
    # The running sentence goes on in lower case, or with a comma or dash.
    rule(r".", rf"\s*[{_LOWER}]", False),
    rule(r".", r"\s*[,;:/]", False),
    rule(r".", rf"\s+[—–-]+\s*[{_LOWER}]", False),
    rule(r"\d\.", r"\d", False),
    rule(r".", r"\s", True),
    # No space after the stop: a break if a word of at least two letters ends and a capital or an opening sign follows.
    rule(rf"(?:[{_LOWER}]{{2}}|\d{{2}}|[)\]»“”\"’]|\s)[.!?…]+[\]»«“”\"’)]*", rf"[{_UPPER}«»„“\"(]", True),
    rule(rf"[^\W\d_]{{2}}[.!?…]+[\]»«“”\"’)]*", r"(?:[^\W\d_])", True),
    rule(r"[!?…]", r"[^\W\d_]", True),
    rule(r"\d\.[\]»«“”\"’)]*", r"(?:[^\W\d_])", True),
    rule(r".", r"", False),
]

LANGUAGE_RULES = {lang: abbreviations(*words) for lang, words in ABBREVIATIONS.items()}
_CASCADES: dict[tuple[str, str], tuple[Compiled, ...]] = {}


def cascade(script: str, lang: str) -> tuple[Compiled, ...]:
    """The rules in force after a letter of ``script`` in a document labelled ``lang``."""
    key = (script, lang)
    if key not in _CASCADES:
        rules = list(SCRIPT_RULES.get(script, ()))
        languages = SCRIPT_LANGUAGES.get(script, ())
        for name in sorted(languages, key=lambda name: name != lang):
            rules += LANGUAGE_RULES[name]
        _CASCADES[key] = compiled([*rules, *DEFAULT_RULES])
    return _CASCADES[key]


_BLOCK = re.compile(r"\n[^\S\n]*\n\s*|\r\n[^\S\n]*\r\n\s*")
_LIST_LINE = re.compile(r"^[-•*–]\s+\S")
_STOP = re.compile(r"[.!?…。！？।॥؟۔;·]+")
_CLOSERS = re.compile(r"[\"”’»“«)\]}』」）〕]+")
_SPANS = re.compile(
    r"„[^“”„\"]*[“”\"]|“[^”“]*”|«[^»«]*»|»[^«»]*«|「[^」]*」|『[^』]*』|（[^）]*）|\((?:[^()]|\([^()]*\))*\)|\[[^\[\]]*\]"
    r"|(?<![\w.,!?])\"(?=\S)[^\"]*\""
)
_THAI_GAP = re.compile(r"(?<=[฀-๿0-9A-Za-z.!?\"”)])[^\S]+(?=\S)")


def _script_before(text: str, end: int, start: int) -> str | None:
    """Script of the last letter between ``start`` and ``end``, None if there is none."""
    for i in range(end - 1, start - 1, -1):
        char = text[i]
        if char.isalpha() or "ऀ" <= char <= "๿":
            if char < "ɐ":
                return "latin"
            for name, pattern in SCRIPTS:
                if pattern.match(char):
                    return name
            return "latin"
    return None


#: Letters that the longest word of a rule may have; the signs, digits and blanks behind it come on top, however many.
_WORD_LETTERS = 24
_SIGNS = frozenset(".!?…。！？।॥؟۔;·\"”’»“«)]}』」）〕")
_NOTHING = re.compile(r"\s*\Z")


def _word_start(text: str, position: int, start: int, walked: list[int] | None = None) -> int:
    """Where the word in front of ``position`` may begin: before its signs, its digits and the blanks before these.

    ``walked`` keeps the last position and the start of its signs, so that a long run of signs is walked over once.
    """
    at = position
    while at > start and text[at - 1] in _SIGNS:
        at -= 1
        if walked and at == walked[0]:
            at = walked[1]
            break
    if walked is not None:
        walked[:] = position, at
    while at > start and text[at - 1].isdigit():
        at -= 1
    while at > start and text[at - 1].isspace():
        at -= 1
    return max(start, at - _WORD_LETTERS)


def _quotation_start(text: str, position: int, start: int) -> int:
    """The last opening quotation mark before ``position``, with the blanks and the one sign before it."""
    at = max(text.rfind(mark, start, position) for mark in "“「『")
    if at < 0:
        return start
    while at > start and text[at - 1].isspace():
        at -= 1
    return max(start, at - 1)


def _decide(text: str, position: int, start: int, end: int, lang: str, script: str, walked: list[int]) -> bool:
    if _NOTHING.match(text, position, end):
        return True
    word = quotation = -1
    for r in cascade(script, lang):
        if not r.after.match(text, position, end):
            continue
        if r.quoted:
            if quotation < 0:
                quotation = _quotation_start(text, position, start)
            begin = quotation
        else:
            if word < 0:
                word = _word_start(text, position, start, walked)
            begin = word
        if r.before.search(text, begin, position):
            return r.breaks
    return False


def _split_span(text: str, start: int, end: int, lang: str) -> Iterator[int]:
    """Ends of the sentences of one block that holds no blank line and no list line."""
    piece = text[start:end]
    spans = [(start + m.start(), start + m.end()) for m in _SPANS.finditer(piece)]
    ends: set[int] = set()
    k = 0
    # Script of the last letter so far; each letter is looked at once.
    script, scanned, walked = "latin", start, [start, start]
    for m in _STOP.finditer(text, start, end):
        position = m.end()
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        inside = k < len(spans) and spans[k][0] < m.start() < spans[k][1]
        if inside:
            # Only a stop that is the last thing in the quotation or bracket may end the sentence around it.
            rest = text[position : spans[k][1]]
            if rest.strip("   \t\n\"”’»“«)]}』」）") or not rest:
                continue
            position = spans[k][1]
        closing = _CLOSERS.match(text, position, end)
        if closing and not any(s == position for s, _ in spans[k : k + 2]):
            position = closing.end()
        if m.group()[0] in ";·" and (_script_before(text, m.start(), scanned) or script) != "greek":
            continue
        if position > scanned:
            script, scanned = _script_before(text, position, scanned) or script, position
        if _decide(text, position, start, end, lang, script, walked):
            ends.add(position)
    if "฀" <= max(piece, default="") and re.search(r"[฀-๿]", piece):
        script, scanned, k, walked = "latin", start, 0, [start, start]
        for m in _THAI_GAP.finditer(text, start, end):
            while k < len(spans) and spans[k][1] <= m.start():
                k += 1
            if k < len(spans) and spans[k][0] < m.start() < spans[k][1]:
                continue
            script, scanned = _script_before(text, m.start(), scanned) or script, m.start()
            if script == "thai" and _decide(text, m.start(), start, end, lang, script, walked):
                ends.add(m.start())
    yield from sorted(ends)
    if not ends or text[max(ends) : end].strip():
        yield end


def sentence_ends(text: str | None, lang: str | None = None) -> list[int]:
    """Offsets (in characters) just behind the last character of each sentence of ``text``.

    A null or blank text has none. ``lang`` only orders the rule tables, so a wrong label changes little.
    """
    if not text or not text.strip():
        return []
    found: list[int] = []
    at = 0
    for m in [*_BLOCK.finditer(text), None]:
        stop = m.start() if m else len(text)
        for start, end in _lines(text, at, stop):
            found += _split_span(text, start, end, lang or "")
        at = m.end() if m else stop
    out = []
    for end in found:
        while end and text[end - 1].isspace():
            end -= 1
        if end and (not out or end > out[-1]) and text[out[-1] if out else 0 : end].strip():
            out.append(end)
    return out


def _lines(text: str, start: int, end: int) -> Iterable[tuple[int, int]]:
    """Cut a block at its list lines; the rest stays together, since single line breaks are no ends."""
    block = text[start:end]
    if "\n" not in block or not re.search(r"(?m)^[-•*–]\s+\S", block):
        return [(start, end)]
    out: list[list[int]] = []
    at, previous_list = start, False
    for line in block.splitlines(keepends=True):
        is_list = bool(_LIST_LINE.match(line)) and (previous_list or not out or text[: at].rstrip()[-1:] in ".!?…:;»”“\")" or at == start)
        if is_list or not out or previous_list and not line.startswith((" ", "\t")):
            out.append([at, at + len(line)])
        else:
            out[-1][1] = at + len(line)
        at += len(line)
        previous_list = is_list
    return [(a, b) for a, b in out]


def split_sentences(df: DataFrame, text: str = "text", lang: str | None = "lang", key: str = "doc_id") -> DataFrame:
    """One row ``(key, sent_no, sent_start, sent_end, sentence)`` per sentence of every document.

    Null and blank texts give no row; repeated rows and repeated keys are each split on their own; other columns are
    ignored, whatever their names. ``lang`` may be null, wrong, or left out. Whole texts are read; one Arrow pass, no
    shuffle beyond an optional spreading of a scan with too few partitions.
    """
    label = F.lower(F.col(lang)) if lang else F.lit(None).cast("string")
    key_type = df.schema[key].dataType.simpleString()
    source = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text"), label.alias("lang")).where(F.col("text").isNotNull()))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, numbers, starts, ends, sentences = [], [], [], [], []
            for k, body, language in zip(batch["key"], batch["text"], batch["lang"], strict=True):
                at = 0
                for number, end in enumerate(sentence_ends(body, language), 1):
                    while body[at].isspace():
                        at += 1
                    keys.append(k)
                    numbers.append(number)
                    starts.append(at)
                    ends.append(end)
                    sentences.append(body[at:end])
                    at = end
            if keys:
                yield pd.DataFrame({"key": keys, "sent_no": numbers, "sent_start": starts, "sent_end": ends, "sentence": sentences})

    out = source.mapInPandas(split, f"key {key_type}, sent_no int, sent_start bigint, sent_end bigint, sentence string")
    return out.withColumnRenamed("key", key)

"""A quick guess of a text's main language from its scripts and function words, in built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequent function words, blank-separated, and script ranges.
WORDS = {
    "fr": "le la les des du une est dans sur avec par cette qui",
    "de": "der die das den dem des ein eine und ist mit von auf",
    "it": "il lo gli di della dei delle una nel con per che sono",
    "en": "the of and to in is was with for by from this that",
    "nl": "het een van en met op te voor door aan zijn werd",
}
SCRIPTS = {"ja": r"[぀-ヿ]", "zh": r"[一-鿿]", "th": r"[฀-๿]", "hi": r"[ऀ-ॿ]", "ar": r"[؀-ۿ]", "ru": r"[Ѐ-ӿ]", "el": r"[Ͱ-Ͽ]"}


_LATIN = r"[A-Za-zÀ-ɏ]"


def detect_language(text: Column) -> Column:
    """ISO 639-1 code of the main language; null for a null or blank text and where nothing speaks for any language.

    A script with at least a third as many letters as Latin decides; else the language whose function words are most
    frequent, ties in the order of ``WORDS``. Every word and letter is looked at once: a Latin text's words are looked up
    in one map, and scripts are only counted in texts that have a letter beyond Latin.
    """
    masks = F.create_map(*[F.lit(x) for w, langs in _by_word().items() for x in (w, langs)])
    words = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)), lambda w: F.coalesce(F.element_at(masks, w), F.lit("")))
    signs, langs = (F.array(*[F.lit(x) for x in xs]) for xs in (_SIGNS.values(), WORDS))

    def most_voted(votes: Column) -> Column:
        counts = F.transform(signs, lambda sign: F.length(votes) - F.length(F.replace(votes, sign, F.lit(""))))
        return F.when(votes != "", _once(counts, lambda c: F.element_at(langs, F.array_position(c, F.array_max(c)).cast("int"))))

    by_words = _once(F.array_join(words, ""), most_voted)

    def by_script(latin: Column) -> Column:
        guess = F.lit(None).cast("string")
        for lang, letters in reversed(SCRIPTS.items()):
            guess = F.when(text.rlike(letters) & (F.regexp_count(text, F.lit(letters)) * 3 > latin), F.lit(lang)).otherwise(guess)
        return guess

    other = F.when(text.rlike("[" + "".join(x[1:-1] for x in SCRIPTS.values()) + "]"), _once(F.greatest(F.regexp_count(text, F.lit(_LATIN)), F.lit(1)), by_script))
    return F.when(text.isNotNull() & (F.length(F.trim(text)) > 0), F.coalesce(other, by_words))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: One sign per language, in the order that breaks ties.
_SIGNS = {lang: chr(ord("a") + i) for i, lang in enumerate(WORDS)}


def _by_word() -> dict[str, str]:
    """Each function word and the signs of the languages that have it."""
    signs: dict[str, str] = {}
    for lang, words in WORDS.items():
        for word in words.split():
            signs[word] = signs.get(word, "") + _SIGNS[lang]
    return signs

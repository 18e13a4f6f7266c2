"""Controlled vocabularies: codes that labels of the sheets map to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Labels and codes must equal the published ones for results to be right. They stand in their natural
# order; misspelt labels that occur in the data are keys of their own. Labels without a code are left out, since a
# missing key and an empty code mean the same.
LANGUAGES = {"ger": "de", "fre": "fr", "ita": "it", "eng": "en", "abs": "it"}

ROLES = {
    "commissaire-priseur": "300025208",
    "perito antiquario": "300025827",
    "casa d'aste": "300417515",
    "mercante d'arte": "300386253",
    "storico dell'arte?": "300025541",
    "esperto": "300025829",
}

PERIODS = {
    "Sec. XV/ XVI": ["300404465", "300404510"],
    "Sec. XV/ XVIII": ["300404465", "300404510", "300404511", "300404512"],
    "Sec. XIV/ XV": ["300404506", "300404465"],
    "Sec. XIV/ XVI": ["300404506", "300404465", "300404510"],
    "Sec. XV/ XIX": ["300404465", "300404510", "300404512", "300404513"],
    "Sec. XVI/ XVIII": ["300404510", "300404511", "300404512"],
    "Sec. XVI/ XIX": ["300404510", "300404511", "300404512", "300404513"],
    "Sec. XVIII": ["300404512"],
    "Sec. XVII/ XVIII": ["300404511", "300404512"],
    "Sec. XIV/ XVIII": ["300404506", "300404465", "300404510", "300404511", "300404512"],
    "Sec. XVI/ XVII": ["300404510", "300404511"],
    "Sec. XVI/ XX": ["300404510", "300404511", "300404512", "300404513", "300404514"],
    "Sec. XV/ XVII": ["300404465", "300404510", "300404511"],
    "Sec. XVI/ IX": ["300404510", "300404511", "300404512", "300404513"],
    "Sec. XIX": ["300404513"],
    "Sec. XIV/ XIX": ["300404506", "300404465", "300404510", "300404511", "300404512", "300404513"],
    "Sec. XVII/ XIX": ["300404511", "300404512", "300404513"],
    "Sec. XVI": ["300404510"],
    " Sec. XVII/ XVIII": ["300404511", "300404512"],
    "Sec. XIV/ XVII": ["300404506", "300404465", "300404510", "300404511"],
    "SeC. XVI/ XVIII": ["300404510", "300404511", "300404512"],
    "Sec. XIX/ XX": ["300404513", "300404514"],
    "Sec. XIII/ XVII": ["300404505", "300404506", "300404465", "300404510", "300404511"],
    "Sec. XVII": ["300404511"],
    "Sec. XVI/ XIX ": ["300404510", "300404511", "300404512", "300404513"],
    "Sec. XVIII/ XIX": ["300404512", "300404513"],
    " Sec. XV/ XVII": ["300404465", "300404510", "300404511"],
    "Sec. XIII/ XVIII": ["300404505", "300404506", "300404465", "300404510", "300404511", "300404512"],
    "Sec. XII/ XIX": ["300404504", "300404505", "300404506", "300404465", "300404510", "300404511", "300404512", "300404513"],
    "Sec. X/ XVI": ["300404502", "300404503", "300404504", "300404505", "300404506", "300404465", "300404510"],
    "Sec. XVI / XIX": ["300404510", "300404511", "300404512", "300404513"],
    "Sec. XV/ XX": ["300404465", "300404514"],
    "SeC. XIX": ["300404513"],
    "Sec. XV/ XVIIII": ["300404465", "300404510", "300404511", "300404512"],
    "Sec. IV": ["300404496"],
    "Sec. XIII/ XIX": ["300404505", "300404506", "300404465", "300404510", "300404511", "300404512", "300404513"],
    "Sec. XII/ XIII": ["300404504", "300404505"],
}

OBJECT_TYPES = {
    "DIPINTI": "300033618",
    "OGGETTI D'ARTE": "300133005",
    "SCULTURE": "300047090",
    "DISEGNI": "300033973",
    "LIBRI": "300028051",
    "TESSUTI": "300231565",
    "MOBILI": "300037680",
    "MEDAGLIE": "300046025",
    "VETRI": "300206140",
    "ARMI": "300036926",
    "STAMPE": "300041273",
    "CERAMICHE": "300010666",
    "MINIATURE": "300404587",
    "ARAZZI": "300205002",
    "MAIOLICHE": "300021170",
    "STRUMENTI MUSICALI": "300041620",
    "DIPNTI": "300033618",
    "SMALTI": "300178264",
    "AVORII": "300047325",
    "REPERTI ARCHEOLOGICI": "300234110",
    "MONETE": "300037222",
    "ARGENTI": "300234016",
    "GIOIELLI": "300209286",
    "ABITI": "300266639",
    "STOFFE": "300231565",
    "OROLOGI": "300041615",
    "ARCHEOLOGIA": "300234110",
    "GGETTI D'ARTE": "300133005",
    "ARGENTERIE": "300234016",
    "DIPINTI Sec. 19.": "300033618",
    "MANOSCRITTI": "300265483",
    "SCUTURE": "300047090",
    "STRUMENTI SCIENTIFICI": "300122283",
    "DIESEGNI": "300033973",
    "DIPINTI Sec. 18.": "300033618",
    "CERARMICHE": "300010666",
    "LETTERE": "300026879",
    "FERRO BATTUTO": "300011012",
    "VINI": "300379442",
    "DIPINIT": "300033618",
    "INCISIONI": "300041340",
    "TAPPETI": "300185756",
    "AVORI": "300047325",
    "DISRGNI": "300033973",
    "VETRI ISTORIATI": "300206140",
    "PITTURA": "300033618",
    "0GGETTI D'ARTE": "300133005",
    "QUADRI": "300404391",
    "VASI": "300132254",
    "PORCELLANE": "300010662",
    "MAIOLICHE DI DELFT": "300021170",
    "DIPINTI Sec. 19.-20.": "300033618",
    "DISEGNI Sec. 19.-20.": "300033973",
    "DIPINTI Sec. 18.-20.": "300033618",
    "DISEGNI Sec. 18.-20.": "300033973",
    "DIPINTI Sec. 17.-18.": "300033618",
    "DISEGNI Sec. 16.-19.": "300033973",
    "DIPINTI Sec. 15.-16.": "300033618",
    "SCULTURE Sec. 13.-16.": "300047090",
    "MINIATURE Sec. 13.-15.": "300404587",
    "OGGETTI D'ARTE Sec. 18.-20.": "300133005",
    "DIPINTI Sec. 14.-17.": "300033618",
    "DIPINTI Sec. 16.-19.": "300033618",
    "ARMATURE": "300036745",
    "BRONZI Sec. 14.-18.": "300047333",
    "PITTURA Sec. 19.-20.": "300033618",
    "OGGETTI D'ARTE Sec. 14-16.": "300133005",
    "OGGETTI D'ARTE Sec. 14.-16.": "300133005",
    "OGGETTI D'ARTE Sec. 16.-18.": "300133005",
    "DIPINTI Sec. 15.-19.": "300033618",
    "SCULTURA Sec. 19.-20.": "300047090",
    "DIPINTI NAPOLETANI": "300033618",
    "DIPINTI Sec. 16.-18.": "300033618",
    "DIPINTI Sec. 16.-20.": "300033618",
    "CORINTH, LOVIS": "300033618",
    "PITTURA Sec. 16.-19.": "300033618",
    "ACQUERELLI Sec. 19.-20.": "300078925",
    "DIPINTI Sec. 20.": "300033618",
    "DISEGNI Sec. 20.": "300033973",
    "ARREDAMENTO Sec. 20.": "300037680",
    "OGGETTI D'ARTE Sec. 15.-18.": "300133005",
    "MAIOLICHE ITALIANE Sec. 15.-16.": "300021170",
    "ACQUARELLI Sec. 19.-20.": "300078925",
    "PITTURA Sec. 19.-20": "300033618",
    "PITTURA Sec. 16.-18.": "300033618",
    "PORCELLANE DI DOCCIA Sec. 18.": "300010662",
    "OPERE D'ARTE": "300133005",
    "ARREDAMENTO": "300037680",
    "SCULTURE IN LEGNO Sec. 14.-18.": "300047090",
}

#: Role of an auctioneer whose stated role is not listed; role of an author; type of a sale, of a catalogue.
AUCTIONEER, AUTHOR_ROLE, SALE_TYPE, CATALOGUE_TYPE = "300025208", "300025492", "300054751", "300026068"


def rows(vocabulary: dict) -> list[tuple[str, str]]:
    """``(label, code)`` rows of a vocabulary; a label with several codes gives several rows."""
    return [(label, code) for label, codes in vocabulary.items() for code in ([codes] if isinstance(codes, str) else codes)]


def table(spark: SparkSession, vocabulary: dict) -> DataFrame:
    """A vocabulary as a frame ``(label, code)``; it is fixed in size, so joins may broadcast it."""
    return spark.createDataFrame(rows(vocabulary), "label string, code string")


def values_sql(vocabulary: dict) -> str:
    """The rows as a SQL ``VALUES`` list, the same in both dialects."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    return "(VALUES " + ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in rows(vocabulary)) + ")"

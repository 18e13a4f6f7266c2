"""Scalar text functions as SQL expressions, and as Columns.

Every function takes the SQL text of its argument and returns SQL text, in Spark's dialect by default. The second
dialect serves the checks, which run the same definitions on another engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the scripting language of the data's makers strips as white space: more than a regular expression's ``\\s``.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
#: Characters that a word may hold besides ``_`` and ``-``.
WORD = r"\p{L}\p{N}"

# Folded letters, and characters that a slug leaves out or replaces.
FOLDED_FROM, FOLDED_TO = "àèéìòùÀÈÉÌÒÙ/\\", "aeeiouAEEIOU__"
LEFT_OUT = "'\"‘’()[]{},;:.!?"


def literal(text: str, dialect: str = "spark") -> str:
    """A string literal that keeps backslashes; quotes must not occur in ``text`` (write them as ``\\x27``)."""
    if "'" in text:
        raise ValueError("write a quote in a pattern as \\x27")
    return ("r" if dialect == "spark" else "") + f"'{text}'"


def replace_all(x: str, pattern: str, by: str, dialect: str = "spark") -> str:
    tail = "" if dialect == "spark" else ", 'g'"
    return f"regexp_replace({x}, {literal(pattern, dialect)}, {literal(by, dialect)}{tail})"


def extract(x: str, pattern: str, group: int, dialect: str = "spark") -> str:
    return f"regexp_extract({x}, {literal(pattern, dialect)}, {group})"


def matches(x: str, pattern: str, dialect: str = "spark") -> str:
    return f"({x} RLIKE {literal(pattern, dialect)})" if dialect == "spark" else f"regexp_matches({x}, {literal(pattern, dialect)})"


def strip(x: str, dialect: str = "spark") -> str:
    """Without white space at both ends, Unicode white space included."""
    return replace_all(x, rf"\A{SPACE}+|{SPACE}+\z", "", dialect)


def slug(x: str, dialect: str = "spark") -> str:
    """Identifier made of a label: stripped, blanks to ``_``, some accents folded, signs left out, lower case. Null stays null."""
    chars = LEFT_OUT.replace("'", "''" if dialect != "spark" else "\\'")
    origin = FOLDED_FROM if dialect != "spark" else FOLDED_FROM.replace("\\", "\\\\")
    folded = f"translate(replace({strip(x, dialect)}, ' ', '_'), '{origin}', '{FOLDED_TO}')"
    bare = f"translate({folded}, '{chars}', '')"
    return f"lower({replace_all(f"replace({bare}, '&', 'and')", rf'[^{WORD}_-]', '', dialect)})"


_NAME_PLACE = rf"\A([^<]+)(?:{SPACE}*<([^>]+)>)?"


def name_part(x: str, dialect: str = "spark") -> str:
    """Name of ``Name <Place>``; a text that starts with a bracket is a name as it stands."""
    s = strip(x, dialect)
    return f"CASE WHEN {matches(s, _NAME_PLACE, dialect)} THEN {strip(extract(s, _NAME_PLACE, 1, dialect), dialect)} ELSE {s} END"


def place_part(x: str, dialect: str = "spark") -> str:
    """Place of ``Name <Place>``, null if there is none."""
    return f"nullif({strip(extract(strip(x, dialect), _NAME_PLACE, 2, dialect), dialect)}, '')"


def bracketed(x: str, dialect: str = "spark") -> str:
    """First text in angle brackets anywhere, null if there is none."""
    return f"nullif({strip(extract(x, '<([^>]+)>', 1, dialect), dialect)}, '')"


def folder_id(x: str, dialect: str = "spark") -> str:
    """Folder id of a page file name: the first run of letters and digits between underscores, null if there is none."""
    return f"nullif({extract(x, '_([A-Za-z0-9]+?)_', 1, dialect)}, '')"


def digits_int(x: str, dialect: str = "spark") -> str:
    """All digits of a text as one number, null if there are none; ``I3`` is 3."""
    return f"try_cast({replace_all(x, r'[^0-9]', '', dialect)} AS BIGINT)"


def strict_int(x: str, dialect: str = "spark") -> str:
    """A text that is a number but for white space, periods and dashes around it, else null; ``I3`` is null."""
    bare = strip(replace_all(strip(x, dialect), r"\A[.\-–—]+|[.\-–—]+\z", "", dialect), dialect)
    return f"CASE WHEN {matches(bare, r'\A[+-]?[0-9]+\z', dialect)} THEN try_cast({bare} AS BIGINT) END"


def parts(x: str, dialect: str = "spark") -> str:
    """Parts of a ``;``-separated text, stripped, empty ones kept."""
    if dialect == "spark":
        return f"transform(split({x}, ';'), p -> {strip('p')})"
    return f"list_transform(string_split({x}, ';'), lambda p: {strip('p', dialect)})"


def is_digits(x: str, dialect: str = "spark") -> str:
    return matches(x, r"\A\p{Nd}+\z", dialect)


def sliced_date(x: str, sign: str) -> str:
    """``YYYYMMDD`` cut by position and joined by ``sign``, without validation. The same in both dialects."""
    return f"(substring({x}, 1, 4) || '{sign}' || substring({x}, 5, 2) || '{sign}' || substring({x}, 7, 2))"


def date_label(start: str, end: str, dialect: str = "spark") -> str:
    """Label of a sale's dates. An end of ``idem`` adds nothing; a missing start leaves the dash in front."""
    head = f"CASE WHEN {start} IS NULL THEN '' WHEN {is_digits(start, dialect)} THEN {sliced_date(start, '/')} ELSE {strip(start, dialect)} END"
    tail = f"CASE WHEN {end} IS NULL THEN '' WHEN {is_digits(end, dialect)} THEN ' - ' || {sliced_date(end, '/')} WHEN {end} LIKE '%idem%' THEN '' ELSE ' - ' || {strip(end, dialect)} END"
    return f"({head} || {tail})"


def date_begin(start: str, dialect: str = "spark") -> str:
    return f"CASE WHEN {is_digits(start, dialect)} THEN {sliced_date(start, '-')} END"


def date_end(start: str, end: str, dialect: str = "spark") -> str:
    return f"CASE WHEN {is_digits(end, dialect)} THEN {sliced_date(end, '-')} WHEN {end} LIKE '%idem%' THEN {date_begin(start, dialect)} END"


def span_slug(label: str, dialect: str = "spark") -> str:
    """Identifier of a time span: the slug of its label with the dash closed up; an empty label gives an empty slug."""
    return slug(f"replace({strip(label, dialect)}, ' - ', '-')", dialect)


def is_valid_date(text: str) -> str:
    """Whether ``YYYY-MM-DD`` is a date of the calendar."""
    return f"(try_to_date({text}, 'yyyy-MM-dd') IS NOT NULL)"


def column(expression: str) -> Column:
    return F.expr(expression)


def url_quoted(x: Column) -> Column:
    """Percent-encoded but for letters, digits and ``_.-~``; blanks as ``%20``."""
    quoted = F.url_encode(x)
    for shown, meant in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        quoted = F.replace(quoted, F.lit(shown), F.lit(meant))
    return quoted

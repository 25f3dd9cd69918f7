"""Text clean-up, keys and classification."""

from __future__ import annotations

import json
import re
import unicodedata
from html.entities import html5

from pyspark.sql import Column, functions as F

# All named entities of HTML that end in a semicolon, from the standard library; a no-break space becomes a blank.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")} | {"nbsp": " "}

# Escapes for XML text, in the order they are applied.
XML_ESCAPES = [
    ('"', "&quot;"),
    ("'", "&apos;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ("&", "&amp;"),
]

# Staff categories that count as researchers.
RESEARCHER_TITLES = (
    ".*PROFESSOR.*|.*LEKTOR.*|FORSKARE|.*AFFIL.*|.*DOKTORAND.*|POSTDOKTOR"
    "|.*FOFU.*|.*FORSKNINGS.*|.*ADJUNKT.*|.*STIPENDIAT.*"
)

# Publication classes, first match wins.
PUBLICATION_CLASSES = [
    ("^Artikel", "Article"),
    ("[Bb]ok", "Book"),
    ("[Kk]onferens", "Conference"),
    ("Dataset", "Dataset"),
    ("Patent", "Patent"),
    ("Rapport", "Report"),
]


def title_key(col: Column) -> Column:
    return F.trim(F.lower(col))


def shorten(col: Column, width: int = 25) -> Column:
    """Truncate to ``width`` characters, the three dots included."""
    return F.when(
        F.length(col) > width,
        F.concat(F.substr(col, F.lit(1), F.lit(width - 3)), F.lit("...")),
    ).otherwise(col)


def decode_entities(col: Column) -> Column:
    """Named and numeric entities as characters, each once; what is none stays as it is."""
    table = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")

    def decoded(piece: Column) -> Column:
        code = F.regexp_extract(piece, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        number = F.when(code.rlike("^#[xX]"), F.conv(F.substr(code, F.lit(3)), 16, 10)).when(code.startswith("#"), F.substr(code, F.lit(2))).try_cast("int")
        valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number < 0x110000))
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        text = F.when(code.startswith("#"), F.when(valid, char)).when(code != "", F.try_element_at(table, code))
        return F.when(text.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(text, F.substr(piece, F.length(code) + 2)))

    pieces = F.split(col, "&", -1)
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")


def tidy_html(col: Column) -> Column:
    """Text of an HTML fragment: markup removed, entities decoded. A text with
    neither is passed through untouched."""
    out = F.regexp_replace(col, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", "")
    return F.when(col.contains("<") | col.contains("&"), decode_entities(out)).otherwise(col)


def tidy_xml(col: Column, cdata: bool = False, ampersand_first: bool = False) -> Column:
    """Escape for XML. By default the ampersand is escaped last, so escapes
    written before it are escaped again; ``ampersand_first`` gives single escapes."""
    if cdata:
        inner = F.replace(F.coalesce(col, F.lit("")), F.lit("]]>"), F.lit(""))
        return F.concat(F.lit("<![CDATA["), inner, F.lit("]]>"))
    steps = XML_ESCAPES[-1:] + XML_ESCAPES[:-1] if ampersand_first else XML_ESCAPES
    out = col
    for char, escape in steps:
        out = F.replace(out, F.lit(char), F.lit(escape))
    return out


def has_unicode(col: Column, strict: bool = False) -> Column:
    """Does the value hold characters above ASCII?

    The established report only sees code points whose four hex digits avoid
    ``f``; ``strict`` reports every one of them.
    """
    return F.coalesce(F.length(unicode_escapes(col, strict)) > 0, F.lit(False))


def unicode_escapes(col: Column, strict: bool = False) -> Column:
    """Escapes of the non-ASCII characters, blank separated; missing if none.

    Works on ``string`` columns with characters of the basic plane."""
    outside = F.regexp_extract_all(col.cast("string"), F.lit(r"([^\x00-\x7F])"), F.lit(1))
    code = lambda ch: F.lower(F.lpad(F.hex(F.ascii(ch)), 4, "0"))
    escaped = F.transform(outside, lambda ch: F.concat(F.lit("\\u"), code(ch)))
    kept = escaped if strict else F.filter(escaped, lambda e: e.rlike(r"^\\u[0-9a-e]{4,}$"))
    return F.nullif(F.array_join(kept, " "), F.lit(""))


def first_words(col: Column, n: int = 3) -> Column:
    """First ``n + 1`` words, lower case, punctuation blanked, trimmed."""
    lead = F.regexp_replace(col, r"(?s)^((?:\S+\s+){%d}\S+).*" % n, "$1")
    return F.trim(F.regexp_replace(F.lower(lead), r"[\p{Punct}]", " "))


def page_extent(col: Column) -> Column:
    """Page range to (begin, end): all numbers, sorted, first two."""
    pages = F.array_sort(
        F.transform(F.regexp_extract_all(col, F.lit(r"(\d+)"), F.lit(1)), lambda p: p.try_cast("int"))
    )
    return F.struct(
        F.try_element_at(pages, F.lit(1)).cast("string").alias("extent_beg"),
        F.try_element_at(pages, F.lit(2)).cast("string").alias("extent_end"),
    )


def clean_organisation(col: Column) -> Column:
    """Drop registry links and the labels of a labelled address."""
    out = F.regexp_replace(
        col,
        r"organization=(.*?)addressline=(.*?)city=(.*?)postcode=(.*?)country=(.*?)",
        "$1$2$3$4$5",
    )
    return F.regexp_replace(out, r"\s*https://ror\.org/[0-9a-z]{9}", "")


def _folded_letters() -> tuple[str, str]:
    """Every accented Latin letter that stands for one ASCII letter, and that letter; stroked ones by their names."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        char = chr(code)
        base = unicodedata.normalize("NFKD", char)[0].lower()
        named = re.match(r"LATIN SMALL LETTER ([A-Z]) WITH ", unicodedata.name(char, ""))
        if char == char.lower() and not base.isascii():
            base = named[1].lower() if named else ""
        if char == char.lower() and base.isascii() and base.isalpha():
            pairs.append((char, base))
    pairs.append(("\u0131", "i"))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_text(col: Column) -> Column:
    """Lower case, accented Latin letters as ASCII, combining marks dropped."""
    folded = F.lower(col)
    for letter, pair in (("æ", "ae"), ("œ", "oe"), ("ß", "ss"), ("þ", "th")):
        folded = F.replace(folded, F.lit(letter), F.lit(pair))
    return F.regexp_replace(F.translate(folded, *_folded_letters()), r"[\u0300-\u036f]", "")


def match_text(col: Column) -> Column:
    """Text folded, runs of blanks collapsed."""
    return F.regexp_replace(fold_text(col), r"\s+", " ")


def publication_class(col: Column) -> Column:
    out = None
    for pattern, label in PUBLICATION_CLASSES:
        test = F.coalesce(col.rlike(pattern), F.lit(False))
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise("Other")


def is_researcher(col: Column) -> Column:
    return F.coalesce(col.rlike(RESEARCHER_TITLES), F.lit(False))


def last_path_part(col: Column) -> Column:
    return F.upper(F.element_at(F.split(col, "/"), -1))


def user_name(col: Column) -> Column:
    return F.regexp_replace(col, "@.*$", "")


def full_name(last: Column, first: Column) -> Column:
    return F.trim(F.concat_ws(", ", last, first))


def size_in_bytes(col: Column) -> Column:
    """``12.5KiB`` to a number of bytes."""
    number = F.regexp_replace(col, "[^0-9.]", "").try_cast("double")
    unit = F.trim(F.regexp_replace(col, "[0-9.]", ""))
    power = F.when(unit == "GiB", 3).when(unit == "MiB", 2).when(unit == "KiB", 1).when(unit == "B", 0)
    return number * F.pow(F.lit(1024.0), power)


def subject_level(code: Column) -> Column:
    """Level of a subject code from its length: 1, 3, 5 give 1, 2, 3."""
    return ((F.length(code) + 1) / 2).cast("int")


def closed_unit(col: Column) -> Column:
    """Unit label such as ``Name (Closed 2012-12-31)`` to flag, date and name."""
    day = F.regexp_extract(col, r"(\d{4}-\d{2}-\d{2})", 1)
    closed = F.coalesce(col.rlike(r"\(.*?\d{4}-\d{2}-\d{2}\)$"), F.lit(False))
    return F.struct(
        closed.alias("is_closed"),
        F.nullif(day, F.lit("")).alias("closed_date"),
        F.when(closed, F.regexp_replace(col, r"\s+[(].*?\d{4}-\d{2}-\d{2}[)]$", "")).otherwise(col).alias("unit"),
    )


def tree_level(rowkey: Column) -> Column:
    return F.regexp_count(rowkey, F.lit("_"))


def without_notes(col: Column) -> Column:
    """Remove parenthesised and bracketed notes from a table cell."""
    return F.trim(F.regexp_replace(F.regexp_replace(col, r"\s*\([^)]*\)", ""), r"\s*\[[^\]]*\]", ""))


def keyword_list(col: Column) -> Column:
    """`` | `` separated keywords to an array, through the ``, `` form."""
    return F.split(F.regexp_replace(col, r" [|] ", ", "), ", ")


def words(col: Column) -> Column:
    return F.split(col, r"\W+")


def fingerprint(col: Column) -> Column:
    return F.lower(F.hex(F.xxhash64(col)))

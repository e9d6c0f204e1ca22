"""Scalar text functions as Catalyst columns: normalization, signatures, vocabulary, novelty."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and literal replacements that the results depend on.
CEDILLA = ("ŞşŢţ", "ȘșȚț")
PRIVATE_USE = r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]"
ZERO_WIDTH = r"[\x{200B}-\x{200D}\x{FEFF}]"
UNICODE_SPACE = r"(?U)[^\S\n\r]"
LETTER = r"[\p{L}\p{Nl}\p{No}]"
URL = r"(https?://[^\s\")\]>,]+|www\.[^\s\")\]>,]+)"
CONTROL = r"[\x{00}-\x{08}\x{0B}\x{0E}-\x{1F}\x{7F}]"
EDGE_SPACE = r"^(?U)\s+|(?U)\s+$"
ICON = "[icon]"
#: What Windows-1252 shows for the bytes 80 to 9F, and those bytes.
WINDOWS = tuple("".join(x) for x in zip(*((bytes([b]).decode("cp1252"), chr(b)) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))))
_NEXT = f"[\u0080-\u00bf{WINDOWS[0]}]"
MISREAD = "[\u00c2\u00c3\u00e2\u00ef\u00f0]"
MOJIBAKE = f"(?:[\u00c2\u00c3]{_NEXT}|\u00e2{_NEXT}{{2}}|\u00ef\u00bb\u00bf|\u00f0[\u009f\u0178]{_NEXT}{{2}})+"


def strip(text: Column) -> Column:
    """Without white space at either end; trim() knows the plain space only."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def lines(text: Column) -> Column:
    """Lines of a text, whatever ends them; a last line break opens no further line."""
    parts = F.split(text, r"\R")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def fold_cedilla(text: Column) -> Column:
    return F.translate(text, *CEDILLA)


def drop_private_use(text: Column) -> Column:
    return F.regexp_replace(text, PRIVATE_USE, "")


def fold_spaces(text: Column) -> Column:
    """Zero-width characters go, every other blank within a line becomes a space."""
    return F.regexp_replace(F.regexp_replace(text, ZERO_WIDTH, ""), UNICODE_SPACE, " ")


def rejoin_hyphens(text: Column) -> Column:
    """A word cut by a hyphen at the end of a line is put together again."""
    return F.regexp_replace(text, rf"(?<={LETTER})-[ \t]*\r?\n[ \t]*(?={LETTER})", "")


def collapse_blank_runs(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def repair(text: Column) -> Column:
    """Line breaks to LF, control characters out, UTF-8 that was read as Latin-1 or Windows-1252 put right.

    Accented Latin letters, punctuation (curly quotes, dashes, bullets), the byte order
    mark and emoji are recognized; each matched run is valid UTF-8 once written back.
    """
    plain = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), CONTROL, "")

    def put_right(t: Column) -> Column:
        runs = F.regexp_extract_all(t, F.lit(MOJIBAKE), F.lit(0))
        right = F.transform(runs, lambda r: F.decode(F.encode(F.translate(r, *WINDOWS), "ISO-8859-1"), "UTF-8"))
        pairs = F.zip_with(F.split(t, MOJIBAKE, -1), right, lambda gap, run: F.concat(gap, F.coalesce(run, F.lit(""))))
        return F.when(t.rlike(MOJIBAKE), F.replace(F.array_join(pairs, ""), F.lit("\ufeff"), F.lit(""))).otherwise(t)

    # Most texts have none of the characters that a misread run begins with; for the others ``plain`` is taken once.
    return F.when(text.rlike(MISREAD), _once(plain, put_right)).otherwise(plain)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that it needs several times: as an array's element the value has a name."""
    return F.transform(F.array(value), use)[0]


def normalize(text: Column, preserve_layout: bool = False, repaired: bool = True) -> Column:
    """The cleaning chain, in its fixed order; a null text stays null."""
    out = repair(text) if repaired else text
    out = rejoin_hyphens(fold_spaces(drop_private_use(fold_cedilla(out))))
    # Line breaks and plain spaces are all the white space that is left now.
    if preserve_layout:
        trimmed = F.transform(F.split(out, r"\R"), lambda line: F.rtrim(line))
    else:
        trimmed = F.transform(F.split(F.regexp_replace(out, " {2,}", " "), r"\R"), lambda line: F.trim(line))
    return F.btrim(collapse_blank_runs(F.array_join(trimmed, "\n")), F.lit(" \n"))


def normalize_report(text: Column) -> Column:
    """struct(text, unicode_repaired); a text is repaired once for both."""
    as_it_was = F.regexp_replace(text, r"\r\n?", "\n")
    return _once(repair(text), lambda t: F.struct(normalize(t, repaired=False).alias("text"), (t != as_it_was).alias("unicode_repaired")))


def line_signature(line: Column, exact: bool = False) -> Column:
    """What a repeated line has in common: case, spacing and (unless exact) its numbers do not count."""
    digits = line if exact else F.regexp_replace(line, r"(?U)\d+", "#")
    return F.lower(F.trim(F.regexp_replace(digits, r"(?U)\s+", " ")))


def count_urls(text: Column) -> Column:
    return F.regexp_count(text, F.lit(URL))


def drop_urls(text: Column) -> Column:
    """URLs removed; only where there were any, spacing is tidied as well."""
    bare = strip(F.regexp_replace(F.regexp_replace(text, URL, ""), " {2,}", " "))
    return F.when(count_urls(text) > 0, bare).otherwise(text)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w+)"), F.lit(1))


def significant_words(text: Column) -> Column:
    return F.array_distinct(F.filter(words(text), lambda w: F.length(w) > 3))


def novelty(candidate: Column, known: Column) -> Column:
    """The share of the candidate's significant words that the known text lacks; 0 without any."""
    return novel_share(significant_words(candidate), significant_words(known))


def novel_share(own: Column, known: Column) -> Column:
    """The same of two lists of significant words, as where one list is compared with many."""
    return F.when(F.size(own) == 0, 0.0).otherwise(F.size(F.array_except(own, known)) / F.size(own))


def icon_noise(text: Column) -> Column:
    """A lone CJK glyph is a misread icon."""
    return F.when(strip(text).rlike(r"^[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]$"), F.lit(ICON)).otherwise(text)


def intruded_words(text: Column) -> Column:
    """struct(words, corrupted): word-like tokens, and those with a digit, capital or mark inside a lower-case run."""
    tokens = F.regexp_extract_all(text, F.lit(r"(?U)\S*[a-z]{3}\S*"), F.lit(0))
    bad = F.filter(tokens, lambda w: ~F.contains(w, F.lit("@")) & ~w.rlike(r"^\p{Lu}") & w.rlike("[a-z][0-9A-Z:.,;][a-z]"))
    return F.struct(F.size(tokens).alias("words"), F.size(bad).alias("corrupted"))

"""Text column functions (inventory TXT), all of them built-in expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _plain(x: str) -> str:
    """A character's compatibility decomposition without combining marks, in lower case."""
    return "".join(y for y in unicodedata.normalize("NFKD", x) if not unicodedata.combining(y)).lower()


#: Blocks whose decompositions folding takes: Latin letters with all their additions, combining marks, raised and lowered
#: signs, wide forms.  (Each use of fold() carries the table, so scripts whose letters have no Latin base are left out.)
FOLDED = [*range(0x80, 0x250), *range(0x300, 0x370), *range(0x1E00, 0x1F00), *range(0x2070, 0x20A0), *range(0xFF00, 0xFF60)]
#: After lower-casing: characters that fold to one other, and then marks that fold to nothing (translate() drops them).
_ONE = [x for x in map(chr, FOLDED) if len(_plain(x)) == 1 and _plain(x) != x and not x.isspace() and x == x.lower()]
ACCENTED = "".join(_ONE) + "".join(x for x in map(chr, FOLDED) if not _plain(x))
PLAIN = "".join(map(_plain, _ONE))
#: In texts of more characters than the first, up to so many different letters of more bytes are replaced one by one; others
#: are translated letter by letter.
LONG, MOST_REPLACED = 1000, 6
#: Ligatures and special blanks of extracted text.
LIGATURES = {" ": " ", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "–": "-", "—": "-"}
#: What double-encoded UTF-8 shows.
MOJIBAKE = "[ÃÂâ�]"
#: Phrases that lose their blanks and get them back.
GLUED_PHRASES = {"por intermédio": "POR INTERMEDIO", "para operação": "PARA OPERACAO"}
#: Words of a work plan that stick to a number after or before them.
GLUED_WORDS, GLUED_AFTER = ["Meta", "Fase", "Atividade", "Ação"], ["Meta", "Fase", "Atividade"]


def _loose(word: str) -> str:
    return "".join({"é": "[eé]", "ç": "[cç]", "ã": "[aã]"}.get(x, x) for x in word if x != " ")


# each is looked for only where one of its first letters stands
GLUED_AGREEMENT = [(rf"(?iu)(?=[{a[0] + a[0].upper()}])\b{_loose(a)}\b", b) for a, b in GLUED_PHRASES.items()]
GLUED_PLAN = [(rf"(?iu)(?=[mMfFaA])\b({'|'.join(map(_loose, GLUED_WORDS))})(?=\d)", "$1 "), (rf"(?iu)(?=[mMfFaA])(?<=\d)(?=(?:{'|'.join(GLUED_AFTER)})\b)", " "), (rf"(?iu)(?=[aA])\b{_loose('até')}(?=\d)", "Ate ")]
# what some pattern of these or a split of prepare_text() needs, tried only at a capital, a digit or p; these are written out,
# since a class of single letters is one table, ranges are a chain of tests
_STARTS = "".join(map(chr, [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0xC0, 0xDE)])) + "p"
_BORDERS = r"(?<=[a-zà-ÿ][A-ZÀ-Ý])|(?<=[A-Za-zÀ-ÿ]\d)\d{3}|(?<=[pP])(?:[oO][rR][iIİı]|[aA][rR][aA][oO])"
MAY_BE_GLUED = f"[{_STARTS}](?:{_BORDERS})"
MAY_BE_GLUED_PLAN = rf"[{_STARTS}](?:{_BORDERS}|(?<=[aoeAOEéÉ]\d)|(?<=\d)(?=[mMfFaA]))"
#: Where a document's text ends and its footer begins.
TAIL_MARKERS = ["documento assinado eletronicamente", "a autenticidade do documento pode ser conferida", "codigo verificador", "codigo crc", "criado por "]
PLACEHOLDERS = ["clique aqui para visualizar o conteudo deste documento", "clique aqui para visualizar o conteúdo deste documento"]
#: Scan windows in characters.
LEAD, HEADER, OPENING, PROCESS, SECTION = 350, 1800, 4200, 12000, 2200


def let(c: Column, body) -> Column:
    """body(c) with c computed once: the built-in form of a local variable."""
    return F.get(F.transform(F.array(c), lambda x: body(x)), F.lit(0))


def clean_spaces(c: Column) -> Column:
    """TXT1: runs of white space become one blank, ends are trimmed; null stays null."""
    # a single blank before a word stays as it is, so that it costs no replacement
    return F.trim(F.regexp_replace(c, r"(?U)(?! \S)\s+", " "))


def _clean_lines(c: Column) -> Column:
    """clean_spaces() for texts of several lines; for short values its expression is too large."""
    # single blanks before words stay as they are, so that they cost no replacement; looking for parts costs far less than a
    # pattern does, so texts of which line ends and blanks are the only white space have none for these
    wide = lambda x: (F.length(x) < F.octet_length(x)) & x.rlike(r"[\u0085-\u3000](?U:(?<=\s))")
    lines = lambda x: F.when(F.contains(x, F.lit("\n")), F.replace(x, F.lit("\n"), F.lit(" "))).otherwise(x)
    squeezed = lambda x: F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " {2,}", " ")).otherwise(x)
    return F.trim(let(c, lambda x: F.when(contains_any(x, "\t\x0b\f\r") | wide(x), F.regexp_replace(x, r"(?U)(?! \S)\s+", " ")).otherwise(let(lines(x), squeezed))))


#: Characters that CP-1252 has in place of the controls U+0080 to U+009F, and these controls, by the codec itself.
CP1252 = "".join(bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0))
CONTROLS = "".join(chr(x.encode("cp1252")[0]) for x in CP1252)


def _read_as_utf8(c: Column) -> Column:
    """c's characters up to U+00FF as bytes, read as UTF-8; null where they are none or are not valid."""
    raw = F.encode(F.when(~c.rlike("[^\\u0000-\\u00ff]"), c), "ISO-8859-1")
    return let(raw, lambda x: F.when(F.is_valid_utf8(x.cast("string")), x.cast("string")))


def _repaired_once(c: Column) -> Column:
    """One round: as Latin-1, else as CP-1252, in which U+0080 to U+009F don't occur; else as it is."""
    other = F.translate(F.when(~c.rlike("[\\u0080-\\u009f]"), c), CP1252, CONTROLS)
    return F.coalesce(_read_as_utf8(c), _read_as_utf8(other), c)


def repair_text(c: Column) -> Column:
    """TXT2: undoes up to two rounds of UTF-8 read as Latin-1 or CP-1252; a text that is still marked after the first round
    gets the second.  Texts without marks are not touched; null stays null.  Built-in functions alone, at any depth."""
    marked = lambda x: x.rlike(MOJIBAKE)
    return F.when(marked(c), let(_repaired_once(c), lambda x: F.when(marked(x), _repaired_once(x)).otherwise(x))).otherwise(c)


def repair_payload(c: Column, kind: T.DataType) -> Column:
    """TXT3: repair over a nested value of a known type: texts in structs, arrays and maps' values."""
    if isinstance(kind, T.StringType):
        return repair_text(c)
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[repair_payload(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: repair_payload(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: repair_payload(x, kind.valueType))
    return c


def prepare_text(c: Column, glued: Iterable[tuple[str, str]] = GLUED_AGREEMENT, may_be_glued: str = MAY_BE_GLUED) -> Column:
    """TXT4, TXT5: ligatures, blanks, dashes, line ends; splits words glued at lower-Upper and letter-year borders.
    may_be_glued: a pattern that finds something in every text that `glued` or such a border changes."""

    def plain(x: Column) -> Column:
        for a, b in LIGATURES.items():
            x = F.replace(x, F.lit(a), F.lit(b))
        return x

    def split(x: Column) -> Column:
        for pattern, new in glued:
            x = F.regexp_replace(x, pattern, new)
        x = F.regexp_replace(x, r"([a-zà-ÿ])(?=[A-ZÀ-Ý])", "$1 ")
        return F.regexp_replace(x, r"([A-Za-zÀ-ÿ])(?=\d{4}\b)", "$1 ")

    held = lambda c, parts, pattern, new: let(c, lambda x: F.when(contains_any(x, parts), F.regexp_replace(x, pattern, new)).otherwise(x))
    c = let(c, lambda x: F.when((F.length(x) < F.octet_length(x)) & contains_any(x, LIGATURES), plain(x)).otherwise(x))
    c = let(held(c, ("\r",), r"\r\n?", "\n"), lambda x: F.when(x.rlike(may_be_glued), split(x)).otherwise(x))
    return F.trim(held(held(c, ("  ", "\t"), r"[ \t]+", " "), ("\n\n\n",), r"\n{3,}", "\n\n"))


def prepare_plan_text(c: Column) -> Column:
    return prepare_text(c, [*GLUED_AGREEMENT, *GLUED_PLAN], MAY_BE_GLUED_PLAN)


def fold(c: Column, degree: str = "o") -> Column:
    """TXT6: lower case without accents, one blank between words, for every letter of FOLDED.  degree: what the degree sign
    becomes.  Characters that decompose to several (ligatures, fractions) are prepare_text's and stay here."""
    signs, plain = (f"°{ACCENTED}", degree + PLAIN) if degree else (f"{ACCENTED}°", PLAIN)
    # most long texts have a few letters of more bytes, and replacing these costs less than looking up every letter; of all
    # letters only sigma has a lower case that hangs on what follows; halves of letters beyond U+FFFF read as `?`, which stays
    letters = lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit(r"[\u0080-\uffff]"), F.lit(0)))
    few = lambda x, y: F.when((F.size(y) <= MOST_REPLACED) & ~F.contains(x, F.lit("Σ")), y).otherwise(F.array(x))
    parts = lambda x: F.when(F.length(x) <= LONG, F.array(x)).otherwise(let(letters(x), lambda y: few(x, y)))
    told = lambda x: F.transform(parts(x), lambda y: F.struct(y.alias("a"), F.translate(F.lower(y), signs, plain).alias("b")))
    plain_letters = lambda x: F.aggregate(told(x), x, lambda done, p: F.replace(done, p["a"], p["b"]))
    # texts of single-byte letters alone have nothing to translate
    return _clean_lines(let(c, lambda x: F.lower(F.when(F.length(x) == F.octet_length(x), x).otherwise(plain_letters(x)))))


def fold_upper(c: Column) -> Column:
    """TXT7: folded, in upper case."""
    return F.upper(fold(c))


def trim_noise(c: Column, markers: list[str] = TAIL_MARKERS, first_only: bool = True) -> Column:
    """TXT8: cut at the first marker in list order (first_only), or at every marker in turn."""
    place = lambda m, low: F.nullif(F.locate(m, low), F.lit(0))
    # cutting at every marker in turn is cutting at the earliest
    first = lambda low: F.coalesce(*[place(m, low) for m in markers]) if first_only else F.array_min(F.array(*[place(m, low) for m in markers]))
    return F.trim(let(c, lambda x: let(F.lower(x), lambda low: F.when(contains_any(low, markers), F.substr(x, F.lit(1), first(low) - 1)).otherwise(x))))


def has_content(c: Column, least: int = 8, forbidden: list[str] = ()) -> Column:
    """TXT9: enough letters before the footer, and none of the forbidden markers."""
    ok = F.length(F.regexp_replace(trim_noise(c), "[^A-Za-zÀ-ÿ]+", "")) >= least
    return F.coalesce(ok & ~contains_any(fold(c), forbidden) if forbidden else ok, F.lit(False))


def window(c: Column, n: int) -> Column:
    """TXT10: the first n characters."""
    return F.trim(F.substring(c, 1, n))


def clean_period(c: Column) -> Column:
    """TXT11: a period text without addresses, print headers and page marks."""
    for pattern in (r"(?i)https?://\S+", r"(?i)\bwww\.\S+", r"\b\d{1,2}/\d{1,2}/\d{2,4},?\s+\d{1,2}:\d{2}(?::\d{2})?\b", r"(?i)\bpag(?:ina)?\.?\s*\d+(?:\s*(?:/|de)\s*\d+)?", r"(?i)documento assinado eletronicamente.*"):
        c = F.regexp_replace(c, pattern, " ")
    return clean_spaces(c)


def excerpt(c: Column, limit: int = 360) -> Column:
    """TXT12: the text, or its beginning and three dots, of at most `limit` characters."""
    c = clean_spaces(c)
    return F.when(F.length(c) > limit, F.concat(F.rtrim(F.substring(c, 1, limit - 3)), F.lit("..."))).otherwise(c)


def safe_name(c: Column, fallback: str = "sem_valor", longest: int = 80) -> Column:
    """TXT13: letters, digits, `.`, `-`, `_`; other runs become one `_`."""
    out = F.substring(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[^\w.-]+", "_"), "^_+|_+$", ""), 1, longest)
    return F.when(out == "", fallback).otherwise(out)


def fingerprint(c: Column) -> Column:
    """TXT14: struct of the digest of the collapsed text, its length and the placeholder flag."""
    text = clean_spaces(F.coalesce(c, F.lit("")))
    return F.struct(F.sha1(text.cast("binary")).alias("sha1"), F.length(text).alias("length"), is_placeholder(text).alias("placeholder"))


def contains_any(c: Column, markers: Iterable[str]) -> Column:
    """True if the text holds one of the markers."""
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(c, F.lit(m))
    return out


def is_placeholder(c: Column) -> Column:
    """TXT15."""
    return contains_any(F.lower(c), PLACEHOLDERS)


def document_key(url: Column, context: list[Column], keys: tuple[str, ...] = ("id_documento", "id_procedimento", "id"), rank: Column | None = None) -> Column:
    """TXT16: the first url parameter found, else ten digits of a digest of the context; after it the rank's digits."""
    base = F.coalesce(*[F.try_parse_url(url, F.lit("QUERY"), F.lit(k)) for k in keys], F.substring(F.sha1(F.concat_ws("|", *context).cast("binary")), 1, 10))
    if rank is None:
        return base
    digits = F.regexp_extract(rank, r"\d+", 0)
    return F.when(digits != "", F.concat(F.lpad(digits, 2, "0"), F.lit("_"), base)).otherwise(base)


def process_parts(c: Column) -> Column:
    """TXT17: struct of a case number's digits and its year, the four digits before the last two; null if shorter."""
    d = F.regexp_replace(c, "[^0-9]", "")
    return F.struct(d.alias("digits"), F.when(F.length(d) >= 6, F.substring(d, -6, 4).cast("int")).alias("year"))


#: Number signs before an agreement's number.
NUMBER_SIGNS = ["numero", "número", "num.", "num", "nro.", "nro", "nº", "n°", "no", "n.", "n"]


def agreement_number(c: Column) -> Column:
    """TXT18: without the number sign before it and the punctuation after it."""
    signs = "|".join(x.replace(".", r"\.") for x in NUMBER_SIGNS)
    return F.regexp_replace(F.regexp_replace(clean_spaces(c), rf"(?iu)^(?:{signs})\.?\s*[:.]?\s*(?=\d)", ""), r"[\s.,;:]+$", "")


def sequence_cell(cells: Column, process: Column) -> Column:
    """TXT19: of a row's first three cells, the first of 1 to 6 digits that isn't the case number, else the first filled."""
    first = F.slice(F.transform(cells, clean_spaces), 1, 3)
    number = F.filter(first, lambda x: x.rlike(r"^\d{1,6}$") & ~x.eqNullSafe(process))
    return F.coalesce(F.get(number, F.lit(0)), F.get(F.filter(first, lambda x: (x != "") & ~x.eqNullSafe(process)), F.lit(0)))


def annotation_cell(cells: Column, markers: tuple[str, ...] = ("PARCEIRO:", "VIGENCIA:", "OBJETO:")) -> Column:
    """TXT20: the cell with a marker, else that with the most colons, line ends and length; null if none scores."""
    count = lambda x, s: F.length(x) - F.length(F.replace(x, F.lit(s), F.lit("")))
    # a marker that folding leaves as it is needs no folded text where it stands as it is
    plain = [m for m in markers if m.isascii() and m == " ".join(m.upper().split())]
    marked = lambda x: contains_any(x, plain) | let(fold_upper(x), lambda y: contains_any(y, markers))
    score = lambda x: F.when(marked(x), 10_000).otherwise(3 * count(x, ":") + 2 * count(x, "\n") + F.when(F.contains(F.lower(x), F.lit("<br")), 6).otherwise(0) + F.when(F.length(x) > 80, 2).otherwise(0))
    best = F.array_max(F.transform(cells, lambda x, i: F.struct(score(x).alias("score"), (-i).alias("i"), x.alias("text"))))
    return let(best, lambda x: F.when(x["score"] > 0, x["text"]))


def to_bool(c: Column) -> Column:
    """TXT21: 1, true, sim, yes in any case."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "sim", "yes"), F.lit(False))


def to_int(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")).try_cast("int"), F.lit(0))


def to_float(c: Column) -> Column:
    """TXT21: decimal comma or point; with both, points group thousands.  What isn't a number is 0."""
    c = F.trim(c.cast("string"))
    c = F.when(F.contains(c, F.lit(",")), F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(c)
    return F.coalesce(F.when(c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), c).try_cast("double"), F.lit(0.0))


def empty_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))

"""Field extraction from prepared texts, tables and annotation blocks (inventory EXT)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.text import HEADER, OPENING, SECTION, _plain, clean_spaces, contains_any, fold, fold_upper, has_content, let, trim_noise
from ..functions.text import agreement_number as number_text
from .classify import INTERNAL, metadata_label

#: What ends a clause, at a line's beginning (with or without a number before it) or anywhere.
CLAUSE_ENDS, CLAUSE_ENDS_ANYWHERE = ["cláusula", "subcláusula", "referência:"], ["documento assinado eletronicamente"]
#: What ends a section of a work plan, besides the next numbered heading.
PLAN_ENDS = ["previsão de início", "unidade responsável", "observações", "cronograma de desembolso"]


def spelled(phrase: str) -> str:
    """A pattern for a phrase with or without its accents and with any blanks between its words."""
    either = {"á": "[aá]", "ã": "[aã]", "ç": "[cç]", "é": "[eé]", "ê": "[eê]", "í": "[ií]", "ó": "[oó]", "õ": "[oõ]", "ú": "[uú]"}
    return r"\s+".join("".join(either.get(x, re.escape(x)) for x in w) for w in phrase.split())


def heading(phrase: str) -> str:
    """A pattern for a phrase at a word's beginning, looked for only where its first letter stands."""
    first = {"á": "aAáÁ", "a": "aAáÁ"}.get(phrase[0], phrase[0] + phrase[0].upper())
    return rf"(?=[{first}])\b" + spelled(phrase)


# a stop is looked for only where one of its first letters stands (with the letter that folds to s)
CLAUSE_STOP = rf"(?=[\ndD])(?:\n\s*(?:\d+\s*\W\s*)?(?:{'|'.join(map(spelled, CLAUSE_ENDS))})|{'|'.join(map(spelled, CLAUSE_ENDS_ANYWHERE))})"
PLAN_STOP = rf"(?=[\nPpUuOoCc])(?:\b(?:{'|'.join(map(spelled, PLAN_ENDS))})\b|\n\s*\d+\.\s*(?-i:[A-Z]))"
# digits are written out before a clause's head: a class of single letters is one table
_CLAUSE = r"(?=[0123456789cC])(?:\d+\s*[.)-]\s*)?CL[ÁA]USULA"
VALIDITY_HEADS = [_CLAUSE + r"[^\n]{0,60}?PRAZO(?:\s+E\s+VIG[ÊE]NCIA)?", _CLAUSE + r"[^\n]{0,80}?D[AO]\s+VIG[ÊE]NCIA", r"(?=[pP])\bPRAZO\s+E\s+VIG[ÊE]NCIA\b", r"(?=[pP])\bPRAZO\s+DE\s+VIG[ÊE]NCIA\b", r"(?=[vV])\bVIG[ÊE]NCIA\b\s*:"]
#: What the folded text holds if a heading of VALIDITY_HEADS occurs (without the letter that folding may leave dotless).
VALIDITY_WORDS = [("clausula", "prazo"), ("clausula", "genc"), ("prazo", "genc"), ("prazo", "genc"), ("genc",)]
OBJECT_HEADS = [_CLAUSE + r"[^\n]{0,60}?D[OA]\s+OBJETO", r"(?=[dD])\bDO OBJETO\b"]


def filled(c: Column) -> Column:
    return let(F.trim(c), lambda x: F.when(x != "", x))


def answer(value: Column, source: str) -> Column:
    """Struct (value, source), null without a value, which is computed once."""
    return let(value, lambda x: F.when(x.isNotNull(), F.struct(x.alias("value"), F.lit(source).alias("source"))))


def section(c: Column, heads: list[str], stop: str = CLAUSE_STOP, keep_head: bool = False, folded: Column | None = None, words: list[tuple[str, ...]] = ()) -> Column:
    """EXT1, EXT2 (keep_head): from the first heading pattern that occurs to the next stop; null without one.  folded is fold(c)
    where a frame has it, words what it holds if a heading occurs: looking for words costs less than for headings."""
    group = 0 if keep_head else 1
    found = [filled(F.regexp_extract(c, rf"(?isu)(?:{h})(.*?)(?={stop}|\z)", group)) for h in heads]
    return F.coalesce(*(found if folded is None else [where_held(folded, w, x) for w, x in zip(words, found, strict=True)]))


def where_held(folded: Column, words: tuple[str, ...], value: Column) -> Column:
    """value where the folded text holds all words, else null."""
    held = F.lit(True)
    for w in words:
        held = held & F.contains(folded, F.lit(w))
    return F.when(held, value)


def focus_window(c: Column, patterns: list[str], n: int = SECTION, folded: Column | None = None, words: tuple[str, ...] = ()) -> Column:
    """EXT3: n characters from the first pattern that occurs.  folded, words: as in section(), for all patterns."""
    found = F.coalesce(*[filled(F.regexp_extract(c, rf"(?isu)(?:{p}).{{0,{n}}}", 0)) for p in patterns])
    return found if folded is None else where_held(folded, words, found)


def preamble(c: Column) -> Column:
    """EXT4: the text before the first clause, else its opening."""
    place = F.regexp_instr(c, F.lit(r"(?iu)(?=[cC])\bCL[ÁA]USULA\b"))
    return F.trim(let(place, lambda at: F.when(at > 0, F.substr(c, F.lit(1), at - 1)).otherwise(F.substring(c, 1, OPENING))))


def clause_value(c: Column) -> Column:
    """EXT5."""
    c = F.regexp_replace(trim_noise(c), r"(?isu)(?=[sSſ])\bSubcl[aá]usula\b.*", "")
    return clean_spaces(F.regexp_replace(c, r"^[\s\-:.;]+", ""))


#: The wordings before an agreement's number and the source that each gives.
NUMBER_HEADS = {"cabecalho_act_tecnica": "acordo de cooperacao tecnica", "cabecalho_act_generico": "acordo de cooperacao"}


def agreement_number(title: Column, text: Column) -> Column:
    """EXT6: struct (value, source) from the title, else the header; null if there is none."""
    return folded_number(fold(F.coalesce(title, F.lit(""))), fold(F.substring(F.coalesce(text, F.lit("")), 1, HEADER)))


def folded_number(*sources: Column) -> Column:
    """The word after a head and its number sign, if it holds a digit."""
    out = []
    for source in sources:
        for name, head in NUMBER_HEADS.items():
            rest = F.regexp_extract(F.when(F.contains(source, F.lit(head)), source), rf"{head}\s+(?:(?:numero|no|n[o.]?)\s*:?\s*)?([\w./-]+)", 1)
            value = F.regexp_replace(rest, r"[.,;:]+$", "")
            out.append(let(value, lambda x, name=name: F.when(x.rlike(r"\d"), F.struct(x.alias("value"), F.lit(name).alias("source")))))
    return F.coalesce(*out)


def is_internal(c: Column, internal: tuple[str, ...] = INTERNAL) -> Column:
    """The publisher's own institutions; the union stands for them."""
    return contains_any(fold(c), (*internal, "uniao"))


def counterparty(text: Column, internal: tuple[str, ...] = INTERNAL) -> Column:
    """EXT7: struct (value, source): the first party that isn't an internal institution, from the preamble's wording,
    then its paragraphs, then the folded text.  `internal` is the publisher's list."""
    return party_ladder(party_parts(preamble(text), fold(text), internal))


#: What ends the list of parties after `celebram`, and what joins two of them.
PARTY_ENDS = ["para os fins que especifica", "doravante", "neste ato", "mediante"]
PARTY_JOINS = [r",?\s+e\s*,?\s*(?:de\s+outro\s+lado\s*,?\s*)?(?:o|a|os|as)\s+", r",?\s*por\s+interm[eé]dio\s+d[oa]s?\s+", r",?\s*de\s+outro\s+lado\s*,?\s*(?:o|a|os|as)?\s+"]


def party_parts(head: Column, folded: Column, internal: tuple[str, ...] = INTERNAL) -> dict[str, Column]:
    """Parties named after `celebram`, whichever comes first and over line ends; then paragraphs' and labels' parties."""
    named = lambda x: (F.length(F.regexp_replace(x, "[^A-Za-zÀ-ÿ]", "")) >= 4) & ~is_internal(x, internal)
    other = lambda names: F.get(F.filter(F.transform(names, party_name), named), F.lit(0))
    ends = "|".join(x.replace(" ", r"\s+") for x in PARTY_ENDS)
    listed = F.regexp_extract(head, rf"(?isu)(?=[cC])\bcelebram\b(.{{4,900}}?)(?=[,\s.{''.join(sorted({x[0] + x[0].upper() for x in PARTY_ENDS}))}]|\z)(?:,?\s*\b(?:{ends})\b|\.\s|\n\s*\n|\z)", 1)
    paragraphs = F.filter(F.split(head, r"\n\s*\n"), lambda p: p.rlike(r"(?iu)CNPJ|inscrit[oa]|com sede|representad[oa]"))
    return {
        "preambulo": other(F.split(F.regexp_replace(listed, rf"(?iu)(?=[,\s])(?:{'|'.join(PARTY_JOINS)})", "\u0001"), "\u0001")),
        "preambulo_paragrafo": other(F.transform(paragraphs, lambda p: F.regexp_extract(p, r"(?su)^\s*(?:[0-9IVX]+\s*[-.)]\s*)?(?:[OA]\s+)?([^,;\n]{4,160})", 1))),
        "texto_normalizado": other(F.regexp_extract_all(folded, F.lit(r"(?:participe 2|segundo participe|convenente)\s*:?\s*([^,;.\n]{4,120})"), F.lit(1))),
    }


def party_ladder(parts: dict[str, Column]) -> Column:
    return F.coalesce(*[answer(v, s) for s, v in parts.items()])


def party_name(c: Column) -> Column:
    c = F.regexp_replace(clean_spaces(c), r"(?iu)(?=[\s,(iIİıcCdDrRpP])\s*(?:,|\(|\binscrit[oa]\b|\bCNPJ\b|\bdoravante\b|\brepresentad[oa]\b|\bcom sede\b|\bpara os fins\b).*$", "")
    return clean_spaces(F.regexp_replace(F.regexp_replace(c, r"(?iu)^(?:e|o|a|os|as)\s+", ""), r"^[\s\-:.;,]+|[\s\-:.;,]+$", ""))


def subject(text: Column, folded: Column | None = None) -> Column:
    """EXT8: struct (value, source): the object clause, else the header's `Objeto:`.  folded is fold(text) where a frame has it."""
    clause = filled(clause_value(section(text, OBJECT_HEADS, folded=folded, words=[("clausula", "objeto"), ("do objeto",)])))
    header = filled(clause_value(F.regexp_extract(F.substring(text, 1, HEADER), r"(?iu)(?=[oO])\bObjeto\s*:\s*([^\n]+)", 1)))
    found = F.coalesce(answer(clause, "clausula_objeto"), answer(header, "cabecalho_objeto"))
    return found if folded is None else where_held(folded, ("objeto",), found)


#: Labels of the people and the unit of an agreement, and what ends their values.
HOLDER, DEPUTY, UNIT = ["gestor titular", "titular", "gestor(?:a)?"], ["gestor substituto", "substitut[oa]", "suplente"], ["unidade respons[aá]vel"]
NAME_ENDS = ("substitut[oa]", "titular", "cpf", "rg", "matr[ií]cula", "suplente", "unidade respons[aá]vel", "cargo", "telefone", "e-mail", "unidade")


#: What the folded text holds if a label of the people or the unit occurs (again without the letter i).
LABEL_WORDS = {"gestor titular": "gestor", "titular": "tular", "gestor(?:a)?": "gestor", "gestor substituto": "gestor subst", "substitut[oa]": "subst", "suplente": "suplente", "unidade respons[aá]vel": "dade respons", "unidade": "dade"}


def named_value(c: Column, labels: list[str], stops: tuple[str, ...] = NAME_ENDS, folded: Column | None = None) -> Column:
    """EXT9: the text after one of the labels and a colon, up to a stop label.  folded is fold(c) where a frame has it; labels
    are then of LABEL_WORDS."""
    out = []
    for label in labels:
        v = F.regexp_replace(F.regexp_extract(c, rf"(?iu)(?=[{label[0] + label[0].upper()}{'ſ' if label[0] == 's' else ''}])\b{label}\b\s*:\s*([^\n:]{{3,160}})", 1), rf"(?iu)(?=[\s,;{''.join(sorted({x[0] + x[0].upper() for x in stops}))}ſKİı-])\s*[,;-]?\s*\b(?:{'|'.join(stops)})\b.*$", "")
        v = clean_spaces(F.regexp_replace(v, r"^[\s\-:.;]+|[\s\-:.;,]+$", ""))
        v = let(v, lambda x: F.when(F.length(F.regexp_replace(x, "[^A-Za-zÀ-ÿ]+", "")) >= 3, x))
        out.append(v if folded is None else where_held(folded, (LABEL_WORDS[label],), v))
    return F.coalesce(*out)


def agreement_record(df: DataFrame, text: str = "_body", title: str = "title", whole: str = "text", internal: tuple[str, ...] = INTERNAL) -> DataFrame:
    """EXT10: adds the extracted fields of an agreement; only final agreements are read, others get nulls.  Signatures
    stand in the footer, so they are read from the whole text."""
    only = lambda c: F.when(F.col("doc_class") == "act_final", F.col(c))
    # blobs() have folded the body already; its beginning is folded by itself only if the body is longer
    known = text == "_body" and "folded" in df.columns
    df = df.withColumns({"_final": only(text), "_signed": only(whole), "_ftext": only("folded") if known else fold(only(text))})
    final, folded = F.col("_final"), F.col("_ftext")
    clause = section(final, VALIDITY_HEADS, folded=folded, words=VALIDITY_WORDS)
    clause = F.coalesce(clause, focus_window(final, [r"\bPRAZO\s+DE\s+VIG[ÊE]NCIA\b", r"\bPRAZO\s+E\s+VIG[ÊE]NCIA\b", r"\bVIG[ÊE]NCIA\b"], folded=folded, words=("genc",)))
    head = F.when(F.length(final) <= HEADER, folded).otherwise(fold(F.substring(final, 1, HEADER)))
    df = df.withColumns({"_clause": clause, "_head": preamble(final), "_ftitle": fold(F.coalesce(only(title), F.lit(""))), "_fhead": F.coalesce(head, F.lit(""))})
    df = D.staged(df, D.validity_parts(F.col("_clause"), F.col("_signed")), "_validity", D.validity_ladder)
    # each part of a party is read only where those before it give none
    df = df.withColumns({"_party": party_ladder(party_parts(F.col("_head"), folded, internal)), "_number": folded_number(F.col("_ftitle"), F.col("_fhead")), "_subject": subject(final, folded)})
    return df.withColumns({
        "numero_acordo": F.col("_number.value"), "numero_fonte": F.col("_number.source"), "data_inicio_vigencia": F.col("_validity.start"), "data_fim_vigencia": F.col("_validity.end"),
        "vigencia_fonte": F.col("_validity.source"), "vigencia_aviso": F.col("_validity.warning"), "orgao_convenente": F.col("_party.value"), "objeto": F.col("_subject.value"),
        "objeto_fonte": F.col("_subject.source"), "gestor": named_value(final, HOLDER, folded=folded), "gestor_substituto": named_value(final, DEPUTY, folded=folded), "unidade": named_value(final, [*UNIT, "unidade"], folded=folded), "text_chars": F.length(F.col(text)),
    }).drop("_validity", "_number", "_party", "_subject", "_final", "_signed", "_clause", "_head", "_ftitle", "_fhead", "_ftext")


#: What follows the identification of a work plan's object, and what follows its partner.
OBJECT_ENDS = ["diagnostico", "objetivo", "metodologia", r"meta\s*\d+", r"previsao\s+de\s+inicio", r"unidade\s+responsavel"]
PARTNER_ENDS = ["cnpj", "ddd/telefone", "respons[aá]vel", "endere[cç]o"]
#: The wordings before a partner's name, in order.
PARTNER_HEADS = [r"part[ií]cipe\s*2\s*:", r"executor\b[^\n]*?[oó]rg[aã]o\s*/\s*entidade\b\s*:?", r"\bparceir[oa]\s*:", r"nome da institui[cç][aã]o\s*:", r"[oó]rg[aã]o/entidade\s*:"]


def content(c: Column, least: int = 8) -> Column:
    """The value if it has so many letters before its footer (TXT9)."""
    return let(c, lambda x: F.when(has_content(x, least), x))


def plan_object(text: Column, preview: Column, folded: Column | None = None) -> Column:
    """EXT11 (folded is fold(text) where a frame has it as a column): the preview's, else the identification block's (folded), else the first line that names the object and has
    a colon; each if it has content."""
    block = F.regexp_extract(fold(text) if folded is None else folded, rf"(?s)identificacao\s+do\s+objeto\s*:?\s*(.{{1,4000}}?)(?=\b(?:{'|'.join(OBJECT_ENDS)})\b|\z)", 1)
    lines = F.filter(F.split(text, r"\r\n?|\n"), lambda x: F.contains(x, F.lit(":")) & F.contains(fold(x), F.lit("objeto")))
    values = F.filter(F.transform(lines, lambda x: clean_spaces(F.regexp_replace(x, "^[^:]*:", ""))), lambda x: has_content(x))
    return F.coalesce(content(clean_spaces(preview)), content(clean_spaces(block)), F.get(values, F.lit(0)))


def plan_partner(text: Column, preview: Column, fallback: str | None = None, internal: tuple[str, ...] = INTERNAL) -> Column:
    """EXT12: the preview's, else the first of the wordings' that isn't internal, else the fallback if the text holds it."""
    ends = rf"(?:\s+(?:{'|'.join(PARTNER_ENDS)})\b|\n|\z)"
    found = [content(party_name(F.regexp_extract(text, rf"(?isu){head}\s*(.{{3,300}}?){ends}", 1)), 4) for head in PARTNER_HEADS]
    known = F.lit(None).cast("string") if fallback is None else F.when(F.contains(fold(text), fold(F.lit(fallback))), F.lit(fallback))
    return F.coalesce(content(clean_spaces(preview), 4), *[let(y, lambda x: F.when(~is_internal(x, internal), x)) for y in found], known)


def words_of(phrase: str) -> tuple[str, ...]:
    """What folded text holds if a phrase occurs in the text: its longest piece without the letter i, which folding may leave
    dotless."""
    return (max(re.split(r"[i\s]+", "".join(map(_plain, phrase))), key=len),)


#: Headings of a work plan's duties, in order.
DUTY_HEADS = ["responsabilidades dos partícipes", "objetivo geral e objetivos específicos", "compromissos e responsabilidades", "atribuições", "responsabilidades", "obrigações dos partícipes"]


def duties(text: Column, folded: Column | None = None) -> Column:
    """EXT13 (folded is fold(text) where a frame has it)."""
    return filled(clause_value(section(text, [heading(x) for x in DUTY_HEADS], PLAN_STOP, keep_head=True, folded=folded, words=[words_of(x) for x in DUTY_HEADS])))


def routed_goals(tables: Column) -> Column:
    """EXT14: struct (goals, actions), items joined by ` || ` and cells by ` | `, distinct and in order, from tables whose header has `meta`, an action or description, and a
    period, schedule or owner (or `etapa`, description and schedule).

    A row that begins with a number is a goal (number and next cell) and, with more cells, an action (all but the
    number).  A row that begins with meta, fase or etapa is a goal as it is, and its other cells an action.  All else is
    an action."""
    has = lambda h, *words: contains_any(h, words)
    full = lambda h: has(h, "meta") & has(h, "acao", "descricao") & has(h, "periodo", "cronograma", "responsavel")
    header = lambda t: fold(F.array_join(F.get(t["rows"], F.lit(0)), " | "))
    relevant = F.filter(tables, lambda t: let(header(t), lambda h: full(h) | (has(h, "etapa") & has(h, "descricao") & has(h, "cronograma"))))
    rows = F.flatten(F.transform(relevant, lambda t: F.slice(t["rows"], 2, 1_000_000)))
    cells = F.filter(F.transform(rows, lambda r: F.filter(F.transform(r, clean_spaces), lambda x: x != "")), lambda r: F.size(r) > 0)
    join = lambda a: F.array_join(a, " | ")
    rest = lambda r: F.when(F.size(r) > 1, join(F.slice(r, F.lit(2), F.size(r) - 1)))

    def routed(r: Column) -> Column:
        first = fold(F.get(r, F.lit(0)))
        numbered, named = first.rlike(r"^\d+$") & (F.size(r) >= 2), first.rlike("^(?:meta|fase|etapa)")
        goal = F.when(numbered, join(F.slice(r, 1, 2))).when(named, join(r))
        return F.struct(goal.alias("goal"), F.when(numbered, F.when(F.size(r) >= 3, rest(r))).when(named, rest(r)).otherwise(join(r)).alias("action"))

    pack = lambda a: filled(F.array_join(F.array_distinct(F.array_compact(a)), " || "))
    both = F.transform(cells, routed)
    return let(both, lambda x: F.struct(pack(F.transform(x, lambda y: y["goal"])).alias("goals"), pack(F.transform(x, lambda y: y["action"])).alias("actions")))


#: Headings of a work plan's execution, in order.
EXECUTION_HEADS = ["metodologia e intervenção", "metas de execução", "meta de execução", "ação e cronograma", "etapas, execução e cronograma", "etapas e execução e cronograma", "cronograma de execução", "plano de ação"]


def execution_section(text: Column, folded: Column | None = None) -> Column:
    """EXT15: the execution section, else from the first goal or phase mentioned to the next stop (folded as in duties())."""
    named = section(text, [heading(x) for x in EXECUTION_HEADS], PLAN_STOP, keep_head=True, folded=folded, words=[words_of(x) for x in EXECUTION_HEADS])
    return F.coalesce(named, section(text, [r"(?=[mMfF])\b(?:meta\s*\d|fase\s*[a-z]\b)"], PLAN_STOP, keep_head=True))


#: Marks that begin a part of a work plan.
PARTS = {"meta": r"meta\s*\d+\b", "fase": r"fase\s*[a-z]\b", "etapa": r"etapas?\b", "acao": r"a[cç][aã]o\b", "atividade": r"atividade\s*[a-z]?\.\d", "produto": r"produto\b"}
#: The letters that a part begins with.
PART_LETTERS = "mMfFeEaApP"
#: The parts that are goals, and actions: what ends each, and its longest text.
GOAL_PARTS = [("meta", ["meta", "fase", "acao", "atividade"], 700), ("fase", ["fase", "meta"], 700), ("etapa", [], 700)]
ACTION_PARTS = [("acao", ["acao", "produto", "meta", "atividade"], 600), ("atividade", ["atividade", "fase", "meta"], 600), ("produto", ["produto", "meta", "acao"], 300)]


def part_fragments(text: Column, kinds: list[tuple[str, list[str], int]]) -> Column:
    """EXT16 over line ends: the pieces of the text that begin with a kind and go on to where it or one of its ends begins,
    up to a section's stop."""
    found = []
    for kind, ends, longest in kinds:
        borders = "|".join(PARTS[x] for x in dict.fromkeys([kind, *ends]))
        pieces = F.regexp_extract_all(text, F.lit(rf"(?isu)(?=[{PART_LETTERS}])\b{PARTS[kind]}(?:.*?)(?=(?=[{PART_LETTERS}])\b(?:{borders})|\z)"), F.lit(0))
        cut = lambda x: F.substring(F.regexp_replace(x, rf"(?isu)(?:{PLAN_STOP}).*", ""), 1, longest + 10)  # noqa: B023, E731
        found.append(F.transform(pieces, lambda x: F.regexp_replace(clean_spaces(trim_noise(cut(x))), r"[\s,;]+$", "")))
    return F.array_distinct(F.filter(F.flatten(F.array(*found)), lambda x: x != ""))


def goals_text(tables: Column, text: Column, actions: bool = False) -> Column:
    """EXT17: from tables if they have content, else fragments of the execution section (or the text), else the section."""
    return goals_of(routed_goals(tables), execution_section(text), text, actions)


def goals_of(routed: Column, execution: Column, text: Column, actions: bool = False) -> Column:
    """goals_text() from the rows of tables (EXT14) and the execution section (EXT15), as columns that goals and actions share."""
    pieces = lambda base: filled(F.array_join(part_fragments(base, ACTION_PARTS if actions else GOAL_PARTS), " || "))
    untold = let(execution, lambda x: F.coalesce(let(F.coalesce(x, text), pieces), filled(clean_spaces(x))))
    return F.coalesce(content(routed["actions" if actions else "goals"]), untold)


#: Annotation labels (folded, upper case) and the field that each begins.
ANNOTATIONS = {"parceiro": ["PARCEIRO", "PARCEIROS", "PARCEIRA", "PARCEIRAS"], "vigencia": ["VIGENCIA"], "numero_act": ["NUMERO ACT", "NUMEROACT", "NUMERO", "NUMERO DO ACT", "ACT", "N DO ACT", "NO ACT", "NO DO ACT"], "objeto": ["OBJETO"]}


def annotation(c: Column) -> Column:
    """EXT19: struct (parceiro, vigencia, numero_act, objeto) of a block of `LABEL: value` lines.

    The first filled value of a label wins; numbers lose their sign.  The object goes on over lines until the next
    metadata label, whatever its case; a later object block replaces an earlier one.  One walk over a row's lines."""
    # blanks are cleaned in the block, not line by line; empty lines are none, so "\\r\\n" may be two ends
    block = F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>|\r", "\n"), r"(?U)(?! \S)[\s&&[^\n]]+", " ")
    lines = F.filter(F.transform(F.split(block, "\n"), lambda x: F.trim(x)), lambda x: x != "")

    # fold_upper() of a line's part, whose blanks are clean: of single-byte letters only the case and the ends are left to do
    upper = lambda x: F.when(F.length(x) == F.octet_length(x), F.trim(F.upper(x))).otherwise(fold_upper(x))

    # inside lambdas nothing is shared, so what several fields of a line need is bound
    def parsed(x: Column) -> Column:
        def labelled(at: Column) -> Column:
            label = F.when(at > 1, let(F.substring(x, F.lit(1), at - 1), upper)).otherwise("")
            value = F.when(at > 0, F.trim(F.substr(x, at + 1))).otherwise("")
            return let(label, lambda y: F.struct(x.alias("line"), y.alias("label"), value.alias("value"), (at.between(3, 81) & metadata_label(y)).alias("ends")))

        return let(F.locate(":", x), labelled)

    text = F.lit(None).cast("string")
    start = F.struct(F.lit(False).alias("inside"), F.array().cast("array<string>").alias("lines"), *[text.alias(k) for k in ("parceiro", "vigencia", "numero_act")])

    def step(acc: Column, x: Column) -> Column:
        object_line = x["label"].isin(ANNOTATIONS["objeto"])
        inside = acc["inside"] & ~(x["ends"] & ~object_line)
        begins = object_line & ~acc["inside"]
        first = F.when(x["value"] != "", F.array(x["value"])).otherwise(F.array().cast("array<string>"))
        more = F.when(begins, first).when(inside, F.concat(acc["lines"], F.array(x["line"]))).otherwise(acc["lines"])
        take = lambda k: F.coalesce(acc[k], F.when(~inside & x["label"].isin(ANNOTATIONS[k]), filled(x["value"])))
        return F.struct((inside | begins).alias("inside"), more.alias("lines"), *[take(k).alias(k) for k in ("parceiro", "vigencia", "numero_act")])

    def end(acc: Column) -> Column:
        return F.struct(acc["parceiro"].alias("parceiro"), acc["vigencia"].alias("vigencia"), number_text(acc["numero_act"]).alias("numero_act"), filled(clean_spaces(F.array_join(acc["lines"], " "))).alias("objeto"))

    return F.aggregate(F.transform(lines, parsed), start, step, end)


def preview_record(cells: Column, process: Column) -> Column:
    """EXT20: struct of the sequence, and the annotation's fields, of a list row."""
    from ..functions.text import annotation_cell, sequence_cell

    return let(annotation(annotation_cell(cells)), lambda a: F.struct(sequence_cell(cells, process).alias("seq"), *[a[k].alias(k) for k in ANNOTATIONS]))


#: Words that make a label a date label, and the key that some give, first found first.
DATE_LABELS = ["inicio", "termino", "assinatura", "vigencia", "prazo", "periodo", "data", "duracao", "execucao"]
RAW_KEYS = [("inicio", ["inicio"]), ("termino", ["termino", "fim"]), *[(k, [k]) for k in ("assinatura", "vigencia", "prazo", "periodo", "data")]]
#: Marks of page furniture, in which no field is looked for.
RAW_NOISE = ["http://", "https://", "documento assinado eletronicamente", "a autenticidade do documento pode ser conferida", "codigo verificador", "codigo crc", "controlador_externo.php", "criado por ", "super.gov.br"]
#: Wordings that stand for a date.
RELATIVE_DATES = ["apos", "antes", "imediatamente", "sem data", "na data de assinatura", "a partir da assinatura"]
EVIDENCE = 180


def _shaped(x: Column, kind: str, low: int, high: int) -> Column:
    return F.coalesce(x.rlike(f"^[{kind}]{{{low},{high}}}$"), F.lit(False))


def dated(folded: Column) -> Column:
    """Folded text names a date or stands for one: day, month and year, month and year, or a name and a year with a mark
    between them; a day, a month's name and a year with `de` between them; or one of RELATIVE_DATES."""
    numbers = lambda x, low, high: _shaped(x, "0-9", low, high)
    name = lambda x: _shaped(x, "a-z", 3, 12)

    def marked(token: Column) -> Column:
        """A token whose neighbouring parts, between marks, have the shapes of a date."""
        def fits(parts: Column) -> Column:
            at = lambda i: F.get(parts, i)
            return F.transform(parts, lambda x, i: ((numbers(x, 1, 2) & ((numbers(at(i + 1), 1, 2) & numbers(at(i + 2), 2, 4)) | numbers(at(i + 1), 4, 4))) | (name(x) & numbers(at(i + 1), 2, 4))))
        return let(F.split(token, "[./-]"), lambda parts: F.array_contains(fits(parts), True))

    def worded(tokens: Column) -> Column:
        at = lambda i: F.get(tokens, i)
        return F.array_contains(F.transform(tokens, lambda x, i: numbers(x, 1, 2) & F.coalesce(at(i + 1) == "de", F.lit(False)) & name(at(i + 2)) & F.coalesce(at(i + 3) == "de", F.lit(False)) & numbers(at(i + 4), 4, 4)), True)

    tokens = F.split(F.regexp_replace(folded, r"\s*([./-])\s*", "$1"), "[^a-z0-9./-]+")
    # only a token with a mark has parts, and only one beside `de` is a day in words
    told = let(tokens, lambda x: F.exists(x, lambda y: F.when(y.rlike("[./-]"), marked(y)).otherwise(False)) | F.when(F.array_contains(x, "de"), worded(x)).otherwise(False))
    return F.when(contains_any(folded, RELATIVE_DATES) & folded.rlike(rf"\b(?:{'|'.join(RELATIVE_DATES)})\b"), True).when(~folded.rlike("[0-9]"), False).otherwise(told)


def dated_value(folded: Column) -> Column:
    """A value after a label is also dated if it has the first letters of a month."""
    return dated(folded) | contains_any(folded, D.SHORT)


#: No line without one of these holds a date (case and accents as they are in the text).
_MAY_BE_DATED = r"(?iu)[0-9]|" + "|".join([*D.SHORT, "ap[oó]s", *[w for w in RELATIVE_DATES if w != "apos"]])


def _may_be_dated(x: Column) -> Column:
    """x matches _MAY_BE_DATED; single-byte texts are told by their parts."""
    plain = lambda low: x.rlike("[0-9]") | contains_any(low, [*D.SHORT, *RELATIVE_DATES])
    return F.when(F.length(x) == F.octet_length(x), let(F.lower(x), plain)).otherwise(x.rlike(_MAY_BE_DATED))


def _any(words) -> str:
    return "|".join(re.escape(w) for w in words)


def raw_fields(df: DataFrame, key: str = "processo", text: str = "text", tables: str | None = "tables") -> DataFrame:
    """EXT21: (key, field_key, label, value, origin, origin_ref, section_hint, evidence, value_is_empty,
    value_has_date_like): label and value of table rows (all cells after the first) and of `label: value` matches in
    lines, and bare lines with a date; equal fields of a line or row count once.

    One pass over a row's lines as arrays, so there is no shuffle; what tests need is made by the generator, so that it
    is computed once.  Null texts and tables have no fields."""
    clean = F.regexp_replace(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\u00a0"), F.lit(" ")), r"[ \t]*[\r\n]+", "\n")
    numbered = F.transform(F.split(F.trim(clean), "\n"), lambda x, i: F.struct(i.alias("_at"), x.alias("_line")))
    # fields of lines need a date in their value; lines that can't have one are dropped before they are folded
    folded = lambda at, x: F.struct(at.alias("_at"), x.alias("_line"), fold(x).alias("_f"))
    kept = F.transform(F.filter(numbered, lambda x: _may_be_dated(x["_line"])), lambda x: let(F.trim(F.regexp_replace(x["_line"], r"(?! [^ \t])[ \t]+", " ")), lambda y: folded(x["_at"], y)))
    lines = df.select(key, F.inline(F.filter(kept, lambda x: ~contains_any(x["_f"], RAW_NOISE))))
    field = lambda label, value: F.struct(label.alias("label"), value.alias("value"), fold(label).alias("_fl"), let(fold(value), lambda x: F.when(~contains_any(x, RAW_NOISE), x)).alias("_fv"))
    pairs = F.regexp_extract_all("_line", F.lit(r"[^:\n]{2,80}:[^:\n]{0,300}"), F.lit(0))
    named = F.transform(F.array_distinct(pairs), lambda x: field(F.trim(F.split_part(x, F.lit(":"), F.lit(1))), F.trim(F.split_part(x, F.lit(":"), F.lit(2)))))
    bare = F.when((F.length("_line") <= 160) & dated(F.col("_f")), F.array(field(F.lit(""), F.col("_line"))))
    rows = lines.select(key, F.lit("text").alias("origin"), F.concat(F.lit("line#"), F.col("_at").cast("string")).alias("origin_ref"), F.inline(F.when(F.contains("_line", F.lit(":")) & F.col("_line").rlike("[^:]{2}:"), named).otherwise(bare)))
    if tables:
        cells = df.select(key, F.posexplode(F.coalesce(F.col(tables), F.array())).alias("_t", "_table")).select(key, "_t", F.posexplode("_table.rows").alias("_r", "_row"))
        cells = cells.select(key, F.lit("table").alias("origin"), F.concat(F.lit("table#"), F.col("_t").cast("string"), F.lit(" row#"), F.col("_r").cast("string")).alias("origin_ref"), F.transform("_row", lambda x: clean_spaces(F.coalesce(x, F.lit("")))).alias("_c"))
        rest = F.array_join(F.filter(F.slice("_c", 2, 1_000_000), lambda x: x != ""), " | ")
        rows = rows.union(cells.where("size(_c) > 0").select(key, "origin", "origin_ref", F.inline(F.array(field(F.get("_c", F.lit(0)), rest)))).where("label <> ''"))
    label, name = F.col("_fl"), F.lit("outro")
    for k, words in reversed(RAW_KEYS):
        name = F.when(contains_any(label, words), k).otherwise(name)
    named = label.rlike(_any(DATE_LABELS)) & F.length("label").between(3, 60) & ~label.rlike(f"[|@]|{_any(RAW_NOISE)}") & (F.size(F.split(label, " ")) <= 6) & (F.length(F.regexp_replace(label, "[^a-z]", "")) >= 4)
    useful = (F.length("value") > 2) & F.col("_fv").isNotNull() & (((F.col("origin") == "table") & label.rlike(_any(w for _, words in RAW_KEYS for w in words))) | dated_value(F.col("_fv")))
    rows = rows.where((label == "") | (named & useful))
    evidence = F.substring(F.concat_ws(": ", F.nullif("label", F.lit("")), "value"), 1, EVIDENCE)
    return rows.select(key, F.when(label == "", "data").otherwise(name).alias("field_key"), "label", "value", "origin", "origin_ref", F.lit("").alias("section_hint"), evidence.alias("evidence"), (F.col("value") == "").alias("value_is_empty"), F.coalesce(dated_value(F.col("_fv")), F.lit(False)).alias("value_has_date_like"))


def instrument_number(*keys: Column) -> Column:
    """EXT22: the first that isn't empty."""
    return F.coalesce(*[filled(k) for k in keys])


def with_snapshot_text(df: DataFrame, snapshots: DataFrame, path: str = "json_path") -> DataFrame:
    """EXT23: text and payload of the snapshot at a path: the payload whole as VARIANT (see tables.payload_value), null where
    the snapshots have none."""
    payload = F.col("payload") if "payload" in snapshots.columns else F.lit(None).cast("variant")
    side = snapshots.select(F.col(path).alias("_path"), F.col("snapshot.text").alias("snapshot_text"), payload.alias("snapshot_payload"))
    return df.join(side, F.col(path) == F.col("_path"), "left").drop("_path")

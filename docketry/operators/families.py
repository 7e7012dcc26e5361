"""The registry of document families: what a family is called, which classes it takes, how its record is made and what
is done with it at the end of a run.  A family is one FamilySpec; nothing else in the library needs to know it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, first_match
from ..functions.text import contains_any, fold
from . import classify as C
from .ordered import stored


def as_is(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class FamilySpec:
    """key names the family in requested_type; classes are the document classes that are its documents.  rules are header
    rules (tried in order on texts that no class of the library took) that add classes of its own.  extract makes the
    record's fields from classified rows; finalize gives what the run keeps of them.  skip are labels that aren't opened."""

    key: str
    label: str
    classes: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    extract: Callable[[DataFrame], DataFrame] = as_is
    finalize: Callable[[DataFrame], DataFrame] = as_is
    skip: tuple[str, ...] = field(default=C.SKIP)
    #: Every document of the family is taken, whatever its class (work plans are validated by content).
    any_class: bool = False


class Registry:
    """Families by key, in the order of registration; a key that is registered again replaces its family."""

    def __init__(self, specs: Iterable[FamilySpec] = ()):
        self.specs: dict[str, FamilySpec] = {}
        for spec in specs:
            self.add(spec)

    def add(self, spec: FamilySpec) -> Registry:
        self.specs[spec.key] = spec
        return self

    def __iter__(self):
        return iter(self.specs.values())

    def wanted(self, c: Column, default: str | None = None) -> Column:
        """CLS15 over the registered families: distinct known keys of a comma list, in order; the default (the first
        family) if none is left."""
        return C.family_list(c, tuple(self.specs), default or next(iter(self.specs)))

    def classified(self, bronze: DataFrame) -> DataFrame:
        """CLS1 with the families' own rules behind the library's: adds the columns of blobs() and classify(), and family,
        the key of the registered family that requested_type names (folded), else null."""
        df = C.classify(C.blobs(bronze))
        rules = [r for spec in self for r in spec.rules]
        if rules:
            own = first_match(F.col("rejection"), rules)
            hit = contains_any(F.col("rejection"), [m for r in rules for m in r.any_of])
            mine = (F.col("doc_class") == "email_outro") & (F.col("classification_reason") == "conteudo_nao_classificado") & hit
            df = df.withColumn("_own", F.when(mine, own))
            df = df.withColumns({"doc_class": F.coalesce("_own.label", "doc_class"), "classification_reason": F.coalesce("_own.reason", "classification_reason"), "resolved_document_type": F.coalesce("_own.label", "resolved_document_type")}).drop("_own")
        asked = fold(F.coalesce("requested_type", F.lit("")))
        # a key that folding leaves as it is needs no folding where it is named as it is
        plain = [k for k in self.specs if k.isascii() and k == " ".join(k.lower().split())]
        return df.withColumn("family", F.when(F.col("requested_type").isin(*plain), F.col("requested_type")).when(asked.isin(*self.specs), asked))

    def accepted(self) -> Column:
        """The row is a document of its family."""
        out = F.lit(False)
        for spec in self:
            out = out | ((F.col("family") == spec.key) & (F.lit(True) if spec.any_class else F.col("doc_class").isin(*spec.classes)))
        return F.coalesce(out, F.lit(False))

    def dispatch(self, bronze: DataFrame, only: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """Each family's records of (processo, requested_type, title, text, chosen, json_path, row_idx, ...).

        Bronze is read, folded and classified once and stored; every family reads its own rows of that, makes its record and
        finalizes it.  Rows of no registered family are in none.  Families without rows give an empty table."""
        rows = self.classified(bronze)
        rows = rows.withColumn("accepted", self.accepted()).where("family IS NOT NULL")
        rows = C.unpacked(stored(C.packed(rows)), rows.columns)
        keys = list(self.specs) if only is None else [k for k in self.specs if k in set(only)]
        return {k: self.specs[k].finalize(self.specs[k].extract(rows.where(F.col("family") == k))) for k in keys}

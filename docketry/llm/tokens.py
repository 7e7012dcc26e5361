"""Token counts by a count-only Viterbi: Aho-Corasick enumerates the unigram pieces that end at each character, and
dynamic programming carries the best score and its number of pieces, with the tokenizer's own tie rule."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK, UNKNOWN_PENALTY = "▁", 10.0
#: Characters of the words whose counts a worker remembers, and the longest word that it does remember.
REMEMBERED, LONGEST = 14_000_000, 64
#: What a remembered word costs beside its characters, in characters.
ENTRY = 20
#: The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0  -     　"
_word = re.compile(f"[^{WHITE_SPACE}]+")
_byte = re.compile("<0x[0-9A-F]{2}>")


def vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, log-probability) of a sentencepiece file, unknown first, control pieces left out.

    A unigram model's scores are log-probabilities and stay.  The scores of a BPE file are minus its ranks, no
    log-probabilities; its pieces get Zipf's, 1 / (rank + 1) normalised.  Byte pieces get the least score."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {i: model.get_score(i) for i in usual}
    if usual and all(s == int(s) for s in scores.values()):
        whole = math.log(sum(1 / (k + 1) for k in range(len(usual))))
        scores = {i: -math.log(1 + max(0.0, -scores[i])) - whole for i in usual}
    least = min(scores.values(), default=0.0)
    return [("<unk>", least), *((model.id_to_piece(i), least) for i in range(model.get_piece_size()) if model.is_byte(i)), *((model.id_to_piece(i), scores[i]) for i in usual)]


class Counter(dict):
    """Word -> pieces of its best segmentation; the mark stands before each word, as in a metaspace pre-tokenizer."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.held = 0
        self.pieces = ahocorasick.Automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = sum(bool(_byte.fullmatch(p)) for p, _ in pieces) == 256
        self.longest = max((len(p) for p, _ in pieces), default=1) or 1
        for piece, score in pieces:
            if piece:
                self.pieces.add_word(piece, (len(piece), score))
        if len(self.pieces):
            self.pieces.make_automaton()

    def __missing__(self, word: str) -> int:
        if MARK in word:  # a mark of the text's own begins a part, and stands for the one before the word
            parts = re.findall(f"{MARK}[^{MARK}]*", word if word.startswith(MARK) else MARK + word)
            n = sum(self.segment(p)[1] for p in parts)
        else:
            n = self.segment(MARK + word)[1]
        if len(word) <= LONGEST:
            if self.held > REMEMBERED:
                self.clear()
                self.held = 0
            self[word] = n
            self.held += len(word) + ENTRY
        return n

    def segment(self, text: str) -> tuple[float, int]:
        """Best score and number of pieces, in one pass: the pieces that end at a character are used as they are found, and
        only the last characters' scores, counts and marks are kept.

        Paths to a character are compared from the earliest start to the latest and only a larger score replaces one,
        so of equal scores the longest last piece stays.  A character without a piece of its own may be unknown; it
        counts its bytes where there are byte pieces, else a run of unknown characters counts one."""
        keep = self.longest + 1
        score, count, lost = [0.0] * keep, [0] * keep, [False] * keep  # of the last characters, in a ring
        found = self.pieces.iter(text) if len(self.pieces) else iter(())
        ahead = next(found, None)
        for end in range(1, len(text) + 1):
            best, pieces, astray, alone = None, 0, False, False
            while ahead is not None and ahead[0] == end - 1:  # of one end, longer pieces come first
                length, s = ahead[1]
                alone |= length == 1
                now = s + score[(end - length) % keep]
                if best is None or now > best:
                    best, pieces, astray = now, count[(end - length) % keep] + 1, False
                ahead = next(found, None)
            if not alone:
                before = (end - 1) % keep
                now = self.unknown + score[before]
                if best is None or now > best:
                    more = len(text[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else 0 if lost[before] else 1
                    best, pieces, astray = now, count[before] + more, True
            score[end % keep], count[end % keep], lost[end % keep] = best, pieces, astray
        return score[len(text) % keep], count[len(text) % keep]

    def count(self, text: str) -> tuple[int, int]:
        """Pieces and words of a whole text."""
        words = _word.findall(text)
        return sum(map(self.__getitem__, words)), len(words)


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], columns: list[str] = ("doc_id",)) -> DataFrame:
    """The given columns of docs, with n_tokens and n_words (runs without Unicode white space).

    A text is split at white space, each word gets the mark and is segmented on its own, as a unigram tokenizer with a
    white-space split and a metaspace does.  Null and empty texts and texts of white space have 0.  A word of any
    length costs its length times the longest piece, and memory for the longest piece; a worker remembers the counts of
    words of up to LONGEST characters, REMEMBERED characters of them at most.  Input columns n_tokens and n_words are replaced."""
    columns = [c for c in columns if c not in ("n_tokens", "n_words")]
    docs = docs.select(F.col("text").alias("_text"), *columns)
    sent = docs.sparkSession.sparkContext.broadcast(pieces)  # the vocabulary, whatever the input
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in columns) + ", n_tokens long, n_words long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for batch in batches:
            rows = [counter.count(t.as_py() or "") for t in batch.column(0)]
            yield pa.record_batch([*batch.columns[1:], *(pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1))], [*columns, "n_tokens", "n_words"])

    return docs.mapInArrow(run, schema)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary())

"""Token counts by a count-only Viterbi search over a unigram vocabulary.

Each word is searched once per worker: an Aho-Corasick automaton lists the pieces that end at each place, and the dynamic
program carries only the best score and its number of pieces, no path. Ties are settled as the tokenizers library's unigram
model does: a later candidate wins only with a strictly higher score, candidates come in order of where they start, a
character without a piece of its own costs 10 more than the worst piece, and a run of such characters is one piece.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fixed values of unigram models: the mark for a space, the cost of an unknown character.
SPACE, UNKNOWN_COST = "▁", 10.0
#: Words remembered by a worker; when full, they are forgotten.
WORDS = 600_000


def default_vocabulary() -> str:
    """Path of the public 32k piece vocabulary, whose scores are its ranks."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of all normal pieces in a sentencepiece model file; control, unknown and byte pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        if not pieces:
            raise ValueError("the vocabulary is empty")
        self._trie = ahocorasick.Automaton()
        for piece, score in pieces:
            self._trie.add_word(piece, (len(piece), score))
        self._trie.make_automaton()
        self._unknown = min(score for _, score in pieces) - UNKNOWN_COST
        self._known: dict[str, tuple[int, float]] = {}

    def search(self, word: str) -> tuple[int, float]:
        """(pieces, score) of one word that already has its space mark."""
        n, worst = len(word), self._unknown
        best, count, unknown = [0.0], [0], False
        at, top, pieces, single = 1, None, 0, False
        # Matches come by where they end, for one end the longest first.
        for end, match in itertools.chain(self._trie.iter(word), ((n, None),)):
            while at <= end:  # all matches that end at this place are known
                if not single and (top is None or worst + best[-1] > top):
                    top, pieces, was = worst + best[-1], count[-1] + (not unknown), True
                else:
                    was = False
                best.append(top)
                count.append(pieces)
                unknown, top, single = was, None, False
                at += 1
            if match:
                size, score = match
                score += best[at - size]
                if top is None or score > top:
                    top, pieces = score, count[at - size] + 1
                single |= size == 1
        return count[n], best[n]

    def count(self, text: str) -> tuple[int, int, float]:
        """(words, pieces, score) of a text; a word is what stands between spaces or their marks, with one mark before it."""
        if not text:
            return 0, 0, 0.0
        words, known, pieces, score = text.replace(SPACE, " ").split(" "), self._known, 0, 0.0
        if words[0] == "":
            words = words[1:]
        for w in words:
            found = known.get(w)
            if found is None:
                found = self.search(SPACE + w)
                if len(w) <= 64:
                    if len(known) >= WORDS:
                        known.clear()
                    known[w] = found
            pieces += found[0]
            score += found[1]
        return len(words), pieces, score


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(read_pieces(path))


def count_tokens(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens, score (sum of log scores) of every row's whole text.

    A null or empty text has no words and no tokens, a null id is carried, repeated rows are counted once each, an empty
    table gives no rows, other columns are ignored. Very long words are searched in time linear in their length.
    The mark U+2581 in a text is a space, as in the library; ties go to the candidate that starts first.
    """
    common.ship(docs.sparkSession)
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            rows = [c.count(x.as_py() or "") for x in batch.column(1)]
            words, pieces, scores = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(pieces, pa.int64()), pa.array(scores, pa.float64())], ["doc_id", "n_words", "n_tokens", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_words long, n_tokens long, score double")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(common.table(spark, sf_dir, "documents"))

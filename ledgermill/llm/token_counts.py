"""Token counts without tokens: Viterbi over a unigram vocabulary, carrying only the best score and its piece count.

An Aho-Corasick automaton enumerates the pieces that end at each place of a word, longest first. The tokenizer's rules
are kept exactly: sums run from the left in double precision; of equal scores the one that starts first, the longest
last piece, stays; a character that is no piece by itself may be unknown at the least score less 10 and then counts a
byte piece for each of its UTF-8 bytes. Pieces don't cross words, so a text's count is the sum of its words' counts, and
words are cached."""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import modest_batches, rows_of

#: What stands for the space before a word in the vocabulary.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Cached words of a Python worker, and the longest of them in bytes: about 60 MB. In scripts without spaces a word can be
#: a paragraph; long words hardly come again.
CACHE_WORDS, CACHED_WORD = 400_000, 64
#: Bytes of a word up to which all its places are held; a longer one is read in slices of so many, and of its places only as
#: many are held as the longest piece has characters.
LONG_WORD = 1 << 16


class Counter(dict):
    """word in UTF-8 -> number of pieces of SPACE + word."""

    def __init__(self, pieces: Iterable[tuple[str, float]]):
        super().__init__()
        self.automaton, least, self.longest = ahocorasick.Automaton(), 0.0, 1
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
                self.longest = max(self.longest, len(piece))
            least = min(least, score)
        self.automaton.make_automaton()
        self.unknown = least - UNKNOWN_PENALTY

    def __missing__(self, word: bytes) -> int:
        n = self.pieces(SPACE + word.decode("utf-8", "replace")) if len(word) <= LONG_WORD else self.pieces_of_slices(word, LONG_WORD)
        if len(word) <= CACHED_WORD:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def pieces(self, text: str) -> int:
        unknown = self.unknown
        best: list[float | None] = [0.0] + [None] * len(text)
        count = [0] * (len(text) + 1)
        done = single = 0  # places up to `done` are final; `single` is the last one that a one-character piece ends at

        def close(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                if single != done:
                    score = best[done - 1] + unknown
                    if best[done] is None or score > best[done]:
                        best[done], count[done] = score, count[done - 1] + len(text[done - 1].encode("utf-8", "surrogatepass"))

        for at, (size, score) in self.automaton.iter(text):
            end = at + 1
            if done < at:
                close(at)
            start = end - size
            score += best[start]
            if best[end] is None or score > best[end]:
                best[end], count[end] = score, count[start] + 1
            if size == 1:
                single = end
        close(len(text))
        return count[-1]


    def pieces_of_slices(self, word: bytes, size: int) -> int:
        """pieces() of SPACE + word, in memory that doesn't grow with it: best and count are rings over the last places, of which only
        the one after `done` has been looked at. A slice is searched with what stands before it, as far as a piece may reach back;
        matches that end there have been seen."""
        unknown, mask, back = self.unknown, (1 << self.longest.bit_length()) - 1, self.longest - 1
        best: list[float | None] = [None] * (mask + 1)
        count = [0] * (mask + 1)
        best[0] = 0.0
        done = single = begin = 0  # text[0] stands at place `begin`
        decoder, text = codecs.getincrementaldecoder("utf-8")("replace"), SPACE
        for i in range(0, len(word), size):
            known = len(text) if i else 0
            text += decoder.decode(word[i : i + size], i + size >= len(word))
            for at, (length, score) in chain(self.automaton.iter(text), [(len(text), (0, 0.0))]):  # at last a match of nothing, which closes the slice
                if at < known:
                    continue
                while done < begin + at:
                    done += 1
                    here = done & mask
                    if single != done:
                        alone = best[(done - 1) & mask] + unknown
                        if best[here] is None or alone > best[here]:
                            best[here], count[here] = alone, count[(done - 1) & mask] + len(text[done - 1 - begin].encode("utf-8", "surrogatepass"))
                    best[(done + 1) & mask] = None
                if length:
                    end = begin + at + 1
                    here, start = end & mask, (end - length) & mask
                    score += best[start]
                    if best[here] is None or score > best[here]:
                        best[here], count[here] = score, count[start] + 1
                    if length == 1:
                        single = end
            begin += max(0, len(text) - back)
            text = text[max(0, len(text) - back) :]
        return count[done & mask]


def words(text: bytes) -> list[bytes]:
    """What the spaces of a text part; the sign for a space is one."""
    return text.replace(SPACE.encode(), b" ").split()


_counters: dict[str, Counter] = {}


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece model file."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=path)
    return [(p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size())]


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(vocabulary(path))
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: doc_id, n_words (runs of [^\\x20\\x09-\\x0D]), n_tokens. Null and blank texts: 0 and 0. Ids may
    repeat or be null; other columns aren't read. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary_path)
        for b in rows_of(batches, 256):
            texts = b.column(1).to_pylist()
            counts = [sum(map(c.__getitem__, words(t or b""))) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len((t or b"").split()) for t in texts], pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    slim = modest_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_tokens long").withColumnRenamed("doc_id", id_col)

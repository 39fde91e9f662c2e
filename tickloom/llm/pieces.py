"""Piece encoding and decoding by shared-prefix Viterbi.

A text is read as one blank followed by itself, blanks written as U+2581. It falls into marked words: blanks, then
everything up to the next blank. No piece of the vocabulary has a blank after another character, so the best segmentation
of a text is the best of each marked word. The distinct marked words of a block of documents are sorted, which lines them
up as the depth-first order of their trie; the forward scores of a word are kept for the next one as far as both agree,
so each node of the trie is scored once. Scores are the vocabulary's own; the sum is largest, and among equal sums the
longer last piece wins, at every end. A character that no piece covers becomes its UTF-8 bytes.

Decoding joins pieces, turns the marks back to blanks and takes off the first. It gives back every text without U+2581,
which is read as a blank.

Rows: a null or empty text has no ids and decodes to an empty text; a null doc_id is kept; repeated rows get equal
results. An empty table gives an empty result. No corpus-wide state: rows are encoded where they are read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import batch_of, blocks, bounds, gather, texts_of, worker_cache

MARK = "▁"
UNKNOWN = -1e12  # per character that no piece covers: below any sum of scores of a word
WORDS = 300_000  # marked words that a worker remembers; it forgets all beyond
_MARKED = re.compile(f"{MARK}+[^{MARK}]*")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    scores: dict[str, tuple[float, int]]  # piece -> score, id
    byte: list[int]  # id of each byte
    spelled: list[bytes]  # what each id decodes to

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte, spelled = {}, [0] * 256, []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                scores[piece] = (model.get_score(i), i)
                spelled.append(piece.replace(MARK, " ").encode())
        return cls(scores, byte, spelled)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.scores), default=1)
        # every beginning of a piece: the piece's score and id, or () where it only begins longer ones
        self.nodes: dict[str, tuple] = {piece[:n]: () for piece in self.scores for n in range(1, len(piece))} | self.scores

    def encode_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each word. In sorted order neighbours share most; any order gives the same ids."""
        node, longest = self.nodes.get, self.longest
        best, back, number = [0.0], [0], [-1]  # by end: the largest sum, where its last piece starts, which piece that is
        reach: list[int] = []  # by start: how far the vocabulary has a piece beginning like this
        before = ""
        for word in words:
            size, same = len(word), 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            fresh = size - same
            best[same + 1 :] = [-np.inf] * fresh
            back[same + 1 :] = [0] * fresh
            number[same + 1 :] = [-1] * fresh
            del reach[same:]
            for start in range(max(0, same - longest), size):
                sum_here = best[start]
                if start < same:
                    if reach[start] < same:
                        continue
                    end = same + 1
                else:
                    reach.append(start)
                    end = start + 1
                    if not node(word[start]) and sum_here + UNKNOWN > best[end]:
                        best[end], back[end], number[end] = sum_here + UNKNOWN, start, -1
                while end <= size:
                    found = node(word[start:end])
                    if found is None:
                        break
                    if found and sum_here + found[0] > best[end]:
                        best[end], back[end], number[end] = sum_here + found[0], start, found[1]
                    end += 1
                reach[start] = end - 1
            before = word
            ids: list[int] = []
            end = len(word)
            while end:
                if number[end] >= 0:
                    ids.append(number[end])
                else:
                    ids += [self.byte[b] for b in reversed(word[back[end] : end].encode())]
                end = back[end]
            ids.reverse()
            yield ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids))[1:]


def marked(text: str) -> list[str]:
    return _MARKED.findall(MARK + text.replace(" ", MARK)) if text else []


class _Encoder:
    """The ids of words seen before, in one array."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.starts, self.ids = array("q", [0]), array("i")

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > WORDS:
            self.clear()
        number = self.number
        fresh = sorted(set(words).difference(number))
        for word, ids in zip(fresh, self.vocabulary.encode_sorted(fresh)):
            number[word] = len(self.starts) - 1
            self.ids.extend(ids)
            self.starts.append(len(self.ids))
        chosen = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        starts = np.frombuffer(self.starts, np.int64)
        lengths = starts[chosen + 1] - starts[chosen]
        ids = np.frombuffer(self.ids, np.int32) if len(self.ids) else np.empty(0, np.int32)
        return gather(ids, starts[chosen], lengths), lengths


def _encoded(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder: _Encoder = worker_cache("pieces", f"encoder {path}", lambda: _Encoder(Vocabulary.load(path)))
        for ids, texts in blocks(batches, 2_000_000):
            words = [marked((t or b"").decode("utf-8")) for t in texts]
            tokens, lengths = encoder.encode([w for own in words for w in own])
            at = (4 * bounds(lengths)[bounds(map(len, words))]).tolist()
            data = tokens.astype("<u4").tobytes()
            yield batch_of(doc_id=pa.array(ids, pa.int64()), ids=pa.array([data[a:b] for a, b in zip(at, at[1:])], pa.binary()))

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id and ids, little-endian unsigned 32-bit numbers."""
    return texts_of(docs, id_col, text_col).mapInArrow(_encoded(path or default_vocabulary()), "doc_id long, ids binary")


def _decoded(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = worker_cache("pieces", f"vocabulary {path}", lambda: Vocabulary.load(path))
        for batch in batches:
            texts = [vocabulary.decode(np.frombuffer(v.as_py() or b"", "<u4").tolist()) for v in batch.column("ids")]
            yield batch_of(doc_id=batch.column("doc_id"), ids=batch.column("ids"), text=pa.array([t.decode("utf-8", "replace") for t in texts]))

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and the text they stand for; bytes that are no UTF-8 become U+FFFD, null ids an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(path or default_vocabulary()), "doc_id long, ids binary, text string")

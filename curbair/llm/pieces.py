"""SentencePiece encoding and decoding by Viterbi over a trie of distinct words.

Texts are cut where no piece of the model reaches across, which gives marked words
(the mark, U+2581, stands for a blank). The distinct words are sorted, so that walking
them in order is a depth-first traversal of their trie: the forward column of a prefix
is computed once and reused by every word below it.

The forward score of a prefix is the best sum of piece scores over its segmentations.
For a unigram model that is all. A BPE model adds a transition score between
neighbouring pieces: minus infinity if merging by rank would not leave the two side by
side, else zero. Pieces that pairwise stay side by side are exactly the model's own
segmentation, so one path is left per prefix and the ids equal the library's.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from curbair.llm.common import slices
from curbair.llm.words import WordTable

MARK = "▁"
#: Added to the lowest score for a character the model does not know.
UNKNOWN_PENALTY = 10.0
#: Pairs of pieces whose standing a task remembers, words it does, and bytes of text
#: that it holds as words.
PAIRS, REMEMBERED, TEXT_BYTES = 300_000, 250_000, 1 << 20


class PieceModel:
    """Pieces, scores and rules of a SentencePiece model file."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema

        if proto is None:
            with open(path, "rb") as file:
                proto = file.read()
        model = schema.ModelProto()
        model.ParseFromString(proto)
        if model.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models are supported")
        self.merges = model.trainer_spec.model_type == 2
        spec = model.normalizer_spec
        self._plain = (spec.name == "identity" and not spec.precompiled_charsmap and spec.add_dummy_prefix
                       and not spec.remove_extra_whitespaces and not model.trainer_spec.treat_whitespace_as_suffix)
        self._library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self._bytes = np.zeros(256, np.uint32)
        self._surface: list[bytes] = []
        kinds = schema.ModelProto.SentencePiece
        for i, piece in enumerate(model.pieces):
            text = b""
            if piece.type == kinds.BYTE:
                text = bytes([int(piece.piece[1:-1], 16)])
                self._bytes[text[0]] = i
            elif piece.type == kinds.NORMAL:
                self.ids[piece.piece], self.score[piece.piece] = i, piece.score
                text = piece.piece.replace(MARK, " ").encode()
            elif piece.type == kinds.UNKNOWN:
                self._unknown, text = i, model.trainer_spec.unk_surface.encode()
            elif piece.type != kinds.CONTROL:
                raise ValueError(f"piece {piece.piece} of a kind that is not supported")
            self._surface.append(text)
        self._fallback = model.trainer_spec.byte_fallback
        self._longest = max(map(len, self.ids))
        self._least = min(self.score.values()) - UNKNOWN_PENALTY
        self._stands: dict[tuple[str, str], bool] = {}
        self._reach()

    def _reach(self) -> None:
        """Which neighbouring characters some piece holds together."""
        pairs = {(p[i], p[i + 1]) for p in self.ids for i in range(len(p) - 1)}
        letters = sorted({c for pair in pairs for c in pair})
        self._index = np.zeros(0x110000, np.uint16)
        self._index[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self._joined = np.zeros((len(letters) + 1,) * 2, bool)
        for a, b in pairs:
            self._joined[self._index[ord(a)], self._index[ord(b)]] = True

    def normal(self, text: str | None) -> str:
        if not text:
            return ""
        return MARK + text.replace(" ", MARK) if self._plain else self._library.normalize(text)

    def words(self, text: str) -> list[str]:
        """A normal text cut wherever no piece reaches across."""
        if not text:
            return []
        at = self._index[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        cuts = (np.flatnonzero(~self._joined[at[:-1], at[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def merged(self, text: str) -> list[str]:
        """Merging by rank as the model defines it; used on short strings only."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, 0
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _side_by_side(self, a: str, b: str) -> bool:
        """Whether merging leaves ``b`` a piece of its own after ``a`` (or at the start)."""
        known = self._stands.get((a, b))
        if known is None:
            if len(self._stands) >= PAIRS:
                self._stands.clear()
            known = self._stands[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def segment(self, words: list[str]) -> Iterator[list[str]]:
        """Pieces of each of the sorted distinct ``words``.

        ``start`` and ``score`` are the forward columns along the current path of the
        trie: where the last piece of the prefix begins, and the prefix's best score.
        """
        ids, scores, longest, least = self.ids, self.score, self._longest, self._least
        start, score = [0], [0.0]
        before = ""
        for word in words:
            shared = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                shared += 1
            del start[shared + 1 :], score[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best, where = -np.inf, end - 1
                for j in range(max(0, end - longest), end):
                    piece = word[j:end]
                    if piece in ids:
                        value = score[j] + scores[piece]
                    elif j == end - 1:
                        value = score[j] + least
                    else:
                        continue
                    if self.merges:
                        if self._side_by_side(word[start[j] : j] if j else "", piece):
                            best, where = value, j
                            break  # no other path is left
                    elif value > best:
                        best, where = value, j
                start.append(where)
                score.append(best)
            before, end, out = word, len(word), []
            while end:
                out.append(word[start[end] : end])
                end = start[end]
            yield out[::-1]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sorted distinct words, and their number per word."""
        ids: list[int] = []
        ends = []
        for parts in self.segment(words):
            first = len(ids)
            for part in parts:
                known = self.ids.get(part)
                if known is not None:
                    ids.append(known)
                elif self._fallback:
                    ids.extend(self._bytes[list(part.encode("utf-8", "surrogatepass"))].tolist())
                elif len(ids) == first or ids[-1] != self._unknown:
                    ids.append(self._unknown)
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(ends, prepend=0)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a sequence of ids; the blank put in front on encoding goes."""
        data = b"".join(map(self._surface.__getitem__, ids))
        return data.removeprefix(b" ").decode("utf-8", "replace")


def _encoded(path: str, batches: Iterable[pa.RecordBatch], text_col: str):
    """(rows, texts, ids of all, bounds of each, model) slice by slice."""
    model = PieceModel(path)
    table = WordTable(model.encode_words, REMEMBERED)
    for part in slices(batches, text_col, TEXT_BYTES):
        texts = [model.normal(t) for t in part.column(text_col).to_pylist()]
        flat, counts = table.ids([model.words(t) for t in texts])
        yield part, texts, flat, np.concatenate([[0], np.cumsum(counts)]), model


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_out: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text as one more column.

    A NULL or empty text has no ids. All columns stay; one named like the result is
    replaced. The model file must be readable at ``model_path`` on every executor.
    """
    rows = docs.drop(ids_out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, flat, bounds, _ in _encoded(model_path, batches, text_col):
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, ids_out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(ids_out, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", text_out: str = "decoded") -> DataFrame:
    """``docs`` with the text of an id column as one more column; NULL ids give NULL."""
    rows = docs.drop(text_out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [None if ids is None else model.decode(ids) for ids in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text_out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text_out, T.StringType())]))


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, ``n_tokens``, ``ids_crc32`` (of the ids as little-endian
    32-bit integers) and ``round_trip``: whether decoding the ids gives the text back
    (a U+2581 of the text's own comes back as a blank and counts as equal).

    A NULL text counts as empty: no ids, and it comes back. Repeated rows give repeated
    results; an empty table an empty one; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts, flat, bounds, model in _encoded(model_path, batches, "text"):
            ends = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
            data = flat.astype("<u4")
            listed = flat.tolist()
            back = [model.decode(listed[a:b]) for a, b in ends]
            same = [d == t.replace(MARK, " ").removeprefix(" ") for d, t in zip(back, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(bounds), pa.int64()),
                 pa.array([zlib.crc32(data[a:b].tobytes()) for a, b in ends], pa.int64()), pa.array(same, pa.bool_())],
                names=["id", "n_tokens", "ids_crc32", "round_trip"])

    found = rows.mapInArrow(run, "id long, n_tokens long, ids_crc32 long, round_trip boolean")
    return found.withColumnRenamed("id", id_col)

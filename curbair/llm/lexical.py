"""Ranked lexical search by branch and bound over tries of documents.

1. One pass over all texts counts documents, terms and document frequencies, and keeps of
   each document only its terms that some item asks for (the items are the stated query
   set; their terms are broadcast in blocks of a fixed size).
2. These restricted vectors, terms ordered by falling document frequency, are dealt to
   tasks by ranges of their paths, so that documents with the same frequent terms meet and
   share the upper part of a trie. A path that very many documents have is cut by a hash.
3. A task builds tries of bounded size. A node holds, for the documents below it, the
   largest frequency of every term and the smallest length measure m. As a score grows with
   frequencies and falls with m, these bound it from above.
4. Each item walks every trie depth-first, the child with the highest bound first, and
   leaves out what cannot reach its k best any more. Walking a share of the documents
   first gives each item a score that its k best reach, where all later walks begin.

All scores are 64-bit integers, so bounds and results are exact.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curbair.llm.common import slices
from curbair.sources.staging import discard, staged

#: Bytes of item text whose terms are broadcast at once.
ITEM_BYTES = 16 << 20
#: Terms of documents that one trie holds, and documents of a leaf.
TRIE_TERMS, LEAF = 400_000, 32
#: Of this many documents one takes part in the first walk.
FIRST_SHARE = 16
TEXT_BYTES = 1 << 20
#: An id that stands for NULL in the order of ids: after all others.
_LAST = (1 << 63) - 1

_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a whole text: runs of ASCII letters and digits and of anything beyond
    ASCII, with only A-Z lower-cased. NULL has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def part_scores(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Scores of rows of term frequencies (one column per term of the item)."""
    return (1_000_000_000 * tf // (1000 * tf + 12 * m[:, None])) @ weight


class DocumentTrie:
    """Documents in the order of their paths, as a trie with bounds.

    ``sizes`` are the terms of each document, ``terms`` and ``tf`` those of all documents
    one after the other, ascending within a document; ``width`` is above any term.
    """

    def __init__(self, sizes, terms, tf, m, width: int, leaf: int = LEAF):
        self.m, self.width = m, width
        self._sizes, self._terms, self._leaf = sizes, terms, leaf
        self._start = np.concatenate([[0], np.cumsum(sizes)])
        self._doc_keys = np.repeat(np.arange(len(sizes)), sizes) * width + terms
        self._doc_tf = tf
        self.low, self.high, self.first = [0], [len(sizes)], []
        node = 0
        while node < len(self.low):  # breadth first: children of a node are neighbours
            cuts = self._split(self.low[node], self.high[node])
            self.first.append(len(self.low))
            self.low += cuts[:-1]
            self.high += cuts[1:]
            node += 1
        self.first.append(len(self.low))
        self._bounds()

    def _split(self, low: int, high: int) -> list[int]:
        """Where the documents of a node part; nothing for a leaf."""
        if high - low <= self._leaf:
            return []
        a, b = (self._terms[self._start[i] : self._start[i + 1]] for i in (low, high - 1))
        shortest = min(len(a), len(b))
        differ = np.flatnonzero(a[:shortest] != b[:shortest])
        depth = int(differ[0]) if len(differ) else shortest
        if depth == len(b):  # all have the same path
            return [*range(low, high, self._leaf), high]
        at = np.minimum(self._start[low:high] + depth, len(self._terms) - 1)
        branch = np.where(self._sizes[low:high] > depth, self._terms[at], -1)
        ends = (np.flatnonzero(np.diff(branch)) + 1 + low).tolist() + [high]
        cuts = [low]
        for end, following in zip(ends, [*ends[1:], None], strict=True):
            # small branches next to each other stay together as one leaf
            if following is None or following - cuts[-1] > self._leaf:
                cuts.append(end)
        return cuts

    def _bounds(self) -> None:
        terms: list = [None] * len(self.low)
        most: list = [None] * len(self.low)
        self.least_m = np.zeros(len(self.low), np.int64)
        for node in range(len(self.low) - 1, -1, -1):
            low, high = self.low[node], self.high[node]
            children = range(self.first[node], self.first[node + 1])
            if children:
                found, values = (np.concatenate(x[children.start : children.stop]) for x in (terms, most))
                self.least_m[node] = self.least_m[children.start : children.stop].min()
            else:
                found, values = (x[self._start[low] : self._start[high]] for x in (self._terms, self._doc_tf))
                self.least_m[node] = self.m[low:high].min()
            order = np.argsort(found, kind="stable")
            found = found[order]
            start = np.flatnonzero(np.diff(found, prepend=-1))
            terms[node], most[node] = found[start], np.maximum.reduceat(values[order], start) if len(start) else values
        self._node_keys = np.repeat(np.arange(len(terms)), list(map(len, terms))) * self.width + np.concatenate(terms)
        self._node_tf = np.concatenate(most)

    def _looked_up(self, keys, values, low: int, high: int, terms) -> np.ndarray:
        probe = np.arange(low, high)[:, None] * self.width + terms
        at = np.searchsorted(keys, probe)
        at[at == len(keys)] = 0
        return np.where(keys[at] == probe, values[at], 0)

    def bounds(self, low: int, high: int, terms, weight) -> np.ndarray:
        """Upper bounds of the scores below neighbouring nodes."""
        tf = self._looked_up(self._node_keys, self._node_tf, low, high, terms)
        return part_scores(tf, self.least_m[low:high], weight)

    def scores(self, low: int, high: int, terms, weight) -> np.ndarray:
        """Scores of neighbouring documents."""
        return part_scores(self._looked_up(self._doc_keys, self._doc_tf, low, high, terms), self.m[low:high], weight)

    def walk(self, terms, weight, least: int, k: int, best: list, order: list[int]) -> int:
        """Put the trie's documents among the k ``best`` of an item (a heap of (score,
        minus order, order)); ``least`` is a score below which nothing counts. Returns
        the number of documents scored."""
        scored = 0
        stack = [(int(self.bounds(0, 1, terms, weight)[0]), 0)]
        while stack:
            bound, node = stack.pop()
            if bound < (max(least, best[0][0]) if len(best) == k else least):
                continue
            children = range(self.first[node], self.first[node + 1])
            if children:
                bounds = self.bounds(children.start, children.stop, terms, weight)
                rising = np.argsort(bounds, kind="stable")
                stack += zip(bounds[rising].tolist(), (rising + children.start).tolist(), strict=True)
                continue
            low, high = self.low[node], self.high[node]
            scored += high - low
            found = self.scores(low, high, terms, weight)
            for i in np.flatnonzero(found >= (max(least, best[0][0]) if len(best) == k else least)).tolist():
                entry = (int(found[i]), -order[low + i], order[low + i])
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored


_VECTORS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tf", pa.binary()),
                      ("documents", pa.int64()), ("df", pa.list_(pa.int64()))])
_VECTORS_DDL = "id long, n long, terms binary, tf binary, documents long, df array<long>"


def _restrict(vocabulary):
    """Documents' terms that are in the vocabulary; at the end what the task counted."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        look = number.get
        df, documents, total = np.zeros(len(number), np.int64), 0, 0
        for part in slices(batches, "text", TEXT_BYTES):
            out: list[list] = [[], [], [], []]
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = terms_of(text)
                if not words:
                    continue
                documents, total = documents + 1, total + len(words)
                found = Counter(map(look, words))
                found.pop(None, None)
                if found:
                    terms = np.fromiter(found, np.uint32, len(found))
                    df[terms] += 1
                    for column, value in zip(out, (doc, len(words), terms.tobytes(), np.fromiter(
                            found.values(), np.uint32, len(found)).tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(v, f.type) for v, f in zip(out, _VECTORS, strict=False)),
                 pa.nulls(len(out[0]), pa.int64()), pa.nulls(len(out[0]), pa.list_(pa.int64()))], schema=_VECTORS)
        yield pa.RecordBatch.from_pylist([{"n": total, "documents": documents, "df": df}], _VECTORS)

    return run


def _path(rank):
    """Vectors with terms as ranks by falling frequency, ascending, in big-endian form, so
    that the order of bytes is that of paths."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank.value
        for part in slices(batches, "terms", TEXT_BYTES):
            paths, tfs = [], []
            for terms, tf in zip(part.column("terms").to_pylist(), part.column("tf").to_pylist(), strict=True):
                found = ranks[np.frombuffer(terms, np.uint32)]
                order = np.argsort(found)
                paths.append(found[order].astype(">u4").tobytes())
                tfs.append(np.frombuffer(tf, np.uint32)[order].tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("n"), pa.array(paths, pa.binary()), pa.array(tfs, pa.binary())],
                names=["id", "n", "path", "tf"])

    return run


_FOUND = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "item int, item_id long, id long, score long"


def _walks(asked, k: int, trie_terms: int, leaf: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least, documents, total, width = asked.value
        best: list[list] = [[] for _ in items]
        held: list[tuple] = []

        def search() -> None:
            ids, n, sizes, terms, tf = zip(*held, strict=True)
            held.clear()
            order = [_LAST if i is None else i for part in ids for i in part]
            m = 75 + 25 * np.concatenate(n) * documents // total
            trie = DocumentTrie(*map(np.concatenate, (sizes, terms, tf)), m, width, leaf)
            for i, (_, asked_terms, weight) in enumerate(items):
                trie.walk(asked_terms, weight, least[i], k, best[i], order)

        count = 0
        for part in slices(batches, "path", TEXT_BYTES):
            paths = part.column("path").to_pylist()
            terms = np.frombuffer(b"".join(paths), ">u4").astype(np.int64)
            tf = np.frombuffer(b"".join(part.column("tf").to_pylist()), np.uint32).astype(np.int64)
            held.append((part.column("id").to_pylist(), part.column("n").to_numpy(),
                         np.array(list(map(len, paths)), np.int64) // 4, terms, tf))
            count += len(terms)
            if count >= trie_terms:
                search()
                count = 0
        if held:
            search()
        for i, found in enumerate(best):
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(found), pa.int32()), pa.array([items[i][0]] * len(found), pa.int64()),
                     pa.array([None if e[2] == _LAST else e[2] for e in found], pa.int64()),
                     pa.array([e[0] for e in found], pa.int64())], schema=_FOUND)

    return run


def _item_blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """The items with terms, block by block; repeated rows are items of their own."""
    bytes_in_all = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = bytes_in_all // limit + 1
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        found = [(row.id, Counter(terms_of(row.text))) for row in rows]
        yield [(name, terms) for name, terms in found if terms]


def _best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES,
    trie_terms: int = TRIE_TERMS, leaf: int = LEAF,
) -> DataFrame:
    """Per item its ``k`` documents of highest score above 0: item id, ``rank`` (from 1),
    document id and ``score``; equal scores by ascending document id, NULL ids last.

    A document without terms (NULL, empty or only other characters) is not counted and
    not found; an item without terms has no rows. Repeated rows of either table count and
    are ranked as often as they stand there. Other columns are not read. An empty table
    on either side gives an empty table. ``item_bytes``, ``trie_terms`` and ``leaf`` change
    the work only.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_id_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    blocks = [_search_block(rows, block, k, trie_terms, leaf) for block in _item_blocks(asked, item_bytes) if block]
    found = spark.createDataFrame([], f"{_FOUND_DDL}, rank int")
    for part in blocks:
        found = found.unionByName(part)
    return found.select(F.col("item_id").alias(item_id_col), "rank", F.col("id").alias(id_col), "score")


def _search_block(rows: DataFrame, block: list, k: int, trie_terms: int, leaf: int) -> DataFrame:
    spark = rows.sparkSession
    context = spark.sparkContext
    vocabulary = {term: i for i, term in enumerate(sorted({t for _, terms in block for t in terms}))}
    vectors = staged(rows.mapInArrow(_restrict(context.broadcast(vocabulary)), _VECTORS_DDL), "term-vectors")

    counted = vectors.filter("df is not null")
    documents, total = counted.agg(F.sum("documents"), F.sum("n")).first()
    if not documents:
        discard(vectors)
        return spark.createDataFrame([], f"{_FOUND_DDL}, rank int")
    df = np.zeros(len(vocabulary), np.int64)
    sums = counted.select(F.posexplode("df").alias("term", "n")).filter("n > 0").groupBy("term").agg(F.sum("n").alias("n"))
    for term, n in sums.collect():  # one row per term of the block
        df[term] = n
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df]
    items = []
    for name, terms in block:
        numbers = [vocabulary[t] for t in terms]
        items.append((name, rank[numbers], np.array([weight[i] * c for i, c in zip(numbers, terms.values(), strict=True)], np.int64)))

    # by ranges of the path's beginning; a beginning that many share is cut by the hash
    paths = vectors.filter("df is null").select("id", "n", "terms", "tf").mapInArrow(
        _path(context.broadcast(rank)), "id long, n long, path binary, tf binary")
    dealt = staged(
        paths.repartitionByRange(F.substring("path", 1, 64), F.xxhash64("id", "path"))
        .sortWithinPartitions("path", "id"), "paths")
    discard(vectors)

    def walked(some: DataFrame, least: list[int]) -> DataFrame:
        known = context.broadcast((items, least, documents, total, len(vocabulary)))
        return some.mapInArrow(_walks(known, k, trie_terms, leaf), _FOUND_DDL)

    lowest = [1] * len(items)
    first = _best_of(walked(dealt.filter(F.pmod(F.xxhash64("path", "id"), F.lit(FIRST_SHARE)) == 0), lowest), k)
    least = list(lowest)
    for item, score in first.filter(F.col("rank") == k).select("item", "score").collect():  # one row per item
        least[item] = score
    return _best_of(walked(dealt, least), k)

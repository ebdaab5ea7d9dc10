"""N-gram Jaccard join of documents by grouped prefixes.

Two documents link when their sets of word shingles have a Jaccard similarity of at
least ``percent`` / 100. The join is exact up to the 64-bit hashes that stand for
shingles, and runs in these steps:

1. One pass over all texts gives each document its set's size and 128-bit signature.
   Equal sets form one class; only one document of a class goes on. The pass also counts
   shingles, by as many upper bits of their hashes as the amount of text asks for: a
   block of documents sends its distinct values to the tasks that hold their ranges, each
   once with a count, and learns which of them occur elsewhere too.
2. Shingles are ordered rare first (by count, then by value). Linked sets share one of the
   first ``n - ceil(n * percent / 100) + 1`` shingles of either; those that occur once
   meet nothing, and a document with enough of them is done. Classes with identical
   prefixes and sizes collapse into one group.
3. Groups meet on prefix shingles. Only links between different components matter, so
   each group first tests the one partner it shares most prefix shingles with (a star,
   not all pairs); then any two components that meet test one pair, turn by turn, as
   long as it pays.
4. What then still lies in different components is paired exhaustively: sizes,
   the positions of the shared shingle filter the pairs of groups, and survivors are
   expanded to members and verified.

Before two sets are fetched, the parities of their hashes' low bits, a few bits a
shingle, bound what they can share; most pairs that do not link end there.

Sets are verified as sorted arrays in Arrow batches. No group is ever held whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from curbair.llm.common import LOWER, fresh, pack, pack_sorted, slices, summed, unpack, unpack_sorted
from curbair.llm.components import connected_components
from curbair.llm.files import get, put, remove, task_name
from curbair.operators.joins import fits_broadcast, lookup_join
from curbair.sources.staging import discard, fresh_path, staged

#: Bytes of text whose shingles are counted together before they are sent on, and
#: shingles of one range of hashes.
BLOCK_BYTES, RANGE_SHINGLES = 8 << 20, 1 << 21
#: Bytes of text, and of sets to verify, that a task holds as objects.
TEXT_BYTES = 1 << 20
#: A side of a join up to this size is broadcast.
SMALL_BYTES = 8 << 20
#: A shingle that occurs about this often is met by a split join.
HOT_ROWS = 5000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words that stand in ``data``, one blank between neighbours: sums
    of a mixed value of every byte and its place in the word, mixed with the length."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _CHUNK)))
        low, high = starts[first], ends[last - 1]
        at, part = starts[first:last] - low, data[low:high]
        place = np.arange(high - low) - np.repeat(at, np.diff(at, append=high - low))
        values = _mixed((place << 8 | part).astype(np.uint64) * _ODD)
        values[part == 32] = 0
        out[first:last] = np.add.reduceat(values, at)
        first = last
    return _mixed(out + (ends - starts).astype(np.uint64) * _ODD)


def shingle_hashes(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``words`` words.

    A-Z is lower-cased; words are runs of anything but blanks (0x20, 0x09-0x0D). Fewer
    words form one shingle, none an empty set. Words are hashed one by one and combined
    in order by a mixing step each.
    """
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b" ".join(found), dtype=np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    hashed = _word_hashes(data, starts, ends)
    k = min(words, len(hashed))
    out = np.full(len(hashed) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mixed(out * _ODD + hashed[i : len(hashed) - k + 1 + i])
    return np.unique(out)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


_FIRST = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("sig", pa.binary()), ("mark", pa.int64()),
                    ("block", pa.int64()), ("uri", pa.string()), ("range", pa.int32()), ("values", pa.binary()),
                    ("counts", pa.binary())])
_FIRST_DDL = "id long, n int, sig binary, mark long, block long, uri string, range int, values binary, counts binary"


def _signature(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _mark(sig: bytes) -> int:
    """Half a signature: enough to tell texts under one id apart."""
    return int.from_bytes(sig[:8], "little", signed=True)


def _joined(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _parted(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        yield data[at + 8 : at + 8 + size]
        at += 8 + size


def _first_pass(words: int, bits: int, range_bits: int, folder: str):
    """Sizes and signatures of documents. Of every block of documents a file keeps the
    upper ``bits`` of all shingles in ascending order and whose each is; rows hold the
    distinct values and their counts, range by range."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = 0, 0
        held: tuple[list, list, list] = ([], [], [])

        def close() -> pa.RecordBatch:
            ids, signs, sets = held
            sizes = np.array(list(map(len, sets)), np.int64)
            values = (np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], np.repeat(np.arange(len(sets)), sizes)[order]
            known = np.array([i is not None for i in ids], np.int64)
            block = TaskContext.get().partitionId() << 32 | number
            uri = f"{folder}/{task_name('block', number, '.bin')}"
            put(uri, _joined([
                np.array([i or 0 for i in ids], np.int64).tobytes(), pack(known), b"".join(signs), pack(sizes),
                pack_sorted(values), pack(owner)]))
            values, counts = summed(values, np.ones_like(values))
            part = values >> (bits - range_bits)
            bounds = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            rows = [{"block": block, "uri": uri, "range": int(part[a]),
                     "values": pack_sorted(values[a:b] & ((1 << (bits - range_bits)) - 1)), "counts": pack(counts[a:b])}
                    for a, b in zip(bounds, [*bounds[1:], len(values)], strict=False)]
            for column in held:
                column.clear()
            return pa.RecordBatch.from_pylist(rows, _FIRST)

        for part in slices(batches, "text", TEXT_BYTES):
            sets = [shingle_hashes(text, words) for text in part.column("text").to_pylist()]
            signs = [_signature(hashes) for hashes in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(h) for h in sets], pa.int32()), pa.array(signs, pa.binary()),
                 pa.array(map(_mark, signs), pa.int64()), *(pa.nulls(len(sets), t) for t in _FIRST.types[4:])],
                schema=_FIRST)
            for column, values in zip(held, (part.column("id").to_pylist(), signs, sets), strict=True):
                column += values
            size += part.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield close()
                number, size = number + 1, 0
        if held[0]:
            yield close()

    return run


_REPEATED = pa.schema([("block", pa.int64()), ("uri", pa.string()), ("range", pa.int32()), ("values", pa.binary()),
                       ("heats", pa.binary())])


def _repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block's values those that occur twice or more in all blocks, with twice the
    logarithm of their count. The partition is sorted by range; one range is held."""
    held: list[dict] = []

    def done() -> pa.RecordBatch:
        values = [unpack_sorted(r["values"]) for r in held]
        ends = np.cumsum(list(map(len, values))).tolist()
        flat, at = np.unique(np.concatenate(values), return_inverse=True)
        counts = np.zeros(len(flat), np.int64)
        np.add.at(counts, at, np.concatenate([unpack(r["counts"]) for r in held]))
        heat = np.floor(2 * np.log2(counts)).astype(np.int64)
        out = []
        for row, own, start, end in zip(held, values, [0, *ends], ends, strict=False):
            heats = heat[at[start:end]]
            if heats.any():
                out.append({k: row[k] for k in ("block", "uri", "range")} | {
                    "values": pack_sorted(own[heats > 0]), "heats": pack(heats[heats > 0])})
        held.clear()
        return pa.RecordBatch.from_pylist(out, _REPEATED)

    for batch in batches:
        for row in (r for i in range(0, batch.num_rows, 64) for r in batch.slice(i, 64).to_pylist()):
            if held and row["range"] != held[0]["range"]:
                yield done()
            held.append(row)
    if held:
        yield done()


def _sets_of(part: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Class and set of each text; other texts under the same id are left out."""
    for cid, mark, text in zip(*(part.column(c).to_pylist() for c in ("cid", "mark", "text")), strict=True):
        hashes = shingle_hashes(text, words)
        if _mark(_signature(hashes)) == mark:
            yield cid, hashes


def parities(hashes: np.ndarray) -> bytes:
    """Size of a set (8 bytes), then how often each value of its low bits occurs, modulo 2.

    There are at least as many parities as hashes, and a power of two of them.
    """
    count = max(64, 1 << (len(hashes) - 1).bit_length())
    times = np.bincount((hashes & np.uint64(count - 1)).astype(np.int64), minlength=count)
    return len(hashes).to_bytes(8, "little") + np.packbits(times & 1, bitorder="little").tobytes()


def may_link(x: bytes, y: bytes, percent: int) -> bool:
    """Whether sets with these parities can be similar enough; never wrongly False.

    Each parity that differs stands for at least one hash that only one set has.
    """
    total = int.from_bytes(x[:8], "little") + int.from_bytes(y[:8], "little")
    a, b = np.frombuffer(x, np.uint64, offset=8), np.frombuffer(y, np.uint64, offset=8)
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    shared = (total - int(np.bitwise_count(a ^ b).sum())) // 2
    return (100 + percent) * shared >= percent * total


_PREFIX = pa.schema([("id", pa.int64()), ("sig", pa.binary()), ("n", pa.int32()), ("head", pa.int64()),
                     ("skip", pa.int32()), ("prefix", pa.list_(pa.int64())), ("hot", pa.list_(pa.bool_())),
                     ("parity", pa.binary())])
_PREFIX_DDL = "id long, sig binary, n int, head long, skip int, prefix array<long>, hot array<boolean>, parity binary"


def _prefixes(uri: str, values: np.ndarray, heats: np.ndarray, percent: int, hot: int) -> pa.RecordBatch:
    """Prefixes of the documents of one block, given its repeated values. ``skip`` of a
    prefix's shingles occur nowhere else and are left out; a document whose prefix has no
    others cannot link."""
    ids, known, signs, sizes, every, owner = _parted(get(uri))
    ids, known, sizes = np.frombuffer(ids, np.int64), unpack(known), unpack(sizes)
    every, owner = unpack_sorted(every), unpack(owner)
    at = np.searchsorted(values, every)
    at[at == len(values)] = 0
    found = values[at] == every
    again, heat, own = every[found], heats[at[found]], owner[found]
    order = np.lexsort((again, heat, own))
    again, heat, own = again[order], heat[order], own[order]
    shared = np.bincount(own, minlength=len(sizes))
    length = sizes - -(-sizes * percent // 100) + 1
    single = sizes - shared
    start = np.cumsum(shared) - shared
    picked = np.flatnonzero((sizes > 0) & (single < length))
    by_doc = np.argsort(owner, kind="stable")
    first = np.cumsum(sizes) - sizes
    out: list[list] = [[] for _ in _PREFIX]
    for doc in picked.tolist():
        a, b = int(start[doc]), int(start[doc] + length[doc] - single[doc])
        prefix = again[a:b]
        head = np.bitwise_xor.reduce(_mixed(prefix.astype(np.uint64) * _ODD))
        if single[doc]:  # no other document has this prefix
            head ^= np.frombuffer(signs, np.uint64, 1, 16 * doc)[0]
        whole = every[by_doc[first[doc] : first[doc] + sizes[doc]]]
        for column, value in zip(out, (
                int(ids[doc]) if known[doc] else None, signs[16 * doc : 16 * doc + 16], int(sizes[doc]), int(head.view(np.int64)),
                int(single[doc]), prefix, heat[a:b] >= hot, parities(whole.astype(np.uint64))), strict=True):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _PREFIX, strict=True)], schema=_PREFIX)


def _prefix_pass(percent: int, bits: int, range_bits: int, hot: int):
    """Prefixes block by block. The partition is sorted by block and range."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def done() -> pa.RecordBatch:
            values = np.concatenate([unpack_sorted(r["values"]) + (r["range"] << (bits - range_bits)) for r in held])
            heats = np.concatenate([unpack(r["heats"]) for r in held])
            uri = held[0]["uri"]
            held.clear()
            return _prefixes(uri, values, heats, percent, hot)

        for batch in batches:
            for row in (r for i in range(0, batch.num_rows, 64) for r in batch.slice(i, 64).to_pylist()):
                if held and row["block"] != held[0]["block"]:
                    yield done()
                held.append(row)
        if held:
            yield done()

    return run


_SETS = pa.schema([("cid", pa.int64()), ("hashes", pa.binary())])


def _set_pass(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            found = list(_sets_of(part, words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in found], pa.int64()),
                 pa.array([h.tobytes() for _, h in found], pa.binary())], schema=_SETS)

    return run


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_data = None, None
        for part in slices(batches, "x", TEXT_BYTES):
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            xs, ys = part.column("x"), part.column("y")
            keep = []
            for i, other in enumerate(b):
                if other != known:
                    known, known_data = other, np.frombuffer(ys[i].as_buffer(), np.uint64).copy()
                x = np.frombuffer(xs[i].as_buffer(), np.uint64)
                at = np.searchsorted(known_data, x)
                at[at == len(known_data)] = 0
                both = int(np.count_nonzero(known_data[at] == x))
                keep.append(100 * both >= percent * (len(x) + len(known_data) - both))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(a, keep, strict=True) if k], pa.int64()),
                 pa.array([v for v, k in zip(b, keep, strict=True) if k], pa.int64())], schema=_LINKS)

    return run


def _hopeful(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "x", TEXT_BYTES):
            ends = zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True)
            keep = pa.array([may_link(x, y, percent) for x, y in ends], pa.bool_())
            yield part.select(["a", "b"]).filter(keep)

    return run


def _judged(pairs: DataFrame, values: DataFrame, column: str, judge) -> DataFrame:
    """The pairs (a, b) that ``judge`` keeps, given the values (cid, ``column``) of both."""
    side = _small(pairs)
    left = values.join(side, values.cid == side.a).select("a", "b", F.col(column).alias("x"))
    right = values.join(
        _small(pairs.select("b").distinct()), F.col("cid") == F.col("b"), "left_semi"
    ).select(F.col("cid").alias("b"), F.col(column).alias("y"))
    met = left.hint("merge").join(right, "b").select("a", "b", "x", "y")
    return met.mapInArrow(judge, "a long, b long")


def _linked(pairs: DataFrame, parity: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, staged."""
    hopeful = staged(_judged(pairs, parity, "parity", _hopeful(percent)), "hopeful")
    links = staged(_judged(hopeful, sets, "hashes", _verify(percent)), "links")
    discard(hopeful)
    return links


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, SMALL_BYTES) else df


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(F.col(a), F.col(b)) >= percent * F.greatest(F.col(a), F.col(b))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    sketch_bits: int | None = None,
    rounds: int = 1,
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id``, ``sig`` and ``root``.

    ``component_id`` is the smallest id reachable by links, the document's own included.
    A text that is NULL or without words has no shingles and links with nothing; its
    component is its own id. Repeated rows give repeated results; rows that share an id
    but not a text are told apart by ``sig``, the signature of the set. A NULL id takes
    part but is the component's name only if no member has one. Other columns of
    ``docs`` are not read, whatever their names. An empty table gives an empty table.

    ``rounds`` bounds the star rounds before the exhaustive one, ``sketch_bits`` sets the
    bits of a hash by which shingles are counted (by default enough for the amount of
    text): both change the work, never the result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    # a shingle takes about as many bytes of text as a word
    about = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6 + 1
    bits = sketch_bits or min(60, about.bit_length() + 4)
    range_bits = min(bits, (about // RANGE_SHINGLES).bit_length())
    folder = fresh_path(spark, "shingles")
    first = staged(rows.mapInArrow(_first_pass(words, bits, range_bits, folder), _FIRST_DDL), "signs")
    signs = first.filter("range is null").select("id", "n", "sig", "mark")
    classes = staged(
        signs.filter("n > 0").groupBy("sig").agg(F.min("id").alias("first"), F.first("mark").alias("mark"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")

    blocks = first.filter("range is not null").select("block", "uri", "range", "values", "counts")
    repeated = blocks.repartition("range").sortWithinPartitions("range", "block").mapInArrow(
        _repeated, "block long, uri string, range int, values binary, heats binary")
    found = staged(repeated.repartition("block").sortWithinPartitions("block", "range").mapInArrow(
        _prefix_pass(percent, bits, range_bits, int(2 * np.log2(max(1, HOT_ROWS)))), _PREFIX_DDL), "candidates")
    # a class has one row: that of the document that stands for it
    named = classes.select("sig", F.col("first").alias("leader"), "cid")
    heads = staged(
        lookup_join(found, named, ["sig"], how="inner").filter(F.col("id").eqNullSafe(F.col("leader")))
        .dropDuplicates(["cid"]).drop("id", "sig", "leader"), "prefixes")
    discard(found)
    remove(spark, folder)
    roots = _components(rows, classes, heads, words, percent, rounds)

    # members of a component are classes; its name is the smallest id of them all
    classes_rooted = classes.join(roots, classes.cid == roots.node, "left").select(
        "sig", "first", F.coalesce("root", "cid").alias("root"))
    named = staged(
        classes_rooted.groupBy("root").agg(F.min("first").alias("component_id")), "names")
    by_sig = staged(classes_rooted.join(named, "root").select("sig", "component_id", "root"), "by-sig")
    discard(named, classes)
    joined = lookup_join(signs, by_sig, ["sig"])
    return joined.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "sig", "root")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without near duplicates: of each component the document that names it.

    All columns stay. Documents without shingles all stay. Rows that share an id are
    told apart by their sets, and of a component's rows one stays.
    """
    found = staged(near_duplicates(docs, id_col, text_col, **settings).withColumnRenamed(id_col, "id"), "near")
    leads = F.col("root").isNull() | F.col("id").eqNullSafe(F.col("component_id"))
    repeated = staged(found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"), "repeated")
    gone = staged(found.filter(~leads).select("id").unionByName(repeated).distinct(), "gone")
    gone = gone.withColumnRenamed("id", id_col)
    single = lookup_join(docs, gone, [id_col], how="left_anti", null_safe=True)
    if repeated.isEmpty():
        return single
    again = lookup_join(docs, repeated.withColumnRenamed("id", id_col), [id_col], how="left_semi", null_safe=True)
    sig, key = fresh(docs, "__sig"), fresh(docs, "__id")
    signed = again.mapInArrow(_signed(text_col, settings.get("words", 5)), T.StructType(
        [*docs.schema.fields, T.StructField(sig, T.BinaryType())])).withColumn(key, F.col(id_col).cast("long"))
    lead = found.filter(leads).select(F.col("id").alias(key), F.col("sig").alias(sig), "root").distinct()
    met = signed.join(lead, signed[key].eqNullSafe(lead[key]) & (signed[sig] == lead[sig])).select(
        *[signed[c] for c in docs.columns], lead["root"].alias(key))
    kept = met.filter(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(met.filter(F.col(key).isNull()))
    return single.unionByName(kept.select(docs.columns))


def _signed(text_col: str, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            signs = [hashlib.blake2b(shingle_hashes(t, words).tobytes(), digest_size=16).digest()
                     for t in part.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(signs, pa.binary())],
                                             names=[*part.schema.names, "__signature"])

    return run


def _texts_of(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Texts of the documents that stand for a class, with ``cid`` and ``mark``.

    Only the smallest id of a class can be NULL, if all are; it goes by a number of its
    own, and the mark tells its text from any other."""
    key = F.coalesce(F.col("id"), F.lit(-(1 << 63)))
    wanted = classes.select(F.col("first").alias("id"), "cid", "mark").withColumn("id", key)
    return lookup_join(rows.withColumn("id", key), wanted, ["id"], how="inner").select("cid", "mark", "text")


def _components(rows, classes, heads, words: int, percent: int, rounds: int) -> DataFrame:
    """(node, root) of the classes that links connect; only links that connect something
    more are looked for."""
    spark = rows.sparkSession
    groups = staged(heads.groupBy("head", "n").agg(
        F.min("cid").alias("gid"), F.count(F.lit(1)).alias("members")), "groups")
    # distinct prefixes with one hash would only cost work: members are verified anyway
    members = staged(heads.select("cid", "head", "n").join(
        groups.filter("members > 1"), ["head", "n"]).select("gid", "cid"), "members")

    met = staged(_met(heads, groups, percent), "met")
    involved = staged(met.select(F.col("gid").alias("cid")).unionByName(members.select("cid")).distinct(), "involved")
    parity = staged(heads.select("cid", "parity").join(_small(involved), "cid", "left_semi"), "parities")
    discard(heads, groups)
    sets = staged(_texts_of(rows, classes.join(involved, "cid"))
                  .mapInArrow(_set_pass(words), "cid long, hashes binary"), "sets")
    discard(involved)

    inside = members.filter("cid != gid").select(F.col("cid").alias("a"), F.col("gid").alias("b"))
    tested = staged(inside.unionByName(_star(met, percent)).distinct(), "tested")
    links = _linked(tested, parity, sets, percent)
    for turn in range(1, rounds + 2):
        labels = connected_components(links)
        open_rows, pairs = _open_rows(met, members, labels)
        if turn > rounds or pairs <= 4 * open_rows.count():
            break
        stars = staged(_between(open_rows, tested, turn, percent), "stars")
        more = _linked(stars, parity, sets, percent)
        tested = staged(tested.unionByName(stars), "tested")
        links = staged(links.unionByName(more), "links")
        if more.count() * 50 < stars.count():
            break  # hardly any pair links now: the rest is for the exhaustive step
    rest = staged(_rest(open_rows, members, labels, tested, percent), "rest")
    discard(met, members, open_rows, tested)
    if rest.isEmpty():
        found = labels
    else:
        stars = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
        found = connected_components(stars.unionByName(links).unionByName(_linked(rest, parity, sets, percent)))
    discard(sets, parity, rest)
    return found


def _met(heads: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Rows (token, gid, n, pos) of prefix shingles that at least two groups have, left
    out where no other group's size fits."""
    leaders = heads.join(_small(groups.select(F.col("gid").alias("cid"))), "cid", "left_semi")
    rows = leaders.select(
        F.col("cid").alias("gid"), "n", "skip", F.posexplode(F.arrays_zip("prefix", "hot")).alias("pos", "item")
    ).select(F.col("item.prefix").alias("token"), "gid", "n", (F.col("pos") + F.col("skip")).alias("pos"),
             F.col("item.hot").alias("hot"))
    # in the order of sizes only a neighbour can be the nearest: without one that fits,
    # none does; of just two groups the positions tell as well
    token = Window.partitionBy("token")
    by_size = token.orderBy("n")

    def fits(other) -> Column:
        n, pos = other("n").over(by_size), other("pos").over(by_size)
        near = 100 * F.least("n", n) >= percent * F.greatest("n", n)
        least = F.ceil(F.lit(percent) * (F.col("n") + n) / F.lit(100 + percent))
        ahead = F.least(F.col("n") - F.col("pos"), n - pos) >= least
        return F.coalesce(near & (ahead | (F.count(F.lit(1)).over(token) > 2)) & n.isNotNull(), F.lit(False))

    cool = rows.filter("not hot").withColumn("fits", fits(F.lag) | fits(F.lead)).filter("fits")
    hot = rows.filter("hot")
    shared = hot.groupBy("token").agg(F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    columns = ["token", "gid", "n", "pos"]
    return cool.select(columns).unionByName(hot.join(shared, "token").select(columns))


def _star(met: DataFrame, percent: int) -> DataFrame:
    """For each group the one partner it shares most prefix shingles with, of those that a
    shingle offers: per size band the group with the fewest rarer shingles, which is the
    nearest to what its like share."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)))
    rows = met.withColumn("band", band)
    offered = rows.groupBy("token", "band").agg(F.min(F.struct("pos", "gid", "n")).alias("o")).select(
        "token", "band", F.col("o.gid").alias("b"), F.col("o.n").alias("nb"))
    pairs = rows.join(offered, ["token", "band"]).filter(_sizes_fit("n", "nb", percent) & (F.col("gid") != F.col("b")))
    counted = pairs.groupBy(F.col("gid").alias("a"), "b").agg(F.count(F.lit(1)).alias("shared"))
    return counted.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("best")).select("a", F.col("best.b").alias("b"))


def _between(open_rows: DataFrame, tested: DataFrame, turn: int, percent: int) -> DataFrame:
    """One untested pair of groups (a, b) for any two components that meet on a shingle.

    A component has one group per shingle to stand for it, another one every turn: what
    meets are components, however many groups they have. A group whose members are of
    different components stands for itself.
    """
    own = F.coalesce(F.col("label"), -F.col("gid") - 1).alias("own")
    # the draw is by component and turn, so that a pair is found on many shingles alike
    chosen = open_rows.groupBy("token", own).agg(
        F.min(F.struct(F.xxhash64("gid", F.lit(turn)).alias("draw"), "gid", "n", "pos")).alias("r")).select("token", "own", "r.gid", "r.n", "r.pos")
    columns = ("own", "gid", "n", "pos")
    left = chosen.select("token", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = chosen.select(F.col("token").alias("other"), *[F.col(c).alias(f"{c}_b") for c in columns])
    met = left.join(right, (F.col("token") == F.col("other")) & (F.col("own_a") < F.col("own_b")) & _may_share(percent))
    pairs = met.groupBy("own_a", "own_b").agg(F.min(F.struct(
        F.xxhash64("gid_a", "gid_b", F.lit(turn)), F.greatest("gid_a", "gid_b").alias("a"), F.least("gid_a", "gid_b").alias("b"))).alias("p"))
    seen = tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.select("p.a", "p.b").distinct().join(seen, ["a", "b"], "left_anti")


def _may_share(percent: int) -> Column:
    """Whether two groups (n_a, pos_a, n_b, pos_b) can have enough in common behind the
    shingle they meet on, if it is the first that they share."""
    least = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    return _sizes_fit("n_a", "n_b", percent) & (
        F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= least)


def _open_rows(met: DataFrame, members: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Rows of shingles that still meet different components, with the group's label,
    and a bound on the pairs they hold. A group whose members differ has label NULL."""
    named = met.select("gid").distinct().join(labels, F.col("gid") == F.col("node"), "left").select(
        "gid", F.coalesce("root", "gid").alias("own"))
    inner = members.join(labels, F.col("cid") == F.col("node"), "left").groupBy("gid").agg(
        F.min(F.coalesce("root", "cid")).alias("low"), F.max(F.coalesce("root", "cid")).alias("high"))
    label = staged(named.join(inner, "gid", "left").select(
        "gid", F.when(F.col("low").isNull() | (F.col("low") == F.col("high")), F.col("own")).alias("label")), "labels")
    rows = met.join(_small(label), "gid")
    per = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(
        F.sum("k").alias("k"), F.sum(F.when(F.col("label").isNotNull(), F.col("k") * F.col("k")).otherwise(0)).alias("same"),
        F.count(F.lit(1)).alias("labels"), F.max(F.col("label").isNull()).alias("mixed"))
    still = staged(per.filter("labels > 1 or mixed").select("token", ((F.col("k") * F.col("k") - F.col("same")) / 2).alias("pairs")), "open")
    pairs = still.agg(F.sum("pairs")).first()[0] or 0
    return staged(rows.join(_small(still.select("token")), "token", "left_semi"), "open-rows"), int(pairs)


def _rest(open_rows, members, labels, tested, percent: int) -> DataFrame:
    """All pairs of classes in different components that pass the filters and are untested."""
    columns = ("gid", "n", "pos", "label")
    left = open_rows.select("token", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = open_rows.select(F.col("token").alias("other"), *[F.col(c).alias(f"{c}_b") for c in columns])
    # a condition of the join, so that a frequent shingle does not put out all pairs
    met = left.join(right, (F.col("token") == F.col("other")) & (F.col("gid_a") < F.col("gid_b"))
                    & ~F.coalesce(F.col("label_a") == F.col("label_b"), F.lit(False))
                    & _may_share(percent)
                    ).select(F.col("gid_a").alias("ga"), F.col("gid_b").alias("gb")).distinct()
    # groups stand for their members; within one, members of different components meet too
    within = members.select("gid").distinct().select(F.col("gid").alias("ga"), F.col("gid").alias("gb"))
    everyone = members.unionByName(
        open_rows.select("gid", F.col("gid").alias("cid")).join(members, ["gid", "cid"], "left_anti")).distinct()
    owned = everyone.join(labels, F.col("cid") == F.col("node"), "left").select("gid", "cid", F.coalesce("root", "cid").alias("own"))
    mixed = owned.groupBy("gid").agg(F.min("own").alias("low"), F.max("own").alias("high")).filter("low != high").select("gid")
    pairs = met.unionByName(within.join(mixed, F.col("ga") == F.col("gid"), "left_semi"))
    a = owned.select(F.col("gid").alias("ga"), F.col("cid").alias("x"), F.col("own").alias("own_a"))
    b = owned.select(F.col("gid").alias("gb"), F.col("cid").alias("y"), F.col("own").alias("own_b"))
    expanded = pairs.join(a, "ga").join(b, "gb").filter("own_a != own_b and (ga != gb or x < y)")
    ends = expanded.select(
        F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    seen = tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.join(seen, ["a", "b"], "left_anti")

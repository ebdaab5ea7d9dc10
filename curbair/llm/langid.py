"""Language identification with a small byte convolutional network.

Bytes are embedded, filters of several widths slide over fixed-length windows, each
filter keeps its maximum over a window, and a softmax layer turns the maxima into a
distribution over the languages seen in training. Training is plain numpy (Adam) on a
bounded sample; prediction covers every window of every text and averages them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from curbair.llm.common import fresh, slices

UNDETERMINED = "und"
#: Sample bounds: documents of a language, and windows taken from each.
DOCS_PER_LANG, WINDOWS_PER_DOC = 500, 4
WINDOW = 256
WIDTHS, FILTERS, EMBED = (2, 3, 4, 5), 8, 8
EPOCHS, BATCH, RATE, SEED = 6, 64, 0.01, 7


@dataclass
class ByteConvNet:
    """Parameters; filters of all widths share one matrix, narrow ones end in zeros."""

    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # (max width * EMBED) x filters
    bias: np.ndarray
    dense: np.ndarray  # filters x languages
    offset: np.ndarray

    def maxima(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per window and filter the largest response and, in place of its position, the map."""
        span = max(WIDTHS)
        x = self.embed[windows]
        n, length, _ = x.shape
        view = np.lib.stride_tricks.as_strided(
            x, (n, length - span + 1, span * EMBED), (x.strides[0], x.strides[1], x.strides[2]))
        maps = view.reshape(-1, span * EMBED) @ self.filters
        maps = maps.reshape(n, length - span + 1, -1)
        return maps.max(axis=1) + self.bias, maps

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return _softmax(np.maximum(self.maxima(windows)[0], 0) @ self.dense + self.offset)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(data: bytes, length: int = WINDOW) -> np.ndarray:
    """All windows of a text: ``length`` start positions each, and the bytes a filter
    looks ahead. Missing bytes are zeros. Empty data gives one empty window."""
    span = max(WIDTHS) - 1
    n = max(1, -(-len(data) // length))
    padded = np.zeros(n * length + span, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (n, length + span), (length, 1))


def train(texts: list[str], langs: list[str]) -> ByteConvNet | None:
    """Fit the network to short labelled texts; None if there is nothing to learn from."""
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(SEED)
    x = np.concatenate([windows_of(t.encode("utf-8", "replace")[:WINDOW]) for t in texts])
    y = np.searchsorted(names, langs)
    width = max(WIDTHS) * EMBED
    reach = np.repeat(WIDTHS, FILTERS) * EMBED  # a filter's weights beyond its width stay zero
    mask = (np.arange(width)[:, None] < reach).astype(np.float32)
    count = mask.shape[1]
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, 0.3, (width, count)) * mask,
        "bias": np.zeros(count), "dense": rng.normal(0, 0.1, (count, len(names))), "offset": np.zeros(len(names)),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    # every language weighs the same, however often it occurs
    weight = (len(y) / (len(names) * np.bincount(y, minlength=len(names)))).astype(np.float32)
    step, span = 0, max(WIDTHS)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            net = ByteConvNet(names, **p)
            top, maps = net.maxima(x[rows])
            peak = maps.argmax(axis=1)  # windows x filters
            hidden = np.maximum(top, 0)
            grad = _softmax(hidden @ p["dense"] + p["offset"])
            grad[np.arange(len(rows)), y[rows]] -= 1
            grad *= (weight[y[rows]] / len(rows))[:, None]
            back = (grad @ p["dense"].T) * (top > 0)
            seen = x[rows][np.arange(len(rows))[:, None, None], peak[:, :, None] + np.arange(span)]
            patch = p["embed"][seen].reshape(len(rows), count, width)
            into = np.einsum("nf,wf->nfw", back, p["filters"]).reshape(-1, EMBED)
            embed = np.stack([np.bincount(seen.ravel(), into[:, d], 256) for d in range(EMBED)], axis=1)
            g = {"embed": embed, "filters": np.einsum("nfw,nf->wf", patch, back) * mask, "bias": back.sum(0),
                 "dense": hidden.T @ grad, "offset": grad.sum(0)}
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                change = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                p[k] = (p[k] - change).astype(np.float32)
    return ByteConvNet(names, **p)


def training_sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[list[str], list[str]]:
    """Up to about DOCS_PER_LANG documents of each language, chosen by a hash of the id,
    and WINDOWS_PER_DOC evenly spaced windows of each. Only these reach the driver."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        (F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)).alias("u"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], []
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, DOCS_PER_LANG / n))) for k, n in counts.items()])
    spread = (F.length("text") - WINDOW) / max(1, WINDOWS_PER_DOC - 1)
    cuts = F.array(*[F.substring("text", F.greatest(F.lit(1), F.floor(spread * i) + 1).cast("int"), F.lit(WINDOW))
                     for i in range(WINDOWS_PER_DOC)])
    taken = rows.filter(F.col("u") < share).select("lang", F.explode(F.array_distinct(cuts)).alias("text"))
    got = sorted((r.lang, r.text) for r in taken.collect())
    return [t for _, t in got], [k for k, _ in got]


def _predict(net, text_col: str, columns: tuple[str, str]):
    def many(windows: np.ndarray) -> np.ndarray:
        step = 16  # keeps a step's arrays in the processor's cache
        return np.concatenate([net.value.probabilities(windows[i : i + step]) for i in range(0, len(windows), step)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col, 1 << 20):
            data = [(t or "").encode("utf-8", "replace") for t in part.column(text_col).to_pylist()]
            blocks = [windows_of(d) for d in data]
            counts = np.array([len(b) for b in blocks])
            p = many(np.concatenate(blocks)) if blocks else np.empty((0, len(net.value.langs)))
            # a window counts by the bytes of text in it
            full = np.full(len(p), WINDOW)
            full[np.cumsum(counts) - 1] = [max(1, len(d) - (n - 1) * WINDOW) for d, n in zip(data, counts, strict=True)]
            starts = np.cumsum(counts) - counts
            mean = np.add.reduceat(p * full[:, None], starts) / np.add.reduceat(full, starts)[:, None]
            best = mean.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([net.value.langs[i] for i in best], pa.string()),
                 pa.array(np.minimum(mean[np.arange(len(best)), best], 1.0).astype(np.float64))],
                names=[*part.schema.names, *columns])

    return run


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteConvNet | None:
    """A network trained on ``labelled``; None if no row has a language and a letter."""
    return train(*training_sample(labelled, id_col, text_col, lang_col))


def predict(
    docs: DataFrame, net: ByteConvNet | None, text_col: str = "text",
    lang_out: str = "lang_pred", score_out: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language and its mean probability as two more columns.

    A text that is NULL or has no letter is ``und`` with score 0, and so is every text
    without a network. Every column of ``docs`` is kept; columns named like the two
    results are replaced. Equal texts get equal results.
    """
    rows = docs.drop(lang_out, score_out)
    if net is None:
        return rows.withColumn(lang_out, F.lit(UNDETERMINED)).withColumn(score_out, F.lit(0.0))
    marks = fresh(rows, "__lang"), fresh(rows, "__score")
    schema = T.StructType([*rows.schema.fields, T.StructField(marks[0], T.StringType()),
                           T.StructField(marks[1], T.DoubleType())])
    found = rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(net), text_col, marks), schema)
    known = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return found.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.when(known, F.col(marks[0])).otherwise(UNDETERMINED).alias(lang_out),
        F.when(known, F.col(marks[1])).otherwise(0.0).alias(score_out))


def identify(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    lang_out: str = "lang_pred", score_out: str = "score",
) -> DataFrame:
    """``predict`` by a network that ``fit`` trains on ``labelled`` (id, text, language);
    rows without a language or a letter teach nothing."""
    return predict(docs, fit(labelled, id_col, text_col, lang_col), text_col, lang_out, score_out)


def least_score(languages: int, evidence: float) -> float:
    """The mean probability of a guess that is ``evidence`` of the way from an even guess
    among the languages (0) to certainty (1). Nothing is told apart by a single one: 0."""
    if languages < 2:
        return 0.0
    even = 1.0 / languages
    return even + evidence * (1.0 - even)


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))

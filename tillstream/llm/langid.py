"""Language identification with a small byte convolutional network.

A text's UTF-8 bytes are cut into windows of `WINDOW`. Each byte is embedded; filters of several
widths run over the window, the maximum of each is taken, and a softmax over these gives the window's
language. A text's prediction adds up the log-probabilities of all its windows, weighted by their
bytes. The network is trained in numpy with Adam: through the maximum only one place per filter gets
a gradient, so a step costs little more than a forward pass.

Training takes a bounded sample: at most `windows` windows per language, `per_text` from a text, chosen
by hash from all labelled texts. Every text is predicted in full.

Defined results: a null text, or one without a letter, is `und` with score 0; without any labelled
text everything is `und`; repeated rows are predicted each; an empty table gives no rows. Other
columns are kept, those named `lang_pred` or `score` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import pieces

WINDOW = 192
WIDTHS = (2, 3, 4, 5)
FILTERS = 12  # of each width
EMBEDDING = 8
# Bound of the training sample, per language.
# Not above 1000, up to which Spark keeps only so many rows of a label before the shuffle.
TRAINING_WINDOWS = 1000
PER_TEXT = 2
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # byte, EMBEDDING; row 256 is padding and stays zero
    filters: np.ndarray  # (widest * EMBEDDING, filters); the narrower ones end in zeros
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def _mask() -> np.ndarray:
    mask = np.zeros((max(WIDTHS), EMBEDDING, len(WIDTHS) * FILTERS), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
    return mask.reshape(max(WIDTHS) * EMBEDDING, -1)


def _spread(net: Network, windows: np.ndarray) -> np.ndarray:
    """Embedded windows with the bytes of the widest filter side by side: (n, WINDOW, widest * E)."""
    n, length = windows.shape
    widest = max(WIDTHS)
    padded = np.full((n, length + widest - 1), 256, np.int16)
    padded[:, :length] = windows
    embedded = net.embedding[padded].reshape(n, -1)
    step = embedded.strides[1]
    return np.lib.stride_tricks.as_strided(
        embedded,
        (n, length, widest * EMBEDDING),
        (embedded.strides[0], EMBEDDING * step, step),
    )


def _pooled(net: Network, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spread = _spread(net, windows)
    n, length, size = spread.shape
    made = spread.reshape(n * length, size) @ net.filters
    return made.reshape(n, length, -1), spread


def log_probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    """Of each language, for windows of bytes (int16, 256 past the end)."""
    made, _ = _pooled(net, windows)
    pooled = np.maximum(made.max(axis=1) + net.bias, 0)
    logits = pooled @ net.out + net.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def train(
    windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6, seed: int = 7
) -> Network:
    """Fit the network; `labels` are numbers of `languages`."""
    rng = np.random.default_rng(seed)
    total = len(WIDTHS) * FILTERS
    size = max(WIDTHS) * EMBEDDING
    mask = _mask()
    embedding = rng.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32)
    embedding[256] = 0
    filters = (rng.normal(0, (2 / size) ** 0.5, (size, total)) * mask).astype(np.float32)
    net = Network(
        languages,
        embedding,
        filters,
        np.zeros(total, np.float32),
        rng.normal(0, 0.2, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    names = ["embedding", "filters", "bias", "out", "out_bias"]
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    padded = np.full((len(windows), windows.shape[1] + max(WIDTHS) - 1), 256, np.int64)
    padded[:, : windows.shape[1]] = windows
    step, batch = 0, 32
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), batch):
            rows = order[begin : begin + batch]
            made, spread = _pooled(net, windows[rows])
            place = made.argmax(axis=1)  # (n, total)
            n = len(rows)
            peak = np.take_along_axis(made, place[:, None], axis=1)[:, 0] + net.bias
            pooled = np.maximum(peak, 0)
            logits = pooled @ net.out + net.out_bias
            logits -= logits.max(axis=1, keepdims=True)
            share = np.exp(logits)
            share /= share.sum(axis=1, keepdims=True)
            share[np.arange(n), labels[rows]] -= 1
            share /= n
            back = (share @ net.out.T) * (peak > 0)
            # Inputs at the maxima: (n, total, size).
            inputs = spread[np.arange(n)[:, None], place]
            grads = {
                "out": pooled.T @ share,
                "out_bias": share.sum(axis=0),
                "bias": back.sum(axis=0),
                "filters": np.einsum("nt,nts->st", back, inputs) * mask,
                "embedding": np.zeros_like(net.embedding),
            }
            spots = back[:, :, None] * net.filters.T[None]
            places = place[:, :, None] + np.arange(max(WIDTHS))
            read = padded[rows][np.arange(n)[:, None, None], places]
            np.add.at(
                grads["embedding"], read.reshape(-1), spots.reshape(-1, EMBEDDING)
            )
            grads["embedding"][256] = 0
            step += 1
            for k in names:
                first[k] += 0.1 * (grads[k] - first[k])
                second[k] += 0.001 * (grads[k] ** 2 - second[k])
                rate = 0.003 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                getattr(net, k)[...] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return net


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, and the text each belongs to. An empty text has none."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    windows = np.full((int(counts.sum()), WINDOW), 256, np.int16)
    flat, at = windows.reshape(-1), 0
    for text, count in zip(texts, counts):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += int(count) * WINDOW
    return windows, np.repeat(np.arange(len(texts)), counts)


def sample(labelled: DataFrame, text: str, label: str, windows: int, per_text: int) -> DataFrame:
    """At most `windows` different rows (label, window text) of each label, at hashed places of hashed
    texts; a window of many copies of a text counts once."""
    own = F.col(text)
    length = F.length(own)
    spot = F.pmod(F.xxhash64(own, F.col("_part")), F.greatest(length - WINDOW // 2, F.lit(1)))
    cut = labelled.select(text, label, F.explode(F.sequence(F.lit(1), F.lit(per_text))).alias("_part"))
    part = F.substring(own, (spot + 1).cast("int"), F.lit(WINDOW))
    chosen = cut.select(F.col(label).alias("label"), part.alias("part")).distinct()
    by = Window.partitionBy("label").orderBy(F.xxhash64("part", F.lit(7)), "part")
    return chosen.withColumn("_nth", F.row_number().over(by)).filter(F.col("_nth") <= windows).drop("_nth")


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    windows: int = TRAINING_WINDOWS,
    per_text: int = PER_TEXT,
) -> Network | None:
    """Train on rows with a text and a label; None if there are none."""
    usable = labelled.filter(F.col(text).isNotNull() & (F.col(text) != "") & F.col(label).isNotNull())
    rows = sample(usable, text, label, windows, per_text).orderBy("label", "part").collect()
    languages = sorted({r["label"] for r in rows})
    if not languages:
        return None
    texts = [r["part"].encode()[:WINDOW] for r in rows]
    labels = np.array([languages.index(r["label"]) for r in rows])
    made, owner = windows_of(texts)
    return train(made, labels[owner], languages)


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, the mean probability of the predicted language."""
    if net is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    # At most the five arrays of a network: tens of kilobytes.
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    source = docs.select(*kept)
    schema = source.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    names = [*kept, "lang_pred", "score"]

    def predicted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in pieces(batches, text, 1 << 20):
            raw = batch.column(text).to_pylist()
            known = [t is not None and any(map(str.isalpha, t)) for t in raw]
            texts = [t.encode() if k else b"" for t, k in zip(raw, known)]
            count = len(net.languages)
            logs = np.zeros((len(texts), count))
            shares = np.zeros((len(texts), count))
            made, owner = windows_of(texts)
            for begin in range(0, len(made), 512):
                part, rows = made[begin : begin + 512], owner[begin : begin + 512]
                told = log_probabilities(net, part).astype(float)
                weight = (part < 256).sum(axis=1)[:, None]
                np.add.at(logs, rows, told * weight)
                np.add.at(shares, rows, np.exp(told) * weight)
            best = logs.argmax(axis=1)
            sizes = np.maximum([len(t) for t in texts], 1)
            score = np.clip(shares[np.arange(len(texts)), best] / sizes, 0, 1)
            language = [net.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = np.where(known, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(language), pa.array(score)], names
            )

    return source.mapInArrow(predicted, schema)

"""Byte-level convolutional quality classifier in numpy.

A text's UTF-8 bytes are embedded; learned filters look at windows of eight
bytes, four apart; their responses are max-pooled over overlapping chunks that
cover the whole document; a small layer reads each chunk, and the mean and the
maximum over chunks combine into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_batches, table, whole_text
from .langid import remainder

#: Bytes a block; a window is two blocks. Blocks a cell; a chunk is CELLS cells
#: and the next chunk begins STEP cells later, so neighbours share a cell.
BLOCK, CELL, CELLS, STEP = 4, 16, 8, 7
EMBED, FILTERS, HIDDEN = 8, 24, 16
#: Share of training documents of label 1 that a step sees cut to a random run
#: of CROP bytes, so that a short clean text is no sign of label 0.
CROPPED, CROP = 0.2, (12, 240)
#: Training: documents of each label at most, characters of one at most,
#: passes, documents a step, learning rate, weight decay, seed.
SAMPLE_EACH, SAMPLE_CHARS, EPOCHS, BATCH, RATE, DECAY, SEED = 1500, 20_000, 10, 32, 0.004, 1e-4, 11
#: Texts scored together; longer ones are worked off in such pieces of bytes.
PIECE = 1 << 20
FOLDS, HELD_OUT = 3, 1


@dataclass
class Net:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    constant: float | None = None

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def new_net(rng: np.random.Generator) -> Net:
    f = np.float32
    embed = rng.normal(0, 0.5, (256, EMBED)).astype(f)
    embed[0] = 0
    return Net(
        embed,
        rng.normal(0, (2 * BLOCK * EMBED) ** -0.5, (2 * BLOCK * EMBED, FILTERS)).astype(f),
        np.zeros(FILTERS, f),
        rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(f),
        np.zeros(HIDDEN, f),
        rng.normal(0, (2 * HIDDEN) ** -0.5, 2 * HIDDEN).astype(f),
        np.zeros(1, f),
    )


def cells_of(raw: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, each text padded with at least a block of zeros
    to whole cells, and the number of cells of each text (1 for an empty one)."""
    size = BLOCK * CELL
    counts = np.array([-(-(len(r) + BLOCK) // size) for r in raw], np.int64)
    flat = b"".join(r.ljust(int(n) * size, b"\0") for r, n in zip(raw, counts, strict=True))
    return np.frombuffer(flat, np.uint8), counts


def respond(net: Net, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Filter responses (cell, block in cell, filter) before the bias."""
    blocks = net.embed[flat].reshape(-1, BLOCK * EMBED)
    half = BLOCK * EMBED
    out = blocks @ net.filters[:half]
    out[:-1] += blocks[1:] @ net.filters[half:]
    out[np.cumsum(counts) * CELL - 1] = -1e9  # windows that would reach into the next text
    return out.reshape(-1, CELL, FILTERS)


def chunks_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each chunk (a short chunk repeats its last cell) and chunks of
    each text. Chunks cover all cells."""
    n = 1 + -(-np.maximum(counts - CELLS, 0) // STEP)
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    cells = np.minimum(k[:, None] * STEP + np.arange(CELLS), counts[doc][:, None] - 1) + first[doc][:, None]
    return cells, n


def combine(net: Net, pooled: np.ndarray, n: np.ndarray):
    """Chunk features to hidden units to one logit per text."""
    hidden = np.tanh(pooled @ net.hidden + net.hidden_bias)
    starts = np.cumsum(n) - n
    mean = np.add.reduceat(hidden, starts, axis=0) / n[:, None]
    top = np.maximum.reduceat(hidden, starts, axis=0)
    return hidden, starts, mean, top, np.concatenate([mean, top], axis=1) @ net.out + net.out_bias[0]


def pool(net: Net, raw: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Max-pooled responses of all chunks, and the chunks of each text."""
    flat, counts = cells_of(raw)
    per_cell = []
    size = BLOCK * CELL
    # whole cells at a time, plus the block that the last window reaches into
    ends = np.cumsum(counts) * CELL - 1
    half = BLOCK * EMBED
    for at in range(0, len(flat), PIECE):
        part = flat[at : at + PIECE + BLOCK]
        blocks = net.embed[part].reshape(-1, half)
        own = min(PIECE, len(flat) - at) // BLOCK
        out = blocks[:own] @ net.filters[:half]
        reach = blocks[1 : own + 1] @ net.filters[half:]
        out[: len(reach)] += reach
        inside = ends[(ends >= at // BLOCK) & (ends < at // BLOCK + own)] - at // BLOCK
        out[inside] = -1e9
        per_cell.append(out.reshape(-1, CELL, FILTERS).max(axis=1))
    cell_max = np.concatenate(per_cell)
    assert len(cell_max) * size == len(flat)
    cells, n = chunks_of(counts)
    return np.maximum(cell_max[cells].max(axis=1) + net.bias, 0), n


def score(net: Net, texts: Sequence[str]) -> np.ndarray:
    """Probability of label 1 for each text, over all of its bytes."""
    if net.constant is not None or not len(texts):
        return np.full(len(texts), net.constant if net.constant is not None else 0.0)
    pooled, n = pool(net, [t.encode("utf-8", "surrogatepass") for t in texts])
    logit = combine(net, pooled, n)[4].astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def gradients(net: Net, raw: Sequence[bytes], labels: np.ndarray, weights: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Weighted log loss of a batch and its gradients; a maximum passes its
    gradient to the window or chunk that it came from."""
    flat, counts = cells_of(raw)
    response = respond(net, flat, counts)
    in_cell = response.argmax(axis=1)
    cell_max = np.take_along_axis(response, in_cell[:, None, :], 1)[:, 0]
    cells, n = chunks_of(counts)
    stack = cell_max[cells]
    which = stack.argmax(axis=1)
    before = np.take_along_axis(stack, which[:, None, :], 1)[:, 0] + net.bias
    pooled = np.maximum(before, 0)
    hidden, starts, mean, top, logit = combine(net, pooled, n)
    p = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
    loss = float(-(weights * np.log(np.where(labels == 1, p, 1 - p) + 1e-9)).sum() / weights.sum())
    d = ((p - labels) * weights / weights.sum()).astype(np.float32)
    both = np.concatenate([mean, top], axis=1)
    g_out, g_out_bias = d @ both, np.array([d.sum()], np.float32)
    d_both = d[:, None] * net.out
    doc = np.repeat(np.arange(len(n)), n)
    d_hidden = (d_both[:, :HIDDEN] / n[:, None])[doc]
    is_top = hidden == top[doc]
    d_hidden = d_hidden + is_top * d_both[:, HIDDEN:][doc] / np.maximum(np.add.reduceat(is_top.astype(np.float32), starts, axis=0), 1)[doc]
    d_hidden *= 1 - hidden * hidden
    g_hidden, g_hidden_bias = pooled.T @ d_hidden, d_hidden.sum(axis=0)
    d_pool = (d_hidden @ net.hidden.T) * (before > 0)
    cell = np.take_along_axis(cells, which, 1)  # (chunk, filter)
    block = cell * CELL + in_cell[cell, np.arange(FILTERS)]
    at = block[:, :, None] * BLOCK + np.arange(2 * BLOCK)
    window = flat[np.minimum(at, len(flat) - 1)]  # (chunk, filter, byte)
    seen = net.embed[window].reshape(*block.shape, 2 * BLOCK * EMBED)
    g_filters = np.einsum("cf,cfk->kf", d_pool, seen, optimize=True)
    back = (d_pool[:, :, None] * net.filters.T).reshape(*block.shape, 2 * BLOCK, EMBED)
    back = back.reshape(-1, EMBED)
    g_embed = np.stack([np.bincount(window.ravel(), back[:, e], 256) for e in range(EMBED)], axis=1).astype(net.embed.dtype)
    g_embed[0] = 0
    return loss, [g_embed, g_filters, d_pool.sum(axis=0), g_hidden, g_hidden_bias, g_out, g_out_bias]


def cropped(raw: bytes, rng: np.random.Generator) -> bytes:
    """A random run of the text, for training only."""
    n = int(rng.integers(*CROP))
    at = int(rng.integers(0, max(1, len(raw) - n)))
    return raw[at : at + n]


def train(texts: Sequence[str], labels: Sequence[int], weights: Sequence[float] | None = None, *, epochs: int = EPOCHS, seed: int = SEED) -> Net:
    """Adam on the log loss. With no rows or one label only, the net is the
    smoothed share of label 1."""
    rng = np.random.default_rng(seed)
    net = new_net(rng)
    y = np.asarray(labels, np.float32)
    w = np.asarray(weights if weights is not None else np.ones(len(y)), np.float32)
    if len(set(y.tolist())) < 2:
        net.constant = float((y.sum() + 1) / (len(y) + 1)) if len(y) and y[0] == 1 else float(1 / (len(y) + 1))
        return net
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    first, second = [np.zeros_like(p) for p in net.params()], [np.zeros_like(p) for p in net.params()]
    # small samples get more passes
    epochs = max(epochs, min(24, -(-epochs * 1500 // len(raw))))
    step, steps = 0, epochs * -(-len(raw) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(raw))
        for i in range(0, len(raw), BATCH):
            pick = order[i : i + BATCH]
            _, grads = gradients(net, [cropped(raw[j], rng) if y[j] == 1 and rng.random() < CROPPED else raw[j] for j in pick], y[pick], w[pick])
            step += 1
            rate = RATE * min(1, step / 30) * (1 - step / (steps + 1)) ** 0.5
            for p, g, a, b in zip(net.params(), grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8) + rate * DECAY * p).astype(np.float32)
    return net


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded training sample ``text, quality, weight``: at most
    ``SAMPLE_EACH`` documents of each label from the training folds, by the
    order of a hash of the id, of at most ``SAMPLE_CHARS`` characters. Of rows
    that repeat an id the least text counts, of labels the larger. The weight
    restores the labels' shares."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", FOLDS) != HELD_OUT))
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count("*").alias("n")).collect()}  # two rows
    order = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
    part = F.lit(0.0)
    for q, n in sizes.items():
        part = F.when(F.col("quality") == q, F.lit(min(1.0, 1.4 * SAMPLE_EACH / n))).otherwise(part)
    chosen = marked.withColumn("order", order).where(F.col("order") < part)
    rank = F.row_number().over(Window.partitionBy("quality").orderBy("order", "doc_id"))  # of the sample only
    chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_EACH).select("doc_id", "quality")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    # at most 2 * SAMPLE_EACH ids of 16 bytes: a proven bound
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    weight = F.lit(1.0)
    for q, n in sizes.items():
        weight = F.when(F.col("quality") == q, F.lit(n / min(n, SAMPLE_EACH))).otherwise(weight)
    return rows.select("doc_id", "text", "quality", weight.alias("weight"))


def learn(docs: DataFrame, labels: DataFrame) -> Net:
    """A net from the bounded sample, trained on the driver."""
    rows = sorted(tuple(r) for r in sample(docs, labels).collect())  # at most 2 * SAMPLE_EACH
    scale = sum(r[3] for r in rows) / max(1, len(rows))
    return train([r[1] for r in rows], [r[2] for r in rows], [r[3] / scale for r in rows])


def classify(docs: DataFrame, net: Net, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (replaced if they exist). In
    place, without a shuffle; null texts are empty; the net (some 30 KB) is
    broadcast."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(net)
    rows = docs.drop("score", "predicted")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = score(shared.value, [t or "" for t in batch.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return rows.mapInArrow(run, f"{fields}, score double, predicted int")


def op4_quality_cnn(spark, sf_dir: str) -> DataFrame:
    """The quality of every whole document, learned from two folds of three."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = learn(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", whole_text().alias("text"), (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    return classify(rows, net).select("doc_id", "held_out", "score", "predicted")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted as label 0 go."""
    net = learn(docs, table(spark, sf_dir, "labels"))
    return classify(docs, net).where("predicted = 1").select(docs.columns)

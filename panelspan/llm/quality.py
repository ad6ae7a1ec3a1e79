"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded, gated attention weighs the
passages, and the weighted mean of the encodings is scored. Only documents have labels;
the attention learns from them which passages tell.

Passages are described by how their bytes follow each other (pairs of byte classes), by
hashed words, and by repetition. Whole texts are described and scored in Arrow batches,
long ones in pieces; the model is fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspan.llm.frames import SMALL_BATCH, pack, pick, small, unpack
from panelspan.llm.shingles import SPACE, piece_hashes
from panelspan.sinks.scratch import staged

PASSAGE = 64
PIECE = 1 << 18
KINDS = 9
BUCKETS = 64
FEATURES = KINDS * KINDS + BUCKETS + 6

#: Bounds of the sample: labelled documents, and the bytes of their texts. A passage has at
#: least 128 bytes, but for a document's last one. Texts are never cut: those of more bytes
#: than the bound are not sampled.
FIT_DOCS = 4000
FIT_BYTES = 16 * 1024 * 1024

HIDDEN, ATTENTION = 24, 16
EPOCHS, BATCH, RATE = 30, 64, 0.01


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, 8, np.int32)  # beyond ASCII
    kinds[:128] = 7  # other symbols and controls
    for number, members in enumerate(
        (
            b"abcdefghijklmnopqrstuvwxyz",
            b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
            b"0123456789",
            b" \t\r\x0b\x0c",
            b"\n",
            b".,;:",
            b"!?'\"()-",
        )
    ):
        kinds[list(members)] = number
    return kinds


BYTE_KINDS = _byte_kinds()


def passages(text: bytes) -> np.ndarray:
    """One row of features per passage of 64 words; a text without words has one of zeros."""
    found, at = [], 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not SPACE[text[end]]:
            end += 1
        end = min(end, len(text))
        found.append(_described(np.frombuffer(text, np.uint8, end - at, at)))
        at = end
    rows = [x for x in found if len(x)]
    return np.concatenate(rows) if rows else np.zeros((1, FEATURES), np.float32)


def _described(data: np.ndarray) -> np.ndarray:
    words = piece_hashes(data)
    n = -(-len(words) // PASSAGE)
    if n == 0:
        return np.zeros((0, FEATURES), np.float32)
    inside = ~SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    of_byte = np.maximum(np.cumsum(opens, dtype=np.int32) - 1, 0) // PASSAGE
    of_word = np.arange(len(words), dtype=np.int32) // PASSAGE
    kinds = BYTE_KINDS[data]
    pairs = kinds[:-1] * KINDS + kinds[1:]
    follow = np.bincount(of_byte[1:] * KINDS**2 + pairs, minlength=n * KINDS**2)
    follow = follow.reshape(n, -1)
    bucket = (words >> np.uint64(58)).astype(np.int64)
    bags = np.bincount(of_word * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, -1)
    count = np.bincount(of_word, minlength=n)[:, None]
    own = np.zeros(len(words))
    order = np.lexsort((words, of_word))
    own[order[1:]] = (words[order[1:]] == words[order[:-1]]) & (
        of_word[order[1:]] == of_word[order[:-1]]
    )
    before = np.ones(len(words))
    before[np.unique(words, return_index=True)[1]] = 0
    runs = np.zeros(len(words))
    if len(words) > 2:
        three = words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:] * np.uint64(7)
        seen = np.ones(len(three))
        seen[np.unique(three, return_index=True)[1]] = 0
        runs[:-2] = seen
    share = [np.bincount(of_word, x, n)[:, None] / count for x in (own, before, runs)]
    size = np.bincount(of_byte, inside, n)[:, None] / count
    return np.concatenate(
        [
            follow / np.maximum(1, follow.sum(axis=1, keepdims=True)) * 8,
            bags / count * 4,
            *share,
            size / 8,
            np.log1p(count) / 4,
            np.full((n, 1), np.log1p(len(words)) / 8),
        ],
        axis=1,
    ).astype(np.float32)


@dataclass
class Model:
    """Encoder W, gates V and U, attention w, score c; each with its offsets."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        """The probability of label 1 of each bag of passages."""
        starts = np.cumsum([0] + [len(b) for b in bags])[:-1]
        rows = (np.concatenate(bags) - self.mean) / self.scale
        return _forward(self.weights, rows, starts)["p"]


def _forward(w: dict, rows: np.ndarray, starts: np.ndarray) -> dict:
    sizes = np.diff(np.append(starts, len(rows)))
    h = np.tanh(rows @ w["W"] + w["Wb"])
    v = np.tanh(h @ w["V"] + w["Vb"])
    u = 1 / (1 + np.exp(-(h @ w["U"] + w["Ub"])))
    logit = (v * u) @ w["w"]
    top = np.repeat(np.maximum.reduceat(logit, starts), sizes)
    e = np.exp(logit - top)
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts)
    s = np.clip(z @ w["c"] + w["cb"][0], -30, 30)
    return {"h": h, "v": v, "u": u, "a": a, "z": z, "p": 1 / (1 + np.exp(-s)), "sizes": sizes}


def _gradients(w: dict, rows: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(w, rows, starts)
    ds = (f["p"] - y) / len(y)
    dz = np.repeat(ds[:, None] * w["c"][None, :], f["sizes"], axis=0)
    da = np.einsum("ij,ij->i", dz, f["h"])
    mean = np.repeat(np.add.reduceat(f["a"] * da, starts), f["sizes"])
    dlogit = f["a"] * (da - mean)
    dgate = dlogit[:, None] * w["w"][None, :]
    dv = dgate * f["u"] * (1 - f["v"] ** 2)
    du = dgate * f["v"] * f["u"] * (1 - f["u"])
    dh = f["a"][:, None] * dz + dv @ w["V"].T + du @ w["U"].T
    dx = dh * (1 - f["h"] ** 2)
    return {
        "W": rows.T @ dx, "Wb": dx.sum(0),
        "V": f["h"].T @ dv, "Vb": dv.sum(0),
        "U": f["h"].T @ du, "Ub": du.sum(0),
        "w": (f["v"] * f["u"]).T @ dlogit,
        "c": f["z"].T @ ds, "cb": np.array([ds.sum()]),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 0) -> Model:
    """Gated attention fitted by Adam on bags of passages; every step is repeatable."""
    random = np.random.default_rng(seed)
    rows = np.concatenate(bags)
    mean, scale = rows.mean(axis=0, dtype=float), rows.std(axis=0, dtype=float) + 0.05

    def drawn(*shape: int) -> np.ndarray:
        return random.normal(0, 1 / np.sqrt(shape[0]), shape)

    w = {
        "W": drawn(FEATURES, HIDDEN), "Wb": np.zeros(HIDDEN),
        "V": drawn(HIDDEN, ATTENTION), "Vb": np.zeros(ATTENTION),
        "U": drawn(HIDDEN, ATTENTION), "Ub": np.zeros(ATTENTION),
        "w": drawn(ATTENTION), "c": drawn(HIDDEN), "cb": np.zeros(1),
    }
    first = {k: np.zeros_like(x) for k, x in w.items()}
    second = {k: np.zeros_like(x) for k, x in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            picked = [(bags[i] - mean) / scale for i in chosen]
            starts = np.cumsum([0] + [len(b) for b in picked])[:-1]
            gradients = _gradients(w, np.concatenate(picked), starts, labels[chosen])
            step += 1
            for k, g in gradients.items():
                g = g + 1e-4 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                )
    return Model(w, mean, scale)


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    fit_docs: int = FIT_DOCS,
    fit_bytes: int = FIT_BYTES,
) -> Model | None:
    """A model of at most ``fit_docs`` labelled texts; None if there are none.

    Only rows whose crc32 of the key as text leaves 0 or 2 by 3 are used; keys may be of any
    type that has a text. Rows without a key or label are left out; of repeated labels the
    larger counts, and a text that repeats with its key is one. Sampled are those whose keys
    hash lowest, then their texts, until the texts before have ``fit_bytes`` together; so
    at most twice that is described, and the sample does not depend on partitions. All
    passages of a sampled text are used; one of more than ``fit_bytes`` is not sampled.
    """
    known = (
        pick(labels, key=key, label=label)
        .filter("key IS NOT NULL AND label IN (0, 1)")
        .filter(F.crc32(F.col("key").cast("string")) % 3 != 1)
        .groupBy("key")
        .agg(F.max("label").cast("int").alias("label"))
    )
    named = pick(docs, key=key, text=text).select(
        "key",
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64(F.col("key").cast("string")).alias("o"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("size"),
    )
    listed = named.filter(F.col("size") <= fit_bytes).join(known, "key")
    chosen = (
        listed.select("key", "label", "o", "t", "size")
        .distinct()
        .orderBy("o", "t", "key")
        .limit(fit_docs)
    )
    # At most fit_docs rows are in this one window.
    before = Window.orderBy("o", "t", "key").rowsBetween(Window.unboundedPreceding, -1)
    bytes_before = F.coalesce(F.sum("size").over(before), F.lit(0))
    chosen = staged(
        chosen.withColumn("before", bytes_before)
        .filter(F.col("before") < fit_bytes)
        .select("key", "t", "label")
    )
    rows = (
        named.join(F.broadcast(chosen), ["key", "t"])
        .groupBy("key", "t")
        .agg(F.first("label").alias("label"), F.first("o").alias("o"), F.first("text").alias("text"))
        .select("o", "t", "label", F.col("text").cast("binary").alias("text"))
        .mapInArrow(_sampled, "o long, t long, label int, bag binary")
        .collect()
    )
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: (r["o"], r["t"], r["label"], r["bag"]))
    bags = [pickle.loads(r["bag"]) for r in rows]
    return fit(bags, np.array([r["label"] for r in rows], float))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        bags = [pickle.dumps(passages(text)) for text in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(bags, pa.binary())], names=["o", "t", "label", "bag"]
        )


def score_quality(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (0 or 1).

    Scores come from the whole text alone. A null or empty text is scored as one passage
    without words; equal texts get equal scores. Without a model (nothing was labelled) all
    scores are 0.5. Input columns of the added names are replaced.
    """
    found = _scorer(model)(F.col("text").cast("binary"))
    scored = pack(docs, text=text).withColumn("score", found)
    return unpack(
        scored, docs.columns, score=F.col("score"), predicted=F.expr("CAST(score >= 0.5 AS INT)")
    )


def _scorer(model: Model | None):
    """A function of the text alone: nothing else of a row goes through Python, or twice."""

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            scores: list[float] = []
            for at in range(0, len(batch), SMALL_BATCH):
                for text in batch.slice(at, SMALL_BATCH).to_pylist():
                    scores.append(0.5 if model is None else _one(model, text or b""))
            yield pa.array(scores, pa.float64())

    return F.arrow_udf(score, "double").asNondeterministic()


def _one(model: Model, text: bytes) -> float:
    return float(model.scores([passages(text)])[0])


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
) -> DataFrame:
    """The rows that the classifier, fitted on the labels, does not reject."""
    model = train(docs, labels, text, key, label)
    found = _scorer(model)(F.col("text").cast("binary"))
    marked = pack(docs, text=text).withColumn("score", found)
    return unpack(marked.filter("score >= 0.5"), docs.columns)

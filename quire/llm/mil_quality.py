"""Quality classifier: multiple-instance learning with gated attention.

A document is a bag of passages. Each passage is encoded (counts of byte-class
pairs, then a dense layer), gated attention weighs the passages, and the
weighted sum is scored. Only documents have labels; the weights of the passages
are learned from them. Training is done here, on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import about, id_remainder, small_batches, text_slices, tidy, word_hashes

PASSAGE = 512               # bytes of a passage; the last one of a text may be shorter
MAX_TRAIN = 3_000           # about so many labelled rows are used for training (smallest hashed ids) ...
MAX_TRAIN_BYTES = 1 << 16   # ... among texts up to this size
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY = 24, 12, 12, 32, 0.01, 1e-4

# Byte classes: what kinds of characters follow each other tells prose from junk.
_CLASS = np.zeros(256, dtype=np.int64)
for _k, _chars in enumerate((b"aeiouy", b"bcdfghjklmnpqrstvwxz", b"AEIOUY", b"BCDFGHJKLMNPQRSTVWXZ", b"0123456789", b" ",
                             b"\n", b".", b",;:", b"!?", b"|", b"#*$%&<>", b"'\"()[]{}-_/\\@=+~^`")):
    _CLASS[list(_chars)] = _k
_CLASS[[c for c in range(128) if c < 32 and c != 10]] = 13
_CLASS[128:192] = 14
_CLASS[192:] = 15
WIDTH = 16 * 16 + 2


def passages(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of the texts of a slice, and each text's bounds.

    Square roots of the shares of byte-class pairs, the share of the passage's
    words that the text has had before (in a three-word window), and a constant.
    An empty text is one empty passage."""
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = bounds[doc] + (np.arange(len(buf)) - offsets[:-1][doc]) // PASSAGE
    kind = _CLASS[buf]
    x = np.zeros((bounds[-1], WIDTH), dtype=np.float32)
    if len(buf) > 1:
        same = at[1:] == at[:-1]
        pairs = np.bincount((at[1:] * 256 + kind[:-1] * 16 + kind[1:])[same], minlength=bounds[-1] * 256)
        pairs = pairs.reshape(-1, 256).astype(np.float32)
        x[:, :256] = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    words, edges = word_hashes(buf, offsets)
    if len(words) >= 3:
        inside = (np.frombuffer(buf, np.uint8) != 0x20) & ((buf < 9) | (buf > 13))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[offsets[:-1][sizes > 0]] = inside[offsets[:-1][sizes > 0]]
        place = at[np.flatnonzero(first)]
        owner = np.repeat(np.arange(len(sizes)), np.diff(edges)).astype(np.uint64)
        with np.errstate(over="ignore"):
            key = words[:-2] + words[1:-1] * np.uint64(0x9E3779B97F4A7C15) + words[2:] * np.uint64(
                0xC2B2AE3D27D4EB4F) + owner[:-2] * np.uint64(0xD6E8FEB86659FD93)
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), dtype=bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        again &= owner[2:] == owner[:-2]
        total = np.bincount(place, minlength=bounds[-1])
        x[:, 256] = np.bincount(place[:-2][again], minlength=bounds[-1]) / np.maximum(total, 1)
    x[:, 257] = 1.0
    return x, bounds


def _segment_sum(v: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(v, bounds[:-1], axis=0)


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(v, -30, 30)))


def forward(p: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Passage encodings h, gated attention weights a, and the score of each bag."""
    h = np.tanh(x @ p["W"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    n = np.diff(bounds)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, bounds[:-1]), n))
    a = e / np.repeat(_segment_sum(e, bounds), n)
    z = _segment_sum(h * a[:, None], bounds)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "score": _sigmoid(z @ p["c"] + p["b"])}


def _gradient(p: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f, n = forward(p, x, bounds), np.diff(bounds)
    d = (f["score"] - y) / len(y)
    dz = np.repeat(np.outer(d, p["c"]), n, axis=0)
    da = np.sum(dz * f["h"], axis=1)
    de = f["a"] * (da - np.repeat(_segment_sum(da * f["a"], bounds), n))
    dtg = np.outer(de, p["w"])
    dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
    dh = (dz * f["a"][:, None] + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
    return {"W": x.T @ dh, "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de,
            "c": f["z"].T @ d, "b": np.array([d.sum()])}


def train(bags: list[np.ndarray], y: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """Adam over mini-batches of bags."""
    rng = np.random.default_rng(seed)
    p = {"W": rng.normal(0, WIDTH ** -0.5 * 4, (WIDTH, HIDDEN)), "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "w": rng.normal(0, GATE ** -0.5, GATE),
         "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "b": np.zeros(1)}
    p = {k: a.astype(np.float32) for k, a in p.items()}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for epoch in range(EPOCHS):
        order, rate = rng.permutation(len(bags)), RATE * (1 - epoch / EPOCHS)
        for k in range(0, len(order), BATCH):
            part = order[k:k + BATCH]
            x = np.concatenate([bags[i] for i in part])
            bounds = np.concatenate([[0], np.cumsum([len(bags[i]) for i in part])])
            step += 1
            for name, grad in _gradient(p, x, bounds, y[part]).items():
                grad = grad + DECAY * p[name]
                m[name] = 0.9 * m[name] + 0.1 * grad
                v[name] = 0.999 * v[name] + 0.001 * grad ** 2
                move = (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)
                p[name] = (p[name] - rate * move).astype(np.float32)
    return p


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", holdout: tuple[int, int] = (3, 1)) -> dict[str, np.ndarray]:
    """Learn from about MAX_TRAIN labelled rows whose crc32(id) mod ``holdout[0]``
    is not ``holdout[1]``. Without a label the model says 0.5 of everything."""
    # Only the labels' own column and the texts are read; rows with conflicting labels count with the smallest.
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(label_col).alias("y")).filter(id_remainder(F.col("id"), holdout[0]) != holdout[1])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.octet_length("text") <= MAX_TRAIN_BYTES)
    chosen = about(known.join(texts.select("id"), "id", "left_semi"), "id", MAX_TRAIN)    # broadcast: about MAX_TRAIN ids
    found = texts.join(F.broadcast(chosen), "id").select("id", "text", "y").orderBy(
        F.xxhash64("id"), F.xxhash64("text"), "y").limit(2 * MAX_TRAIN).collect()     # the bound also holds for repeated ids
    sample = sorted(found, key=lambda r: (str(r["id"]), r["text"], r["y"]))
    bags = []
    for r in sample:
        raw = np.frombuffer(r["text"].encode(), np.uint8)
        bags.append(passages(raw, np.array([0, len(raw)]))[0])
    if not bags:
        return {"W": np.zeros((WIDTH, HIDDEN), np.float32), "V": np.zeros((HIDDEN, GATE), np.float32),
                "U": np.zeros((HIDDEN, GATE), np.float32), "w": np.zeros(GATE, np.float32),
                "c": np.zeros(HIDDEN, np.float32), "b": np.zeros(1, np.float32)}
    return train(bags, np.array([float(r["y"]) for r in sample]))


def score(docs: DataFrame, model: dict[str, np.ndarray], columns: list[str], text_col: str = "text",
          name: str = "score") -> DataFrame:
    """``columns`` of every row and ``name``, its score (0 to 1, higher: label 1 likelier). Null texts score as empty ones."""
    names = [f"c{k}" for k in range(len(columns))]
    text = names[columns.index(text_col)] if text_col in columns else "__text"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in text_slices(batch, text, max_bytes=1 << 19):
                x, bounds = passages(buf, offsets)
                made = forward(model, x, bounds)["score"].astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, j - i) for k in range(len(names))), pa.array(made)], [*names, "score"])

    kinds = [docs.schema[c].dataType.simpleString() for c in columns]
    sent = [F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)]
    out = small_batches(docs).select(*sent, *([] if text in names else [F.col(f"`{text_col}`").alias(text)])).mapInArrow(
        run, ", ".join([*(f"{n} {k}" for n, k in zip(names, kinds)), "score double"]))
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, columns)), F.col("score").alias(name))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score and predicted (1 if score >= 0.5) of every row.

    Null texts score as empty ones; repeated rows are scored each; a null id is
    not held out and not learned from. Other columns are never read."""
    model = fit(docs, labels, id_col, text_col)
    out = score(docs, model, [id_col], text_col)
    return out.select(id_col, F.coalesce(id_remainder(F.col(id_col), 3) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))

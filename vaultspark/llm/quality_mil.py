"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (48 words each).  Every passage is encoded from
its bytes and hashed words; gated attention (tanh and sigmoid branches) weighs the
encoded passages; the weighted representation gives the score.  All parameters
are learned from document labels with gradients derived by hand in numpy.

The model is fitted on a bounded sample: at most ``per_class`` labelled documents
of each label and ``fit_passages`` evenly spread passages of each (parameters, so the driver holds
megabytes at any input size).  Scoring covers every passage of every text: attention
is a ratio of two sums, which are accumulated piece by piece, so work space does
not follow the length of a text.  Only text is an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.bytewords import Hasher, pieces
from vaultspark.llm.common import distinct_names, small_batches, texts

PASSAGE = 48
PER_CLASS = 2000
FIT_PASSAGES = 24
BUCKETS = 1 << 15
THRESHOLD = 0.7
#: Byte classes counted per passage: a lane of 16 bits each in two 64-bit words; passages too long for a lane are counted apart.
CLASSES = (
    bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b"#*$%&|<>",
    b"!", b"\"'(),-./:;?@[\\]^_`{}~+=", bytes(range(128, 256)), b"\n",
)
N_FEATURES = len(CLASSES) + 5


def _lanes() -> np.ndarray:
    out = np.zeros((2, 256), dtype=np.uint64)
    for c, members in enumerate(CLASSES):
        out[c // 4, list(members)] = np.uint64(1 << (16 * (c % 4)))
    return out


LANES = _lanes()
#: Bytes from which a passage may fill a lane.
LANE = 1 << 16
#: The classes as rows over the byte values.
MEMBERS = np.array([np.isin(np.arange(256), list(m)) for m in CLASSES], dtype=np.int64)


def passages(hasher: Hasher, rows: np.ndarray, parts: list[bytes], width: int = PASSAGE):
    """(row, features, word buckets, word's passage) of all passages of the parts.
    A part without words is one passage without words."""
    w = hasher.words(parts)
    n = len(w.start)
    count = np.bincount(w.row, minlength=len(parts))
    before = np.concatenate(([0], np.cumsum(count)[:-1]))
    per = np.maximum(1, -(-count // width))
    base = np.concatenate(([0], np.cumsum(per)[:-1]))
    total = int(per.sum())
    owner = np.repeat(np.arange(len(parts)), per)
    place = np.arange(n) - before[w.row]
    of = base[w.row] + place // width  # the passage of each word
    head = np.flatnonzero(place % width == 0)
    begin = w.first[owner].copy()  # the first byte of each passage; white space before a word goes with the passage before
    begin[of[head]] = np.where(place[head] == 0, w.first[w.row[head]], w.start[head])
    classes = []
    for lane in LANES:
        sums = np.add.reduceat(lane[w.raw], begin)
        classes += [((sums >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.float64) for k in range(4)]
    words = np.bincount(of, minlength=total).astype(np.float64)
    chars = np.diff(np.concatenate((begin, [len(w.raw)]))).astype(np.float64)
    for k in np.flatnonzero(chars >= LANE):
        at = int(begin[k])
        whole = MEMBERS @ np.bincount(w.raw[at: at + int(chars[k])], minlength=256)
        for c, n_bytes in enumerate(whole):
            classes[c][k] = n_bytes
    some = np.maximum(words, 1)
    twin = np.zeros(total)  # words equal to the word before
    if n > 1:
        same = np.flatnonzero((w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])) + 1
        twin = np.bincount(of[same], minlength=total).astype(np.float64)
    # shingles of four words that occurred before in the same text
    repeat = np.zeros(total)
    if n > 3:
        a, b, c, d = (w.hash[k: n - 3 + k] for k in range(4))
        whole = w.row[:-3] == w.row[3:]
        sh = (a * np.uint64(0x9E3779B97F4A7C15) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + (c << np.uint64(17)))) + d * np.uint64(0x165667B19E3779F9)
        sh = (sh ^ (w.row[:-3].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))[whole]
        at = np.flatnonzero(whole)
        order = np.argsort(sh, kind="stable")
        again = np.concatenate(([False], sh[order][1:] == sh[order][:-1]))
        repeat = np.bincount(of[at[order[again]]], minlength=total).astype(np.float64)
    feats = np.stack([*(x / np.maximum(chars, 1) for x in classes[:-1]), classes[-1] / some,
                      np.minimum(chars / some, 40) / 10, repeat / some, twin / some, np.log1p(words),
                      np.zeros(total)], axis=1).astype(np.float32)
    return rows[owner], feats, (w.hash >> np.uint64(49)).astype(np.int64) % BUCKETS, of


@dataclass
class Model:
    """Parameters; ``word`` holds a learned weight per word bucket."""

    word: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    W: np.ndarray
    b: np.ndarray
    V: np.ndarray
    U: np.ndarray
    w: np.ndarray
    c: np.ndarray
    c0: float

    def encode(self, feats: np.ndarray, buckets: np.ndarray, of: np.ndarray) -> np.ndarray:
        feats = feats.copy()
        n = np.bincount(of, minlength=len(feats))
        feats[:, -1] = np.bincount(of, weights=self.word[buckets], minlength=len(feats)) / np.maximum(n, 1)
        return np.clip((feats - self.mean) / self.scale, -8, 8)

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encoded passages and their attention before it is normalised (bounded, so no overflow)."""
        h = np.tanh(x @ self.W + self.b)
        e = (np.tanh(h @ self.V) / (1 + np.exp(-(h @ self.U)))) @ self.w
        return h, np.exp(e)

    def probability(self, top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(top / bottom[:, None] @ self.c + self.c0, -30, 30)))


def train(bags: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], prior: float, hidden: int = 16, gate: int = 8,
          epochs: int = 60, rate: float = 0.01, seed: int = 7) -> Model:
    """Fit on (label, features, buckets, passage of each bucket) per document.
    Word weights come from one half, all other parameters from the other."""
    rng = np.random.Generator(np.random.PCG64(seed))
    counts = np.ones((2, BUCKETS))
    for k, (y, _, buckets, _) in enumerate(bags):
        if k % 2 == 0:
            counts[y] += np.minimum(np.bincount(buckets, minlength=BUCKETS), 3)
    word = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    word = np.clip(np.where(counts.sum(axis=0) > 2, word, 0), -3, 3).astype(np.float32)
    model = Model(word, np.zeros(N_FEATURES), np.ones(N_FEATURES),
                  rng.normal(0, 0.4, (N_FEATURES, hidden)), np.zeros(hidden), rng.normal(0, 0.3, (hidden, gate)),
                  rng.normal(0, 0.3, (hidden, gate)), rng.normal(0, 0.3, gate), rng.normal(0, 0.3, hidden), 0.0)
    rest = [b for k, b in enumerate(bags) if k % 2] or bags
    raw = [model.encode(f, k, of) for _, f, k, of in rest]
    every = np.concatenate(raw)
    model.mean, model.scale = every.mean(axis=0), every.std(axis=0) + 0.05
    width = max(len(r) for r in raw)
    x, mask = np.zeros((len(raw), width, N_FEATURES)), np.zeros((len(raw), width))
    for i, r in enumerate(raw):
        x[i, : len(r)], mask[i, : len(r)] = np.clip((r - model.mean) / model.scale, -8, 8), 1
    y = np.array([b[0] for b in rest], dtype=np.float64)
    share = np.clip(y.mean(), 0.02, 0.98)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    names = ("W", "b", "V", "U", "w", "c", "c0")
    m = {k: np.zeros_like(getattr(model, k)) for k in names}
    v = {k: np.zeros_like(getattr(model, k)) for k in names}
    step, batch = 0, 128
    for _ in range(epochs):
        for idx in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            xb, mb, yb, wb = x[idx], mask[idx], y[idx], weight[idx]
            h = np.tanh(xb @ model.W + model.b)
            t, g = np.tanh(h @ model.V), 1 / (1 + np.exp(-(h @ model.U)))
            a = np.exp((t * g) @ model.w) * mb
            a /= a.sum(axis=1, keepdims=True)
            z = (a[:, :, None] * h).sum(axis=1)
            p = 1 / (1 + np.exp(-np.clip(z @ model.c + model.c0, -30, 30)))
            ds = (p - yb) * wb / len(idx)
            dz = ds[:, None] * model.c
            da = (h * dz[:, None, :]).sum(axis=2)
            de = a * (da - (a * da).sum(axis=1, keepdims=True))
            dtg = de[:, :, None] * model.w
            dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
            dh = (a[:, :, None] * dz[:, None, :] + dt @ model.V.T + dg @ model.U.T) * (1 - h * h)
            grad = {"W": np.einsum("npf,nph->fh", xb, dh), "b": dh.sum(axis=(0, 1)),
                    "V": np.einsum("nph,npg->hg", h, dt), "U": np.einsum("nph,npg->hg", h, dg),
                    "w": np.einsum("npg,np->g", t * g, de), "c": z.T @ ds, "c0": ds.sum()}
            step += 1
            for k in names:
                old = getattr(model, k)
                gk = grad[k] + (1e-3 * old if k != "c0" else 0)
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.999 * v[k] + 0.001 * gk * gk
                setattr(model, k, old - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
    model.c0 = float(model.c0 + np.log(prior / (1 - prior)) * 0.5)  # part of the way from balanced classes to the labels' share
    return model


def sample_bags(docs: DataFrame, labelled: DataFrame, fit_passages: int = FIT_PASSAGES) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Bags of ``docs(doc_id, text)`` joined with the bounded ``labelled(doc_id, y)``, in order of doc_id."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in small_batches(it, "text", 4 << 20):
            out = []
            for text in texts(b.column("text")):
                _, f, k, of = passages(hasher, np.zeros(1, np.int64), [text])
                pick = np.unique(np.linspace(0, len(f) - 1, min(len(f), fit_passages)).astype(np.int64))
                inside = np.isin(of, pick)
                out.append((f[pick].tobytes(), k[inside].astype(np.int32).tobytes(),
                            np.searchsorted(pick, of[inside]).astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), *(pa.array(c, pa.binary()) for c in zip(*out))],
                ["doc_id", "y", "f", "k", "p"])

    ids = labelled.select(F.col("doc_id").alias("_lid"), F.col("y").cast("int").alias("y"))
    src = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("_lid")).select("doc_id", "y", "text")  # bounded by the sample
    got = src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, y int, f binary, k binary, p binary").collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["f"])))
    return [(r["y"], np.frombuffer(r["f"], np.float32).reshape(-1, N_FEATURES).astype(np.float64),
             np.frombuffer(r["k"], np.int32), np.frombuffer(r["p"], np.int32)) for r in got]


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", learn: Column | None = None, per_class: int = PER_CLASS) -> Model | None:
    """A model of ``label_col`` (0/1) learned from labelled rows for which ``learn``
    holds.  None if there are not documents of both labels."""
    src = distinct_names(docs, id_col, text_col)
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    known = known.filter("doc_id is not null and y in (0, 1)")
    known = known if learn is None else known.filter(learn)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    share = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(share) < 2:
        return None
    chosen = None
    for y in (0, 1):
        some = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    bags = sample_bags(src, chosen)
    if len({b[0] for b in bags}) < 2:
        return None
    return train(bags, share[1] / (share[0] + share[1]))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the probability of label 1 of every whole text, one row per
    input row.  A null or empty text is one passage without words; without a model
    every score is 0.5.  Other columns are not read."""
    src = distinct_names(docs, id_col, text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in small_batches(it, "text", 16 << 20):
            raw = texts(b.column("text"))
            if model is None:
                out = np.full(len(raw), 0.5)
            else:
                top, bottom = np.zeros((len(raw), len(model.c))), np.zeros(len(raw))
                for part in pieces(raw):
                    row, f, k, of = passages(hasher, part.rows, part.texts)
                    h, e = model.parts(model.encode(f, k, of))
                    np.add.at(top, row, h * e[:, None])
                    np.add.at(bottom, row, e)
                out = model.probability(top, bottom)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")

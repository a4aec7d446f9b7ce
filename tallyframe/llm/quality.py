"""Document quality by attention-based multiple-instance learning: a document is a bag of passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import schema_with
from .text import WordHasher, by_spaces, utf8

PASSAGE = 800  # bytes, up to the next space
GROUPS = [b" ", b"\n", b"\t\r\x0b\x0c", b".", b",", b"!", b"?", b":;", b"|", b"#", b"*", b"$", b"%", b"&", b"<>", b"-_", b"\"'`", b"()[]{}", b"0123456789", b"/\\@=+~^"]
KINDS = len(GROUPS) + 4  # then lower case, upper case, beyond ASCII, control
TRIPLES = 256
STATS = 6
WIDTH = KINDS * KINDS + TRIPLES + STATS


def kinds() -> np.ndarray:
    """The kind of each byte."""
    table = np.full(256, KINDS - 1, np.int64)
    for i, group in enumerate(GROUPS):
        table[list(group)] = i
    table[97:123], table[65:91], table[128:] = len(GROUPS), len(GROUPS) + 1, len(GROUPS) + 2
    return table


class Encoder:
    """A whole text as one feature row per passage.

    Features: pairs of neighbouring byte kinds and hashed lower-cased byte triples (square roots of shares), and
    lengths and repetition of words.  An empty text is one passage of zeros.
    """

    def __init__(self) -> None:
        self.kinds, self.hasher = kinds(), WordHasher(by_spaces())

    def __call__(self, data: bytes) -> np.ndarray:
        a = np.frombuffer(data, np.uint8)
        if len(a) == 0:
            return np.zeros((1, WIDTH), np.float32)
        spaces = np.flatnonzero((a == 32) | (a == 10))
        wanted = np.arange(PASSAGE, len(a) - PASSAGE // 2, PASSAGE)
        at = np.searchsorted(spaces, wanted)
        starts = np.unique(np.concatenate(([0], spaces[at[at < len(spaces)]])))
        n = len(starts)
        sizes = np.diff(np.append(starts, len(a)))
        own = np.repeat(np.arange(n), sizes)
        kind = self.kinds[a]
        pairs = np.bincount(own[:-1] * KINDS**2 + kind[:-1] * KINDS + kind[1:], minlength=n * KINDS**2).reshape(n, -1)
        low = np.frombuffer(data.lower(), np.uint8).astype(np.int64)
        triple = ((low[:-2] * 0x9E3779B1 + low[1:-1] * 0x85EBCA77 + low[2:] * 0xC2B2AE3D) >> 15) & (TRIPLES - 1)
        triples = np.bincount(own[: len(triple)] * TRIPLES + triple, minlength=n * TRIPLES).reshape(n, -1)
        stats = self._stats(data, a, own, sizes, n)
        return np.hstack([np.sqrt(pairs / np.maximum(sizes, 1)[:, None]), np.sqrt(triples / np.maximum(sizes, 1)[:, None]), stats]).astype(np.float32)

    def _stats(self, data: bytes, a: np.ndarray, own: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
        inside = self.hasher.in_word[a]
        first = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        hashes, place = self.hasher(data), own[first]
        words = np.bincount(place, minlength=n)
        again = np.zeros(len(hashes), bool)
        if len(hashes) > 1:
            again[1:] = hashes[1:] == hashes[:-1]
        order = np.lexsort((hashes, place))
        seen = np.zeros(len(hashes), bool)
        if len(hashes) > 1:
            seen[1:] = (hashes[order][1:] == hashes[order][:-1]) & (place[order][1:] == place[order][:-1])
        twice = np.bincount(place[order], weights=seen, minlength=n)
        letters = np.bincount(own, weights=inside, minlength=n)
        some = np.maximum(words, 1)
        return np.column_stack([
            np.log1p(words) / 5, np.bincount(place, weights=again, minlength=n) / some, twice / some,
            letters / some / 10, np.full(n, np.log1p(len(hashes)) / 10), np.full(n, float(len(hashes) == 0)),
        ])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class GatedAttention:
    """Passages to hidden vectors, gated attention over them, a logistic score of the weighted vector.

    h = tanh(W x + b), weight of a passage = softmax over the document of w . (tanh(V h) * sigmoid(U h)),
    score = sigmoid(c . sum(weight * h) + d).  Trained by Adam on the labels of whole documents.
    """

    def __init__(self, hidden: int = 32, gate: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "W": rng.normal(0, 1 / np.sqrt(8), (WIDTH, hidden)), "b": np.zeros(hidden), "V": rng.normal(0, 0.3, (hidden, gate)),
            "U": rng.normal(0, 0.3, (hidden, gate)), "w": rng.normal(0, 0.3, gate), "c": rng.normal(0, 0.3, hidden), "d": np.zeros(1),
        }
        self.constant: float | None = None

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "y": sigmoid(z @ p["c"] + p["d"])}

    def gradient(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, starts)
        bag, h, t, g, a = f["bag"], f["h"], f["t"], f["g"], f["a"]
        dl = (f["y"] - labels) / len(labels)
        dz = (dl[:, None] * p["c"])[bag]
        da = (dz * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, starts)[bag])
        dt = de[:, None] * p["w"] * g * (1 - t * t)
        dg = de[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": f["z"].T @ dl, "d": dl.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 25, batch: int = 64, rate: float = 0.003, decay: float = 1e-5, seed: int = 7) -> GatedAttention:
        """Without labels of both kinds the score is a constant: their mean, or 0.5 without any."""
        if len(set(labels.tolist())) < 2:
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        rng = np.random.default_rng(seed)
        first, second, step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                x = np.concatenate([bags[i] for i in chosen]).astype(np.float64)
                starts = np.concatenate(([0], np.cumsum([len(bags[i]) for i in chosen])[:-1]))
                step += 1
                for k, d in self.gradient(x, starts, labels[chosen]).items():
                    d = d + decay * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * d
                    second[k] = 0.999 * second[k] + 0.001 * d * d
                    speed = rate * (1 - epoch / epochs)
                    self.p[k] = self.p[k] - speed * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return self

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        out, at = [], 0
        while at < len(bags):  # a few thousand passages at a time
            end, rows = at + 1, len(bags[at])
            while end < len(bags) and rows + len(bags[end]) <= 4096:
                rows += len(bags[end])
                end += 1
            starts = np.concatenate(([0], np.cumsum([len(b) for b in bags[at:end]])[:-1])).astype(np.int64)
            out.append(self.forward(np.concatenate(bags[at:end]), starts)["y"])
            at = end
        return np.concatenate(out).astype(np.float64) if out else np.empty(0)


def held_out(key: str) -> Column:
    """Documents never used for fitting: those whose key as text has a CRC-32 of 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bags_of(got: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature rows and labels of documents (key, bag, label) in the order of key and features.  The features are parts of
    one array, whose memory goes back at once when they go."""
    order = pc.sort_indices(got, sort_keys=[("key", "ascending"), ("bag", "ascending")]).to_pylist()
    column = got.column("bag")
    ends = np.cumsum([0, *(column[i].as_buffer().size // (2 * WIDTH) for i in order)])
    rows = np.empty((ends[-1], WIDTH), np.float32)
    for i, a, b in zip(order, ends, ends[1:]):
        rows[a:b] = np.frombuffer(column[i].as_buffer(), np.float16).reshape(-1, WIDTH)
    return [rows[a:b] for a, b in zip(ends, ends[1:])], got.column("label").to_numpy().astype(np.float64)[order]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_docs: int = 4000, max_passages: int = 64, seed: int = 7) -> GatedAttention:
    """Fit on a bounded sample: the ``max_docs`` labelled documents outside ``held_out`` that come first by a hash of
    their key, and of a longer one ``max_passages`` passages evenly over the whole text.

    NULL keys and labels are left out; a key with several labels has the smallest.  The sample's features go to the
    driver (at most 1.3 kB a passage), the fit takes seconds there.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
    sample = known.groupBy(key).agg(F.min(label).cast("int").alias("__label")).orderBy(F.xxhash64(key), key).limit(max_docs)
    rows = docs.select(key, text).join(F.broadcast(sample), key).select(F.col(key).cast("string").alias("key"), text, "__label")  # at most max_docs rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder()
        for batch in batches:
            out = []
            for data in utf8(batch.column(1)):
                bag = encode(data or b"")
                if len(bag) > max_passages:
                    bag = bag[np.linspace(0, len(bag) - 1, max_passages).astype(int)]
                out.append(bag.astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), batch.column(2)], names=["key", "bag", "label"])

    bags, wanted = bags_of(rows.mapInArrow(run, "key string, bag binary, label int").toArrow())
    return GatedAttention(seed=seed).fit(bags, wanted, seed=seed)


def score(docs: DataFrame, model: GatedAttention, text: str = "text", name: str = "score") -> DataFrame:
    """Add ``name``: the score of the whole text between 0 and 1; NULL and empty texts are one empty passage.
    One pass without a shuffle; a column of that name is replaced."""
    own = docs.drop(name)
    names, shared = own.columns, docs.sparkSession.sparkContext.broadcast((model.p, model.constant))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, net = Encoder(), GatedAttention()
        net.p, net.constant = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = np.round(net.score([encode(data or b"") for data in utf8(part.column(names.index(text)))]), 6)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.float64())], names=[*names, name])

    return own.mapInArrow(run, schema_with(own, f"{name} double"))

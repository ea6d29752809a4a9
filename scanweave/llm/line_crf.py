"""Document quality from a linear-chain conditional random field over lines."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scanweave.llm.tokens import by_bytes

# Byte classes that are counted per line; bytes from 0x80 on belong to letters.
_BLANK = b" \t\n\x0b\x0c\r"
_CLASSES = (b"#*$%&<>", bytes(range(65, 91)), b"!", b"|", b"0123456789", b".,;:?")
_ODD = np.uint64(0x9E3779B97F4A7C15)
N_OWN, N_SHARED = 13, 9
N_FEATURES = N_OWN + 2 * N_SHARED + 2


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    with np.errstate(over="ignore"):
        base, inverse = int(_ODD), pow(int(_ODD), -1, 1 << 64)
        return tuple(
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]), dtype=np.uint64)
            for b in (base, inverse)
        )


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of the texts, the bytes of each line, and the number of lines of each text.

    A line's own features come first (shares of symbols, capitals, exclamation marks, bars, digits,
    repeated and not different words, whether the text has had the line before, its length), then those of the
    line before and of the line behind, zero at the ends of a text.
    """
    n_lines = np.array([text.count(b"\n") + 1 for text in texts], np.int64)
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    n = len(buffer)
    ends = np.flatnonzero(buffer == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = ends - starts
    some = np.maximum(size, 1)

    def per_line(mask):
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[ends] - sums[starts]

    table = np.zeros((len(_CLASSES), 256), bool)
    for i, members in enumerate(_CLASSES):
        table[i, list(members)] = True
    shares = [per_line(table[i][buffer]) / some for i in range(len(_CLASSES))]

    # Words: neighbours of blanks; equal words have equal hashes wherever they stand.
    is_blank = np.isin(np.arange(256), list(_BLANK))[buffer]
    begins = np.flatnonzero(~is_blank & np.concatenate([[True], is_blank[:-1]]))
    stops = np.flatnonzero(~is_blank & np.concatenate([is_blank[1:], [True]])) + 1
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(buffer * up[:n], dtype=np.uint64)])
        word = (sums[stops] - sums[begins]) * down[begins]
        line = (sums[ends] - sums[starts]) * down[starts]
        owner = np.searchsorted(ends, begins)
        n_words = np.bincount(owner, minlength=len(ends))
        same = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
        repeats = np.bincount(owner[1:][same], minlength=len(ends))
        _, first = np.unique(word ^ (owner.astype(np.uint64) * _ODD), return_index=True)
        different = np.bincount(owner[first], minlength=len(ends))
        text_of = np.repeat(np.arange(len(texts)), n_lines)
        _, first = np.unique(line ^ (text_of.astype(np.uint64) * _ODD), return_index=True)
    seen = np.ones(len(ends))
    seen[first] = 0
    seen[size == 0] = 0
    words = np.maximum(n_words, 1)
    closed = np.isin(buffer[np.maximum(ends - 1, 0)], list(b".!?:;,")) & (size > 0)
    own = np.stack(
        [
            np.minimum(10 * shares[0], 2),
            2 * shares[1],
            np.minimum(10 * shares[2], 2),
            np.minimum(10 * shares[3], 2),
            2 * shares[4],
            2 * repeats / words,
            2 * (n_words - different) / words,
            seen,
            np.log1p(n_words) / 4,
            (n_words < 5).astype(float),
            np.minimum(size / words / 10, 3),
            (~closed).astype(float),
            np.minimum(10 * shares[5], 2),
        ],
        axis=1,
    )
    last = np.cumsum(n_lines) - 1
    firsts = last - n_lines + 1
    before, behind = np.zeros((len(ends), N_SHARED)), np.zeros((len(ends), N_SHARED))
    before[1:] = own[:-1, :N_SHARED]
    behind[:-1] = own[1:, :N_SHARED]
    before[firsts] = 0
    behind[last] = 0
    at_end = np.zeros((len(ends), 2))
    at_end[firsts, 0] = 1
    at_end[last, 1] = 1
    return np.concatenate([own, before, behind, at_end], axis=1), size, n_lines


@dataclass(frozen=True)
class Model:
    """Weights of the log-odds good : bad of a line, and the scores of moving between neighbouring lines."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray  # [from, to], 0 bad, 1 good
    base_rate: float

    def odds(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights + self.bias


def _over(moves: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Log-odds a line passes on to its neighbour."""
    return np.logaddexp(moves[0, 1], moves[1, 1] + odds) - np.logaddexp(moves[0, 0], moves[1, 0] + odds)


def forward_backward(odds: np.ndarray, n_lines: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each line from the lines up to it, and from the lines behind it.

    All texts move on together, the longest first, so the number of steps is that of the longest one.
    """
    order = np.argsort(-n_lines, kind="stable")
    sizes = n_lines[order]
    starts = (np.cumsum(n_lines) - n_lines)[order]
    upto, behind = odds.copy(), np.zeros_like(odds)
    for step in range(1, int(sizes[0]) if len(sizes) else 0):
        active = np.searchsorted(-sizes, -step, "left")
        at = starts[:active] + step
        upto[at] += _over(moves, upto[at - 1])
        at = starts[:active] + sizes[:active] - 1 - step
        behind[at] = _over(moves.T, odds[at + 1] + behind[at + 1])
    return upto, behind


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def train(features: np.ndarray, n_lines: np.ndarray, labels: np.ndarray, steps: int = 400, decay: float = 1e-5) -> Model:
    """Maximum-likelihood weights, every line carrying the label of its text; Adam on the exact gradient."""
    y = np.repeat(labels, n_lines).astype(float)
    linked = np.ones(len(y), bool)
    linked[(np.cumsum(n_lines) - n_lines)] = False
    after = np.flatnonzero(linked)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[after - 1].astype(int), y[after].astype(int)), 1)
    rate = float(np.mean(labels)) if len(labels) else 0.5
    theta = np.zeros(features.shape[1] + 5)
    theta[-5] = np.log((rate + 1e-3) / (1 - rate + 1e-3))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        moves = theta[-4:].reshape(2, 2)
        odds = features @ theta[:-5] + theta[-5]
        upto, behind = forward_backward(odds, n_lines, moves)
        error = y - _sigmoid(upto + behind)
        # Pairs of neighbouring lines: log-weights of the four joint labels.
        left, right = upto[after - 1], odds[after] + behind[after]
        joint = np.stack([moves[0, 0] + 0 * left, moves[0, 1] + right, moves[1, 0] + left, moves[1, 1] + left + right])
        joint = np.exp(joint - np.logaddexp.reduce(joint, axis=0))
        slope = np.concatenate([error @ features, [error.sum()], seen.ravel() - joint.sum(axis=1)]) / len(y)
        slope -= decay * theta
        slope[-5] += decay * theta[-5]
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2), rate)


def document_scores(texts: list[bytes], model: Model) -> np.ndarray:
    """Length-weighted mean of the lines' marginals; the base rate for a text without visible bytes."""
    if not texts:
        return np.zeros(0)
    features, size, n_lines = line_features(texts)
    upto, behind = forward_backward(model.odds(features), n_lines, model.moves)
    first = np.cumsum(n_lines) - n_lines
    total = np.add.reduceat(size, first)
    good = np.add.reduceat(size * _sigmoid(upto + behind), first)
    return np.clip(np.where(total > 0, good / np.maximum(total, 1), model.base_rate), 0.0, 1.0)


def held_out(id_column: Column) -> Column:
    """Rows no label is learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_documents: int = 4000,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Train on at most `most_documents` labelled texts outside the held-out rows, the first by hash of their id.

    Whole texts are read; features are taken where the texts are, and only features of the sample come
    to the driver. Rows without a label, or whose id has labels that disagree, are not used. Without any
    row the model scores everything 0.5.
    """
    usable = (
        labels.select(F.col(id_column).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("doc_id", "label")
    )
    texts = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("body")
    )
    order = F.xxhash64(F.col("doc_id").cast("string"))
    # Labels of ids that no document has must not use up the sample.
    present = usable.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = present.orderBy(order, "doc_id").limit(most_documents)

    def extract(batches):
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            found = []
            for start, end in by_bytes([len(body) for body in bodies], 1 << 20):
                features, _, n_lines = line_features(bodies[start:end])
                found += [part.astype("<f4").tobytes() for part in np.split(features, np.cumsum(n_lines)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["label", "features"])

    rows = texts.join(F.broadcast(sample), "doc_id").select("label", "body")  # at most `most_documents` ids
    found = rows.mapInArrow(extract, "label int, features binary").toPandas()
    if not len(found):
        return Model(np.zeros(N_FEATURES), 0.0, np.zeros((2, 2)), 0.5)
    parts = [np.frombuffer(raw, "<f4").reshape(-1, N_FEATURES) for raw in found["features"]]
    order = sorted(range(len(parts)), key=lambda i: (found["label"][i], parts[i].tobytes()))
    parts = [parts[i] for i in order]
    return train(
        np.concatenate(parts).astype(float), np.array([len(p) for p in parts]), found["label"].to_numpy()[order]
    )


def score_quality(
    docs: DataFrame,
    model: Model,
    threshold: float = 0.3,
    text: str = "text",
    batch_bytes: int = 1 << 20,
) -> DataFrame:
    """One row per row of `docs`: `row`, a struct of all its columns, `score` (0 to 1) and `predicted`.

    Null and empty texts get the base rate of the labels. Repeated rows stay and score alike; no rows
    give none; columns may have any names. Each task scores its own texts: no shuffle.
    """
    columns = [F.col(f"`{name}`") for name in docs.columns]
    rows = docs.select(
        F.struct(*columns).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("body")
    )

    @F.pandas_udf("double")
    def score(bodies):
        texts = bodies.tolist()
        parts = [document_scores(texts[a:b], model) for a, b in by_bytes([len(t) for t in texts], batch_bytes)]
        return _series(np.concatenate(parts) if parts else np.zeros(0))

    return rows.select("row", score("body").alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def _series(values: np.ndarray):
    import pandas as pd

    return pd.Series(values)

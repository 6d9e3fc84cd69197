"""Quality classifier: Bradley-Terry ranking on preference pairs.

A document's score is linear in features of its text. Of two labelled documents the one
of label 1 is preferred; the weights minimise the logistic loss on the differences of
their features. A quantile of the scores then parts what is kept from what is not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import each_batch, materialise, row_key

#: Labelled rows that are paired with each other: so many are fitted at once, and of more
#: every chunk of about as many has pairs of its own, over which the loss is summed.
LABELLED = 20_000
PAIRS = 200_000
#: Rows of the rarer label in a chunk, about, for which its rows are in several chunks;
#: steps of the fit over chunks, at most.
RARE = 100
STEPS = 25
DECAY = 1e-4
NAMES = (
    "words", "word_length", "upper", "digits", "stops", "marks", "bars", "signs", "other_marks",
    "distinct_words", "repeated_lines", "worst_marks", "worst_upper", "worst_repeat", "marked_words", "lines",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


UPPER = _class(bytes(range(65, 91)))
LETTER = UPPER | _class(bytes(range(97, 123)))
DIGIT = _class(b"0123456789")
STOPS, MARKS, BARS, SIGNS = _class(b".,;:"), _class(b"!?"), _class(b"|"), _class(b"#$%&*@^~<>{}[]\\=+_/")
VISIBLE = _class(bytes(range(33, 256)))
OTHER = VISIBLE & ~(LETTER | DIGIT | STOPS | MARKS | BARS | SIGNS) & _class(bytes(range(128)))


SPACE = _class(b" \t\n\r\x0b\x0c")
ODD_END = _class(bytes(range(128))) & ~(LETTER | DIGIT | SPACE | _class(b".,"))


#: Lines of so many bytes or fewer are too short to be judged on their own.
LONG_LINE = 20


def _worst(data: np.ndarray, part: np.ndarray, whole: np.ndarray | None = None) -> float:
    """The largest share, over all lines of over `LONG_LINE` bytes, of bytes in `part` among
    those in `whole`, or among all."""
    own = part[data]
    if not own.any():
        return 0.0
    breaks = np.flatnonzero(data == 10)
    starts, ends = np.r_[0, breaks + 1], np.r_[breaks, len(data)]
    long = ends - starts > LONG_LINE
    starts, ends = starts[long], ends[long]
    total = lambda chosen: (sums := np.r_[0, np.cumsum(chosen)])[ends] - sums[starts]
    among = ends - starts if whole is None else np.maximum(1, total(whole[data]))
    return float((total(own) / among).max(initial=0.0))


def features(text: bytes | None) -> list[float]:
    """Numbers that tell prose from junk; an empty text has zeros."""
    if not text:
        return [0.0] * len(NAMES)
    data = np.frombuffer(text, np.uint8)
    count = np.bincount(data, minlength=256)
    visible = max(1, int(count[VISIBLE].sum()))
    upper = float(count[UPPER].sum() / max(1, count[LETTER].sum()))
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x]
    worst_marks, worst_upper, worst_repeat = _worst(data, MARKS | BARS | SIGNS), _worst(data, UPPER, LETTER), 0.0
    for line in lines:
        if len(line) <= LONG_LINE:
            continue
        inside = line.split()
        if len(inside) > 20:
            worst_repeat = max(worst_repeat, 1 - float(np.log(len(set(inside))) / np.log(len(inside))))
    space = SPACE[data]
    ends = np.r_[space[1:], True] & ~space
    return [
        float(np.log1p(len(words))),
        visible / n / 10,
        upper,
        float(count[DIGIT].sum() / visible),
        *[float(count[k].sum() / visible) for k in (STOPS, MARKS, BARS, SIGNS, OTHER)],
        float(np.log(len(set(words)) or 1) / np.log(n)) if n > 1 else 1.0,
        1 - len(set(lines)) / max(1, len(lines)),
        worst_marks,
        worst_upper,
        worst_repeat,
        float(ODD_END[data[ends]].sum() / n),
        float(np.log1p(len(lines))),
    ]


def with_features(docs: DataFrame) -> DataFrame:
    """(doc_id, row, f: array of double) for every row, from its whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = pa.array([features(t) for t in texts], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), found], ["doc_id", "row", "f"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "row", F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(each_batch(run), "doc_id long, row long, f array<double>")


@dataclass(frozen=True)
class Model:
    mean: list[float]
    spread: list[float]
    weights: list[float]
    threshold: float
    scale: float


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, seed: int = 0) -> Model:
    """Weights from preference pairs, the threshold from the scores' quantile at the
    share of label 0. With one label alone every score is a half or more, or less."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / spread
    better, worse = z[label == 1], z[label != 1]
    weights = np.zeros(x.shape[1])
    if not len(better) or not len(worse):
        return Model(mean.tolist(), spread.tolist(), weights.tolist(), 0.0 if len(better) else 1.0, 1.0)
    draw = np.random.default_rng(seed)
    gap = better[draw.integers(0, len(better), pairs)] - worse[draw.integers(0, len(worse), pairs)]
    for _ in range(200):
        wrong = 1 / (1 + np.exp(np.clip(gap @ weights, -50, 50)))
        weights += wrong @ gap / pairs - 1e-4 * weights
    scores = z @ weights
    threshold = float(np.quantile(scores, len(worse) / len(z)))
    return Model(mean.tolist(), spread.tolist(), weights.tolist(), threshold, 1.0)


def linear(f: Column, model: Model) -> Column:
    total = F.lit(0.0)
    for k, (m, s, w) in enumerate(zip(model.mean, model.spread, model.weights)):
        total += (f[k] - m) / s * w
    return total


def scored(f: Column, model: Model) -> Column:
    """0 to 1; a half is the threshold."""
    return 1 / (1 + F.exp(-(linear(f, model) - model.threshold) / model.scale))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(rows: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """A model from all labelled rows that are not held out. Up to `labelled` of them are
    fitted by the driver; more are dealt by a hash into chunks of about that size, which
    stay with the tasks: what the driver gets of a chunk is the sum over its pairs."""
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    found = materialise(rows.join(known, "doc_id").select("f", "quality", F.xxhash64("doc_id").alias("h"), "row"), "labelled")
    total = found.count()
    if total > labelled:
        return fit_chunks(found, total, labelled)
    chosen = found.orderBy("h", "row", "quality").collect()
    if not chosen:
        return Model([0.0] * len(NAMES), [1.0] * len(NAMES), [0.0] * len(NAMES), 0.0, 1.0)
    return fit(np.array([r["f"] for r in chosen]), np.array([r["quality"] for r in chosen]))


def fit_chunks(found: DataFrame, total: int, chunk_rows: int, pairs: int = PAIRS) -> Model:
    """As `fit`, over all rows of `found` (f, quality, h, row): moments and the quantile are
    those of all rows, and the loss is that of `pairs` preference pairs in every chunk."""
    good = F.col("quality") == 1
    moments = [fn(F.col("f")[k]) for fn in (F.avg, F.stddev_pop) for k in range(len(NAMES))]
    n_good, *values = found.agg(F.count(F.when(good, 1)), *moments).first()
    mean, spread = np.array(values[: len(NAMES)]), np.array(values[len(NAMES) :]) + 1e-9
    weights = np.zeros(len(NAMES))
    if n_good in (0, total):
        return Model(mean.tolist(), spread.tolist(), weights.tolist(), 0.0 if n_good else 1.0, 1.0)
    chunks = -(-total // chunk_rows)
    copies = {k: min(chunks, -(-RARE * chunks // n)) for k, n in ((True, n_good), (False, total - n_good))}
    dealt = found.withColumn("good", good).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.when(good, copies[True] - 1).otherwise(copies[False] - 1)))
    )
    chunk = F.pmod(F.xxhash64("h", "row") + F.col("copy"), F.lit(chunks))
    dealt = dealt.select(chunk.alias("chunk"), "good", "h", "row", "f")
    # One row per chunk: its numbers by label, packed, as every step reads them again.
    packed = materialise(dealt.groupBy("chunk").applyInPandas(_pack, "chunk long, better binary, worse binary"), "chunks")

    def pass_over(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        sums = packed.mapInArrow(_loss_sums(mean, spread, weights, pairs), "sums array<double>").collect()
        n, loss, *rest = np.sum([r["sums"] for r in sums], axis=0)
        gradient, curve = np.array(rest[: len(weights)]) / n, np.array(rest[len(weights) :]).reshape(len(weights), -1) / n
        return (
            loss / n + DECAY / 2 * float(weights @ weights), gradient + DECAY * weights, curve + DECAY * np.eye(len(weights))
        )

    at = pass_over(weights)
    step = np.linalg.solve(at[2], at[1])
    for _ in range(STEPS):
        after = pass_over(weights - step)
        if after[0] > at[0]:
            step = step / 2
            continue
        done = at[0] - after[0] < 1e-6
        weights, at = weights - step, after
        if done:
            break
        step = np.linalg.solve(at[2], at[1])
    model = Model(mean.tolist(), spread.tolist(), weights.tolist(), 0.0, 1.0)
    threshold = quantile(found.select(linear(F.col("f"), model).alias("s")), (total - n_good) / total, total)
    return replace(model, threshold=threshold)


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["h", "row"], kind="stable")
    parts = [np.array(rows["f"][rows["good"] == k].tolist(), np.float64).tobytes() for k in (True, False)]
    return pd.DataFrame([(rows["chunk"].iloc[0], *parts)], columns=["chunk", "better", "worse"])


def _loss_sums(mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, pairs: int):
    """For mapInArrow over packed chunks: number of pairs, loss, its gradient and curvature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                better, worse = ((np.frombuffer(row[k]).reshape(-1, len(mean)) - mean) / spread for k in ("better", "worse"))
                if not len(better) or not len(worse):
                    continue
                draw = np.random.default_rng(row["chunk"])
                gap = better[draw.integers(0, len(better), pairs)] - worse[draw.integers(0, len(worse), pairs)]
                ahead = np.clip(gap @ weights, -50, 50)
                wrong = 1 / (1 + np.exp(ahead))
                curve = gap.T @ (gap * (wrong * (1 - wrong))[:, None])
                sums = np.r_[pairs, np.log1p(np.exp(-ahead)).sum(), -(wrong @ gap), curve.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])

    return run


def quantile(scores: DataFrame, share: float, total: int) -> float:
    """The exact quantile of column `s`, between two values as numpy has it: a sketch
    brackets it, and only values within the bracket are counted."""
    place = share * (total - 1)
    first = int(place)
    for slack in (1e-3, 1e-2, 1.0):
        ends = [max(0.0, share - slack), min(1.0, share + slack)]
        low, high = scores.agg(F.percentile_approx("s", ends, 10_000)).first()[0]
        below = scores.where(F.col("s") < low).count()
        held = scores.where(F.col("s").between(low, high)).groupBy("s").count().orderBy("s").collect()
        upto = below + np.cumsum([r["count"] for r in held])
        if below <= first and min(first + 1, total - 1) < upto[-1]:
            break
    a, b = (held[int(np.searchsorted(upto, k, side="right"))]["s"] for k in (first, min(first + 1, total - 1)))
    return a + (b - a) * (place - first)


def classify(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(doc_id, row, held_out, score, predicted) for every row of `docs` (doc_id, text).

    `row` is the key of the text (see common.row_key), which with doc_id leads back to
    the row. A null or empty text has zeros for features and is scored like any other.
    Null ids are scored and teach nothing, as do labels that are null or of no document;
    without any label every score is a half. Other columns are not read.
    """
    keyed = docs.select("doc_id", "text", row_key().alias("row"))
    rows = materialise(with_features(keyed), "features")
    score = scored(F.col("f"), learn(rows, labels, labelled))
    found = rows.select("doc_id", "row", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """The rows of `docs`, all columns, that `classify` predicts as 1. Texts do not move:
    one pass over them learns, another filters."""
    rows = materialise(with_features(docs.select("doc_id", "text", row_key().alias("row"))), "features")
    model = learn(rows, labels, labelled)
    mean, spread, weights = (np.array(x) for x in (model.mean, model.spread, model.weights))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([features(t) for t in batch.column("text").cast(pa.binary()).to_pylist()])
        return batch.filter(pa.array((found - mean) / spread @ weights >= model.threshold))

    return docs.mapInArrow(each_batch(run), docs.schema)

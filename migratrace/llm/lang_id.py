"""Language of texts: averaged hashed subword embeddings under a linear softmax, with calibrated rejection."""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migratrace.llm.common import SLICE_BYTES, slices
from migratrace.llm.textscan import buffers
from migratrace.session import bound_batches, ship_package

UNKNOWN = "und"
BUCKETS = 1 << 16
SIZES = (2, 3, 4)
DIMENSIONS = 16
#: Labelled rows per language that a model is fitted on, about; the only bounded sample here.
TRAIN_ROWS = 500
EPOCHS = 6
RATE = 0.5
#: Share of the correctly recognised calibration texts that may be rejected.
REJECTED = 0.001

# letters of ASCII as lower case, its other characters as a break; bytes of other characters as they are
_FOLD = np.array([b if b >= 128 else (b | 32 if chr(b).isalpha() else 32) for b in range(256)], np.uint32)


class LanguageModel(NamedTuple):
    """``weights`` holds the logits of each subword bucket: embeddings times softmax weights."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _grams(data: np.ndarray, rows: np.ndarray):
    """For each size, bucket and row of every subword: runs of bytes inside one row that hold a letter."""
    units = _FOLD[data]
    owner = np.repeat(np.arange(len(rows) - 1, dtype=np.int32), np.diff(rows))
    for size in SIZES:
        n = len(units) - size + 1
        if n <= 0:
            continue
        h = np.full(n, size, np.uint32)
        solid = np.zeros(n, bool)
        for k in range(size):
            h = h * np.uint32(0x01000193) ^ units[k : n + k]
            solid |= units[k : n + k] != 32
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        inside = solid & (owner[:n] == owner[size - 1 :])
        yield (h % np.uint32(BUCKETS))[inside], owner[:n][inside]


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _packed(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending buckets and their counts, in about a quarter of the bytes that 32-bit numbers take."""
    gaps = np.diff(buckets.astype(np.int32), prepend=np.int32(0))
    return zlib.compress(gaps.astype("<u2").tobytes() + counts.astype("<i4").tobytes(), 1)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zlib.decompress(raw)
    n = len(data) // 6
    return np.cumsum(np.frombuffer(data, "<u2", n), dtype=np.int32), np.frombuffer(data, "<i4", n, 2 * n)


def _features(batches):
    """Distinct subword buckets of every text with their counts, packed."""
    for part in slices(batches, "text_in"):
        for i, text in enumerate(part.column("text_in").to_pylist()):
            if not _has_letter(text):
                continue
            found = [g for g, _ in _grams(*buffers(part.column("text_in").slice(i, 1)))]
            buckets, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint32), return_counts=True)
            packed = pa.array([_packed(buckets, counts)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("lang_in").slice(i, 1), packed], names=["lang_in", "features"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_language_model(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS, seed: int = 11
) -> LanguageModel | None:
    """A model of the non-null values of ``lang``, or None where no row has one and a letter.

    Fitted by stochastic gradient descent on a bounded sample: about ``rows``
    rows of each language, drawn by a hash of the key; the features are made
    where the rows are and whole texts count.  One task holds the sample's
    features and fits the model; the driver gets a count per language and the
    model.  A fifth of the sample is not trained on: it sets the temperature
    of the softmax and the score below which a prediction is rejected.  The
    same rows give the same model.
    """
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    labelled = docs.select(docs[key].alias("key_in"), docs[text].alias("text_in"), docs[lang].alias("lang_in")).where("lang_in IS NOT NULL")
    sizes = {r["lang_in"]: r["n"] for r in labelled.groupBy("lang_in").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    cut = F.lit(0)
    for name, n in sorted(sizes.items()):
        cut = F.when(F.col("lang_in") == name, min(1 << 20, -(-rows * (1 << 20) // n))).otherwise(cut)
    drawn = F.coalesce(F.pmod(F.xxhash64(F.col("key_in"), F.lit(seed)), F.lit(1 << 20)), F.lit(0)) < cut
    kind = docs.schema[lang].dataType.simpleString()
    sample = labelled.where(drawn).mapInArrow(_features, f"lang_in {kind}, features binary")
    schema = f"languages array<{kind}>, weights binary, bias binary, temperature double, threshold double"
    fitted = sample.repartition(1).mapInArrow(_fitted(seed), schema).first()
    if fitted is None:
        return None
    bias = np.frombuffer(bytes(fitted["bias"]), np.float32)
    weights = np.frombuffer(bytes(fitted["weights"]), np.float32).reshape(BUCKETS, len(bias))
    return LanguageModel(fitted["languages"], weights, bias, fitted["temperature"], fitted["threshold"])


def _fitted(seed: int):
    """A row with the model of all rows (lang_in, features); none without rows."""

    def run(batches):
        sample, kind = [], None
        for batch in batches:
            kind = batch.schema.field("lang_in").type
            sample.extend(zip(batch.column("lang_in").to_pylist(), batch.column("features").to_pylist(), strict=True))
        if not sample:
            return
        model = _fit(sample, seed)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([model.languages], pa.list_(kind)),
                pa.array([model.weights.tobytes()], pa.binary()),
                pa.array([model.bias.tobytes()], pa.binary()),
                pa.array([model.temperature], pa.float64()),
                pa.array([model.threshold], pa.float64()),
            ],
            names=["languages", "weights", "bias", "temperature", "threshold"],
        )

    return run


def _fit(sample: list[tuple[str, bytes]], seed: int) -> LanguageModel:
    """The model of rows (language, packed features), in whatever order they come."""

    def place(row: tuple[str, bytes]):
        return (str(row[0]), *(x.tobytes() for x in _unpacked(row[1])))

    sample = sorted(sample, key=place)
    languages = sorted({x for x, _ in sample})
    index = {x: i for i, x in enumerate(languages)}
    targets = np.array([index[x] for x, _ in sample])
    inputs = [(b, c.astype(np.float32) / max(1, int(c.sum()))) for b, c in (_unpacked(x) for _, x in sample)]

    draw = np.random.Generator(np.random.PCG64(seed))
    order = draw.permutation(len(inputs))
    held = order[: len(order) // 5]
    trained = order[len(order) // 5 :]
    embeddings = draw.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = draw.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    share = np.bincount(targets[trained], minlength=len(languages))
    step = 0
    for _ in range(EPOCHS):
        for i in draw.permutation(trained):
            buckets, values = inputs[i]
            rate = np.float32(RATE * (1 - step / (EPOCHS * len(trained))) * len(trained) / (len(languages) * share[targets[i]]))
            step += 1
            mean = values @ embeddings[buckets]
            error = _softmax(mean @ output + bias)
            error[targets[i]] -= 1
            back = output @ error
            output -= rate * np.outer(mean, error)
            bias -= rate * error
            # a text's buckets share the step; their values sum to one
            embeddings[buckets] -= (rate * len(buckets)) * values[:, None] * back / np.float32(max(1.0, len(buckets) ** 0.5))
    weights = embeddings @ output
    logits = np.array([v @ weights[b] + bias for b, v in inputs])
    used = held if len(held) else order
    best = min(
        (0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 5.0),
        key=lambda t: -np.log(np.maximum(_softmax(logits[used] / t)[np.arange(len(used)), targets[used]], 1e-12)).mean(),
    )
    scores = _softmax(logits[used] / best)
    right = scores.argmax(axis=1) == targets[used]
    confident = np.sort(scores.max(axis=1)[right])
    threshold = float(min(confident[int(REJECTED * len(confident))], 0.5)) if len(confident) else 0.0
    return LanguageModel(languages, weights, bias, best, threshold)


def identify(docs: DataFrame, model: LanguageModel | None, *, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected, predicted from whole texts alone.

    lang_pred is the most likely language of the model, ``und`` where the text
    is null or has no letter or there is no model; score is its calibrated
    probability (0 for ``und``).  rejected is true for ``und`` and for scores
    under the model's threshold.  Ties go to the first language by name.  Rows
    are neither moved nor dropped; columns of the same names are replaced.  The
    model sent to the tasks has BUCKETS rows by one column per language.
    """
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    schema = docs.select(*kept).schema
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "lang_pred string, score double, rejected boolean"])
    wide = len(model.languages) if model else 1
    size = max(1, SLICE_BYTES // max(4, wide // 2))

    def run(batches):
        for part in slices(batches, text, size):
            column = part.column(text)
            letters = np.array([_has_letter(t) for t in column.to_pylist()], bool)
            names, scores, no = [UNKNOWN] * len(letters), np.zeros(len(letters)), np.ones(len(letters), bool)
            if model is not None:
                logits, counts = _logits(*buffers(column), model)
                p = _softmax((logits / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature)
                best = p.argmax(axis=1)
                top = p[np.arange(len(p)), best].astype(float)
                names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
                scores = np.where(letters, np.clip(top, 0, 1), 0)
                no = ~letters | (top < model.threshold)
            arrays = [part.column(c) for c in kept] + [pa.array(names, pa.string()), pa.array(scores), pa.array(no)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "lang_pred", "score", "rejected"])

    return docs.select(*kept).mapInArrow(run, out)


def _logits(data: np.ndarray, rows: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the logits of each row's subwords, and their number."""
    n = len(rows) - 1
    total, counts = np.zeros((n, len(model.languages))), np.zeros(n, np.int64)
    for start in range(0, max(n, 1), 4096):
        bounds = rows[start : start + 4097]
        for bucket, owner in _grams(data[bounds[0] : bounds[-1]], bounds - bounds[0]):
            if not len(bucket):
                continue
            at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            own = owner[at] + start
            for low in range(0, len(bucket), 1 << 22):  # a long text in parts
                high = min(low + (1 << 22), len(bucket))
                inner = at[(at >= low) & (at < high)]
                cuts = inner - low if len(inner) and inner[0] == low else np.append(0, inner - low)
                who = owner[low + cuts] + start
                np.add.at(total, who, np.add.reduceat(model.weights[bucket[low:high]], cuts, axis=0))
            counts[own] += np.diff(np.append(at, len(bucket)))
    return total, counts

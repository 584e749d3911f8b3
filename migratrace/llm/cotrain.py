"""Quality of documents by co-training a classifier of their content and one of their metadata."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migratrace.llm.common import slices
from migratrace.llm.textscan import buffers, mix, per_row, word_bounds, word_hashes
from migratrace.session import materialize, ship_package

#: The bounded sample of labelled rows, about; all other rows take part in the exchange.
LABELLED_ROWS = 20_000
ROUNDS = 4
#: Pseudo-labels that a view hands over per round, flaw and label, as a share of the rows it has not handed over yet,
#: and their least confidence.
HANDED = 0.05
CONFIDENT = 0.95
#: A view hands over only where held-out labels show at most this share of errors, and BLIND times fewer than a view
#: that sees nothing would make.
ERRORS = 0.02
BLIND = 4
#: Steps of the confidence (as a logit from CONFIDENT up to LARGEST) in which rows are counted to find that share.
STEPS = 1 << 12
LARGEST = 35.0
WORD_BUCKETS = 1 << 18
SOURCES, LANGS = 256, 64
BINS = 12
KEEP = 0.5

#: Figures of a text, and what its words say: the highest and mean log odds, and how many are above either mark.
FIGURES = 8
MARKS = (2.0, 3.5)
EVIDENCE = 5
CELLS = BINS * SOURCES * LANGS
META = BINS + SOURCES + LANGS
_UPPER, _LOWER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(4))
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".,;:!?")] = True
_UPPER[65:91] = True
_LOWER[97:123] = True
_DIGIT[48:58] = True
_MARK[list(b"!#$%&*<>|=_@^~+\\/")] = True


class Rows(NamedTuple):
    """Distinct word buckets of all rows on end, where each row's begin, the figures of the text, length told and names."""

    words: np.ndarray
    bounds: np.ndarray
    figures: np.ndarray
    told: np.ndarray
    names: np.ndarray

    def take(self, index: np.ndarray) -> Rows:
        size = np.diff(self.bounds)[index]
        bounds = np.append(0, np.cumsum(size))
        words = self.words[np.repeat(self.bounds[index] - bounds[:-1], size) + np.arange(bounds[-1])]
        return Rows(words, bounds, self.figures[index], self.told[index], self.names[index])

    @staticmethod
    def read(batch) -> Rows:
        """Of a record batch or table (words, figures, told, names) as ``to_arrow`` writes it."""
        lists = batch.column("words")
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        bounds = lists.offsets.to_numpy()
        words = lists.values.to_numpy()[bounds[0] : bounds[-1]] if len(bounds) else np.zeros(0, np.int32)

        def wide(name, width):
            column = batch.column(name)
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

        told = batch.column("told").to_numpy() if isinstance(batch, pa.Table) else batch.column("told").to_numpy(zero_copy_only=False)
        return Rows(words, bounds - bounds[0], wide("figures", FIGURES), told, wide("names", 2))

    def to_arrow(self) -> list[pa.Array]:
        words = pa.ListArray.from_arrays(pa.array(self.bounds, pa.int32()), pa.array(self.words, pa.int32()))
        figures = pa.array(list(self.figures.astype(np.float32)), pa.list_(pa.float32()))
        return [words, figures, pa.array(self.told, pa.float64()), pa.array(list(self.names), pa.list_(pa.int32()))]


def _views(part: pa.RecordBatch) -> Rows:
    data, rows = buffers(part.column("text_in"))
    starts, ends, words = word_bounds(data, rows)
    for _ in range(2):  # a word's closing punctuation does not count
        ends = ends - (_CLOSING[data[ends - 1]] & (ends - starts > 1))
    bucket = (word_hashes(data, starts, ends, lower=True) % np.uint64(WORD_BUCKETS)).astype(np.int64)
    n = len(rows) - 1
    owner = np.repeat(np.arange(n), np.diff(words))
    pairs = np.unique(owner * WORD_BUCKETS + bucket)
    cuts = np.searchsorted(pairs, np.arange(n + 1) * WORD_BUCKETS)
    size, count = np.diff(rows), np.diff(words)
    letters = np.maximum(per_row(_UPPER[data] | _LOWER[data], rows), 1)
    lines = per_row(data == 10, rows) + 1
    told = part.column("n_chars_in").cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)
    some, bytes_ = np.maximum(count, 1), np.maximum(size, 1)
    figures = np.stack(
        [
            np.log1p(count),
            np.log1p(lines),
            np.log1p(size / lines),
            size / some,
            np.diff(cuts) / some,
            per_row(_UPPER[data], rows) / letters,
            per_row(_DIGIT[data], rows) / bytes_,
            per_row(_MARK[data], rows) / bytes_,
        ],
        axis=1,
    ).astype(np.float32)
    names = np.zeros((n, 2), np.int32)
    for place, (column, most) in enumerate((("source_in", SOURCES), ("lang_in", LANGS))):
        raw, bounds = buffers(part.column(column).cast(pa.string()))
        names[:, place] = [hash_name(raw[a:b].tobytes(), most) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return Rows((pairs % WORD_BUCKETS).astype(np.int32), cuts, figures, np.log1p(np.maximum(np.nan_to_num(told), -0.5)), names)


def hash_name(raw: bytes, most: int) -> int:
    h = np.array([len(raw)], np.uint64)
    for i in range(0, len(raw), 8):
        h = mix(h + np.uint64(int.from_bytes(raw[i : i + 8], "little")))
    return int(h[0] % np.uint64(most))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -LARGEST, LARGEST)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Weights of a logistic regression (the last is the constant), by Newton steps."""
    x = np.c_[x, np.ones(len(x), x.dtype)]
    w = np.zeros(x.shape[1])
    if len(set(y)) < 2:
        w[-1] = LARGEST * (2 * y[0] - 1)
        return w
    for _ in range(steps):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) / len(y) + ridge * np.r_[w[:-1], 0]
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + (ridge + 1e-9) * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w -= move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-6:
            break
    return w


def _evidence(odds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros((len(bounds) - 1, EVIDENCE))
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        first = bounds[some]
        low, high = (np.add.reduceat((odds > mark).astype(float), first) for mark in MARKS)
        out[some] = np.stack(
            [np.maximum.reduceat(odds, first), np.add.reduceat(odds.astype(float), first) / np.diff(bounds)[some], np.log1p(low), low > 0, high > 0], axis=1
        )
    return out


class TextView(NamedTuple):
    """Per flaw the log odds of words for it, and a logistic regression over a text's evidence and binned figures.

    The logits are those of a text without the flaw.
    """

    edges: np.ndarray
    odds: np.ndarray
    weights: np.ndarray

    def places(self, rows: Rows) -> np.ndarray:
        return np.stack([EVIDENCE + j * BINS + np.searchsorted(self.edges[j], rows.figures[:, j]) for j in range(FIGURES)], axis=1)

    def logit(self, rows: Rows) -> np.ndarray:
        at = self.places(rows)
        z = [_evidence(o[rows.words], rows.bounds) @ w[:EVIDENCE] + w[at].sum(axis=1) + w[-1] for o, w in zip(self.odds, self.weights, strict=True)]
        return np.stack(z, axis=1)


def _fit_text(edges: np.ndarray, rows: Rows, y: np.ndarray, counts: np.ndarray, total: np.ndarray) -> TextView:
    """From the documents of either label (``total``) and those with each word (``counts``) per flaw, ``rows`` among them."""

    def odds(bad, good, n_bad, n_good):
        # words seen a few times say nothing yet
        value = np.log((bad + 1) / (n_bad + 2)) - np.log((good + 1) / (n_good + 2))
        return np.where(bad + good >= 5, value, 0.0)

    view = TextView(edges, np.zeros((2, WORD_BUCKETS), np.float32), np.zeros((2, EVIDENCE + FIGURES * BINS + 1)))
    places = view.places(rows)
    binned = np.zeros((len(y), view.weights.shape[1] - 1))
    binned[np.arange(len(y))[:, None], places] = 1
    for flaw in range(2):
        # a text is judged by the counts of the others
        label = np.repeat(y[:, flaw], np.diff(rows.bounds))
        bad, good = ((counts[flaw, k][rows.words] - (label == k), total[flaw, k] - (label == k)) for k in range(2))
        binned[:, :EVIDENCE] = _evidence(odds(bad[0], good[0], bad[1], good[1]), rows.bounds)
        view.weights[flaw] = _logistic(binned, y[:, flaw])
        view.odds[flaw] = odds(counts[flaw, 0], counts[flaw, 1], *total[flaw])
    return view


class MetaView(NamedTuple):
    """Per flaw a logistic regression over the binned length told and hashed source and language."""

    edges: np.ndarray
    weights: np.ndarray

    def cells(self, rows: Rows) -> np.ndarray:
        return (np.searchsorted(self.edges, rows.told) * SOURCES + rows.names[:, 0]) * LANGS + rows.names[:, 1]

    def logit(self, rows: Rows) -> np.ndarray:
        at = _features(self.cells(rows))
        return np.stack([w[at].sum(axis=1) + w[-1] for w in self.weights], axis=1)


def _features(cells: np.ndarray) -> np.ndarray:
    """The columns of a cell's bin, source and language in the weights of the metadata view."""
    return np.stack([cells // (SOURCES * LANGS), BINS + cells // LANGS % SOURCES, BINS + SOURCES + cells % LANGS], axis=1)


def _fit_meta(edges: np.ndarray, cells: np.ndarray, ridge: float = 3e-3) -> MetaView:
    """By Newton steps from the rows in each cell per flaw and label; equal cells are one weighted row."""
    weights = np.zeros((2, META + 1))
    for flaw in range(2):
        used = np.flatnonzero(cells[flaw].sum(axis=0))
        n, good = cells[flaw][:, used].sum(axis=0), cells[flaw][1, used]
        w = weights[flaw]
        if good.sum() in (0, n.sum()):
            w[-1] = LARGEST if good.sum() else -LARGEST
            continue
        at = np.c_[_features(used), np.full(len(used), META)]
        keep = np.append(np.full(META, ridge), 0)
        for _ in range(25):
            p = _sigmoid(w[at].sum(axis=1))
            slope = np.bincount(at.ravel(), np.repeat(n * p - good, 4), META + 1) / n.sum() + keep * w
            pairs = (at[:, :, None] * (META + 1) + at[:, None, :]).reshape(len(at), -1)
            curve = np.bincount(pairs.ravel(), np.repeat(n * p * (1 - p), 16), (META + 1) ** 2).reshape(META + 1, -1)
            move = np.linalg.solve(curve / n.sum() + np.diag(keep + 1e-9), slope)
            w -= move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
            if np.abs(move).max() < 1e-4:
                break
    return MetaView(edges, weights)


class QualityModel(NamedTuple):
    text: TextView
    meta: MetaView
    #: Per view and flaw the calibrated logit is a x + b; per flaw a weighted sum of both views and the lower one.
    calibration: np.ndarray
    combination: np.ndarray
    #: The round of the exchange that held-out labels found best; 0 is before it.
    round: int

    def scores(self, rows: Rows) -> np.ndarray:
        """Probabilities of a good document by the text, by the metadata and by both."""
        z = _logits(self.text, self.meta, rows)
        z = z * self.calibration[:, :, 0] + self.calibration[:, :, 1]
        both = np.stack([_both(z[:, :, flaw]) @ c[:3] + c[3] for flaw, c in enumerate(self.combination)], axis=1)
        return np.c_[_sigmoid(z).prod(axis=2), _sigmoid(both).prod(axis=1)]


def _logits(text: TextView, meta: MetaView, rows: Rows) -> np.ndarray:
    """Per row, view and flaw."""
    return np.round(np.clip(np.stack([text.logit(rows), meta.logit(rows)], axis=1), -LARGEST, LARGEST), 6)


def _both(z: np.ndarray) -> np.ndarray:
    """The calibrated logits and the lower of them: one view alone may see what is wrong."""
    return np.c_[z, z.min(axis=1)]


def _calibrated(text: TextView, meta: MetaView, rows: Rows, y: np.ndarray, turn: int) -> QualityModel:
    z = _logits(text, meta, rows)
    calibration = np.array([[_logistic(z[:, view, [flaw]], y[:, flaw], ridge=1e-2) for flaw in range(2)] for view in range(2)])
    z = z * calibration[:, :, 0] + calibration[:, :, 1]
    combination = np.array([_logistic(_both(z[:, :, flaw]), y[:, flaw], ridge=1e-2) for flaw in range(2)])
    return QualityModel(text, meta, calibration, combination, turn)


class Exchange(NamedTuple):
    """A round: its views, and per view, flaw and label the least confidence (a logit) that is handed over."""

    text: TextView
    meta: MetaView
    least: np.ndarray


def _offered(z: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Confidence per row, view, flaw and label of what a view may hand over; -inf for the rest."""
    sure = np.stack([-z, z], axis=3)
    return np.where((sure >= np.log(CONFIDENT / (1 - CONFIDENT))) & ~given[..., None], sure, -np.inf)


def _given(batch: pa.RecordBatch, rows: Rows, past: list[Exchange]) -> np.ndarray:
    """Which view needs no more to hand over a row's flaw: it did in ``past`` rounds, or the row is in the labelled sample."""
    given = np.zeros((batch.num_rows, 2, 2), bool)
    given[batch.column("sampled").to_numpy(zero_copy_only=False)] = True
    for turn in past:
        given |= (_offered(_logits(turn.text, turn.meta, rows), given) >= turn.least).any(axis=3)
    return given


def _steps(sure: np.ndarray) -> np.ndarray:
    low = np.log(CONFIDENT / (1 - CONFIDENT))
    return np.clip((sure - low) / (LARGEST - low) * STEPS, 0, STEPS - 1).astype(np.int64)


def _sums(frame: DataFrame, size: int) -> np.ndarray:
    """The sums, of a fixed size, of what all partitions counted (place, n)."""
    found = frame.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return out


def _nonzero(counts: np.ndarray) -> pa.RecordBatch:
    place = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(place), pa.array(counts[place], pa.float64())], names=["place", "n"])


def _trusted(sure: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per view, flaw and label the least confidence from which held-out rows show few enough errors; inf if there is none."""
    least = np.full((2, 2, 2), np.inf)
    for view, flaw, label in np.ndindex(2, 2, 2):
        right = y[:, flaw] == label
        bound = min(ERRORS, (1 - right.mean()) / BLIND)
        order = np.argsort(-sure[:, view, flaw, label], kind="stable")
        value = sure[order, view, flaw, label]
        n = np.arange(1, len(value) + 1)
        fine = ((np.cumsum(~right[order]) + 1) / (n + 2) <= bound) & np.isfinite(value)
        fine &= value != np.append(value[1:], -np.inf)  # rows of one confidence go together
        if fine.any():
            least[view, flaw, label] = value[fine][-1]
    return least


def _least_handed(pool: DataFrame, past: list[Exchange], text: TextView, meta: MetaView, trusted: np.ndarray) -> np.ndarray:
    """Per view, flaw and label the confidence that the surest HANDED of the rows not handed over yet reach, and ``trusted``."""

    def run(batches):
        counts, left = np.zeros((2, 2, 2, STEPS), np.int64), np.zeros((2, 2), np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = Rows.read(batch)
                given = _given(batch, rows, past)
                left += (~given).sum(axis=0)
                sure = _offered(_logits(text, meta, rows), given)
                row, view, flaw, label = np.nonzero(sure >= trusted)
                np.add.at(counts, (view, flaw, label, _steps(sure[row, view, flaw, label])), 1)
        yield _nonzero(np.append(counts.reshape(-1), left))

    found = _sums(pool.mapInArrow(run, "place long, n double"), 8 * STEPS + 4)
    least = np.full((2, 2, 2), np.inf)
    low = np.log(CONFIDENT / (1 - CONFIDENT))
    for view, flaw, label in np.ndindex(2, 2, 2):
        most = int(HANDED * found[8 * STEPS + 2 * view + flaw])
        n = found[: 8 * STEPS].reshape(2, 2, 2, STEPS)[view, flaw, label]
        above = np.cumsum(n[::-1])[::-1]
        if most and above[0]:
            # rows of one step go together
            step = int(np.flatnonzero(above >= min(most, above[0]))[-1])
            least[view, flaw, label] = max(trusted[view, flaw, label], low + step * (LARGEST - low) / STEPS)
    return least


def _handed_over(pool: DataFrame, past: list[Exchange], turn: Exchange) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the round hands over, per flaw and label: to the text view documents with each word and documents, to the other rows per cell."""

    def run(batches):
        words, total, cells = np.zeros((2, 2, WORD_BUCKETS), np.int64), np.zeros((2, 2), np.int64), np.zeros((2, 2, CELLS), np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = Rows.read(batch)
                handed = _offered(_logits(turn.text, turn.meta, rows), _given(batch, rows, past)) >= turn.least
                cell = turn.meta.cells(rows)
                for flaw, label in np.ndindex(2, 2):
                    by_text, by_meta = (np.flatnonzero(handed[:, view, flaw, label]) for view in range(2))
                    total[flaw, label] += len(by_meta)
                    words[flaw, label] += np.bincount(rows.take(by_meta).words, minlength=WORD_BUCKETS)
                    cells[flaw, label] += np.bincount(cell[by_text], minlength=CELLS)
        yield _nonzero(np.concatenate([words.reshape(-1), total.reshape(-1), cells.reshape(-1)]))

    found = _sums(pool.mapInArrow(run, "place long, n double"), 4 * (WORD_BUCKETS + 1 + CELLS))
    words, total, cells = np.split(found, [4 * WORD_BUCKETS, 4 * WORD_BUCKETS + 4])
    return words.reshape(2, 2, -1), total.reshape(2, 2), cells.reshape(2, 2, -1)


def _judged(model: QualityModel, rows: Rows, y: np.ndarray) -> np.ndarray:
    """Held-out loss, and the kept share of the documents with either flaw."""
    p = np.clip(model.scores(rows)[:, 2], 1e-9, 1 - 1e-9)
    good = y.all(axis=1)
    kept = p >= KEEP
    return np.array([-np.log(np.where(good, p, 1 - p)).mean(), *((kept & (y[:, flaw] == 0)).sum() / max((y[:, flaw] == 0).sum(), 1) for flaw in range(2))])


def fit_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    rounds: int = ROUNDS,
    labelled_rows: int = LABELLED_ROWS,
    seed: int = 17,
) -> QualityModel | None:
    """A model of ``labels`` (key, quality, toxic), or None unless good and other documents occur among them.

    A document has two flaws, apart from each other: toxic unless toxic is 0, junk
    unless quality is 1; a key with several rows has those of all.  Rows with
    a null are no labels.  Of the labelled documents about ``labelled_rows`` are
    taken, by a hash of the key; all others take part without a label, also
    those with a null key.  The text view sees words and figures of the text,
    the metadata view the told length, source and language only.  In each
    round both views are fitted, and per flaw and label each hands the documents
    it is surest of, and has not handed over yet, to the other as labels.  It does so
    only from a confidence on at which held-out labels show few errors.  Words
    and features are stored once and scored on Spark in every round; only sums
    of a fixed size reach the driver.  A fifth of the labelled sample is kept
    from this: on it the logits of each view are calibrated and the views
    combined, and the exchange ends with the round before its loss, or the kept share of
    either flaw, rises.  Ties: rows of equal confidence go together.  Very long
    texts are read whole, a slice of rows at a time.
    """
    ship_package(docs.sparkSession)
    toxic, junk = F.col("toxic") != 0, F.col("quality") != 1
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col(key).alias("id")).agg(F.max(toxic).alias("toxic"), F.max(junk).alias("junk"))
    share = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20))
    n_labels = known.count()
    if not n_labels:
        return None
    # a sample of a set size: as a stored table the planner knows its size
    chosen = materialize(known.where(share < -(-labelled_rows * (1 << 20) // n_labels)), "quality_sample")

    def features(batches):
        for part in slices(batches, "text_in"):
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("toxic"), part.column("junk"), *_views(part).to_arrow()], names=columns)

    columns = ["id", "toxic", "junk", "words", "figures", "told", "names"]
    kind = docs.schema[key].dataType.simpleString()
    rows = _picked(docs, key).join(chosen, F.col("key_in") == F.col("id"), "left").drop("key_in")
    rows = rows.mapInArrow(features, f"id {kind}, toxic boolean, junk boolean, words array<int>, figures array<float>, told double, names array<int>")
    stored = materialize(rows, "pool")
    pool = stored.select(F.col("id").isNotNull().alias("sampled"), "words", "figures", "told", "names")
    sample = stored.where("id IS NOT NULL").withColumn("size", F.size("words")).sort("id", "size", F.hash("words"), "told").toArrow()
    if not sample.num_rows:
        return None
    y = 1 - np.stack([sample.column(c).to_numpy().astype(int) for c in ("toxic", "junk")], axis=1)
    labelled = np.random.Generator(np.random.PCG64(seed)).permutation(len(y))
    every = Rows.read(sample)
    held, base = (every.take(part) for part in np.split(labelled, [len(y) // 5]))
    y_held, y_base = np.split(y[labelled], [len(y) // 5])
    if any(len(set(part.all(axis=1))) < 2 for part in (y_held, y_base)):
        return None
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    figure_edges, told_edges = np.quantile(base.figures, cuts, axis=0).T, np.quantile(base.told, cuts)
    counts, cells = np.zeros((2, 2, WORD_BUCKETS)), np.zeros((2, 2, CELLS))
    at = MetaView(told_edges, np.zeros((2, META + 1))).cells(base)
    for flaw, label in np.ndindex(2, 2):
        mine = np.flatnonzero(y_base[:, flaw] == label)
        counts[flaw, label] = np.bincount(base.take(mine).words, minlength=WORD_BUCKETS)
        cells[flaw, label] = np.bincount(at[mine], minlength=CELLS)
    total = np.stack([np.bincount(y_base[:, flaw], minlength=2) for flaw in range(2)]).astype(float)
    past: list[Exchange] = []
    best, lowest = None, None
    for number in range(rounds + 1):
        text, meta = _fit_text(figure_edges, base, y_base, counts, total), _fit_meta(told_edges, cells)
        model = _calibrated(text, meta, held, y_held, number)
        judged = _judged(model, held, y_held)
        if best is not None and (judged > lowest).any():
            break
        best, lowest = model, judged
        if number == rounds:
            break
        trusted = _trusted(_offered(_logits(text, meta, held), np.zeros((len(y_held), 2, 2), bool)), y_held)
        if not np.isfinite(trusted).any():
            break
        turn = Exchange(text, meta, _least_handed(pool, past, text, meta, trusted))
        if not np.isfinite(turn.least).any():
            break
        more = _handed_over(pool, past, turn)
        counts, total, cells = counts + more[0], total + more[1], cells + more[2]
        past.append(turn)
    return best


def _picked(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(
        docs[key].alias("key_in"),
        docs["text"].alias("text_in"),
        docs["source"].cast("string").alias("source_in"),
        docs["lang"].cast("string").alias("lang_in"),
        docs["n_chars"].cast("double").alias("n_chars_in"),
    )


def score_documents(docs: DataFrame, model: QualityModel | None, *, key: str = "doc_id", keep: float = KEEP) -> DataFrame:
    """Per row of ``docs``: key, text_score, meta_score, score (0 to 1) and kept.

    The first two are the calibrated probabilities of each view, score that of
    both; kept is score >= ``keep``.  Texts without a word (null ones too) score
    0 and are not kept.  Without a model the scores of others are null and they
    are kept.  Null sources, languages and lengths are values of their own;
    null and repeated keys are kept, a row each; an empty table gives no rows.
    Nothing is shuffled.  The model sent to the tasks has a fixed size.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for part in slices(batches, "text_in"):
            rows = _views(part)
            empty = np.diff(rows.bounds) == 0
            if model is None:
                scores = [pa.array([0.0 if e else None for e in empty], pa.float64())] * 3
                kept = ~empty
            else:
                p = model.scores(rows)
                p[empty] = 0
                scores = [pa.array(p[:, j]) for j in range(3)]
                kept = (p[:, 2] >= keep) & ~empty
            arrays = [part.column("key_in"), *scores, pa.array(kept)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key_in", "text_score", "meta_score", "score", "kept"])

    out = f"key_in {kind}, text_score double, meta_score double, score double, kept boolean"
    return _picked(docs, key).mapInArrow(run, out).withColumnRenamed("key_in", key)

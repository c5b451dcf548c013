"""Quality rules: plain counts per document and a calibrated classifier over hashed word and character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytework import BYTE_CODE, LOWER, SPACE, mix, run_hashes, runs, text_bytes, whole_windows, window_hashes
from tidemark.llm.common import arrow_map, pieces

# Bound of the labelled rows that the classifier is fitted on.
SAMPLE_ROWS = 2000
DIMENSIONS = 2**16
KEEP_AT = 0.5
EPOCHS = 120
STEP = 20.0
SHRINK = 1e-6
# Bytes of text whose n-grams a task holds at once; an n-gram takes some 100 bytes on its way.
SCAN_BYTES = 250_000
# Entries of the sample's sparse rows that a sweep of the fit takes at once.
FIT_ENTRIES = 500_000

MIN_WORDS = 20
WINDOW = 8
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each (row, key) occurs, and whether an entry is not the first of its kind."""
    own = mix(keys + mix(rows.astype(np.uint64)))
    _, first, place, count = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(own), dtype=bool)
    later[first] = False
    return count[place], later


def rule_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Plain counts for texts given as bytes; words are runs without ASCII white space.

    Lines and windows are compared by 64-bit hashes within one document.
    """
    n = len(offsets) - 1
    blank = SPACE[data]
    starts, ends, row = runs(~blank, offsets)
    hashes = run_hashes(data, starts, ends)
    out = {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": _per_row(~blank & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_row(SYMBOLS[data], offsets),
    }
    line_starts, line_ends, line_row = runs(data != 10, offsets)
    words_before = np.concatenate([[0], np.cumsum(~blank, dtype=np.int64)])
    filled = words_before[line_ends] > words_before[line_starts]
    line_starts, line_ends, line_row = line_starts[filled], line_ends[filled], line_row[filled]
    _, later = _repeats(run_hashes(data, line_starts, line_ends), line_row)
    out["n_dup_lines"] = np.bincount(line_row[later], minlength=n)
    inside = whole_windows(row, WINDOW)
    windows = window_hashes(hashes, WINDOW)
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(windows):
        at = np.flatnonzero(inside)
        times, _ = _repeats(windows[at], row[at])
        at = at[times > 1]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(row[np.cumsum(covered)[:-1] > 0], minlength=n)
    return out


def features(data: np.ndarray, offsets: np.ndarray, dimensions: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams in four families, each as (dimension, row): one and two words, three and five characters."""
    low = LOWER[data]
    starts, ends, row = runs(~SPACE[data], offsets)
    hashes = run_hashes(data, starts, ends)
    families = [(hashes, row)]
    pair, ok = window_hashes(hashes, 2), whole_windows(row, 2)
    families.append((pair[ok], row[1:][ok]))
    place = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for size in (3, 5):
        if len(low) >= size:
            total = np.zeros(len(low) - size + 1, dtype=np.uint64)
            for step in range(size):
                total = total * np.uint64(0x100000001B3) + BYTE_CODE[low[step: len(low) - size + 1 + step]]
            ok = whole_windows(place, size)
            families.append((total[ok], place[size - 1:][ok]))
    shift = np.uint64(64 - int(dimensions).bit_length() + 1)
    return [((mix(h + np.uint64(k)) >> shift).astype(np.int64), r) for k, (h, r) in enumerate(families)]


def raw_scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over the families of the mean weight of a document's n-grams."""
    n = len(offsets) - 1
    total = np.zeros(n)
    for dimension, row in features(data, offsets, len(weights)):
        total += np.bincount(row, weights[dimension], n) / np.maximum(1, np.bincount(row, minlength=n))
    return total


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts and quality of at most ``rows`` labelled documents, in an order given by a hash of the id.

    A document with several labels takes the smallest. The list of chosen ids is bounded by ``rows``, so it is broadcast.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").limit(2 * rows)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS) -> dict | None:
    """Weights and calibration fitted on a bounded sample; None where the sample lacks one of the classes.

    The tasks turn the sample's texts into sparse rows, at most ``2 * rows`` with at most ``dimensions`` entries each; one task
    fits the model on them and only that comes to the driver. Four fifths train the weights by gradient steps with per-weight rates; the rest fits slope
    and intercept that turn scores into probabilities.
    """
    def sparse(batches):
        for batch in pieces(batches, "text", SCAN_BYTES):
            data, offsets = text_bytes(batch.column(1))
            n = batch.num_rows
            keys, values = [], []
            for dimension, row in features(data, offsets, dimensions):
                key, count = np.unique(row * dimensions + dimension, return_counts=True)
                keys.append(key)
                values.append(count / np.maximum(1, np.bincount(row, minlength=n))[key // dimensions])
            keys, values = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
            cuts = np.searchsorted(keys, np.arange(n + 1) * dimensions)
            yield {
                "doc_id": batch.column(0), "quality": batch.column(2),
                "at": [(keys[a:b] % dimensions).astype("<i4").tobytes() for a, b in zip(cuts, cuts[1:])],
                "x": [values[a:b].astype("<f4").tobytes() for a, b in zip(cuts, cuts[1:])],
            }

    def train(batches):
        held = list(batches)
        if not held:
            return
        got = pa.Table.from_batches(held).sort_by([("doc_id", "ascending")])
        held.clear()
        y = (got["quality"].to_numpy() > 0).astype(np.float64)
        if len(y) < 10 or y.min() == y.max():
            return
        held = np.arange(len(y)) % 5 == 4
        at = [np.frombuffer(v.as_buffer(), dtype="<i4") for v in got["at"]]
        x = [np.frombuffer(v.as_buffer(), dtype="<f4") for v in got["x"]]
        weights = _train([a for a, h in zip(at, held) if not h], [v for v, h in zip(x, held) if not h], y[~held], dimensions)
        scores = np.array([float(np.dot(weights[a], v)) for a, v, h in zip(at, x, held) if h])
        slope, intercept = _calibrate(scores, y[held])
        yield {"weights": [weights.astype("<f8").tobytes()], "slope": [slope], "intercept": [intercept]}

    sample = labelled_sample(docs, labels, rows).select("doc_id", "text", F.col("quality").cast("int"))
    found = arrow_map(sample, sparse, "doc_id long, quality int, at binary, x binary").repartition(1)
    fitted = arrow_map(found, train, "weights binary, slope double, intercept double").collect()
    if not fitted:
        return None
    return {"weights": np.frombuffer(fitted[0]["weights"], dtype="<f8"), "slope": fitted[0]["slope"], "intercept": fitted[0]["intercept"]}


def _train(at: list[np.ndarray], x: list[np.ndarray], y: np.ndarray, dimensions: int) -> np.ndarray:
    """Logistic regression by full gradients; the classes weigh the same."""
    sizes = np.array([len(a) for a in at])
    at, x = np.concatenate(at, dtype=np.int32), np.concatenate(x, dtype=np.float32)
    ends = np.cumsum(sizes)
    # A sweep takes whole rows of some FIT_ENTRIES entries at a time, so that only these are widened.
    firsts = np.flatnonzero(np.diff((ends - sizes) // FIT_ENTRIES, prepend=-1)).tolist()
    blocks = [(i, j, int(ends[i] - sizes[i]), int(ends[j - 1])) for i, j in zip(firsts, [*firsts[1:], len(sizes)])]
    share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    weights, seen, bias, bias_seen = np.zeros(dimensions), np.full(dimensions, 1e-12), 0.0, 1e-12
    every = np.arange(dimensions)
    for _ in range(EPOCHS):
        slope = np.zeros(dimensions)
        error = np.empty(len(sizes))
        for i, j, a, b in blocks:
            row = np.repeat(np.arange(j - i), sizes[i:j])
            error[i:j] = np.bincount(row, weights[at[a:b]] * x[a:b], j - i) + bias
        error = share * (1 / (1 + np.exp(-np.clip(error, -30, 30))) - y)
        for i, j, a, b in blocks:
            # The sums so far stand before the block's products, so the order of the additions does not depend on the blocks.
            part = np.concatenate([slope, np.repeat(error[i:j], sizes[i:j]) * x[a:b]])
            slope = np.bincount(np.concatenate([every, at[a:b]]), part, dimensions)
        slope += SHRINK * weights
        seen += slope * slope
        weights -= STEP * slope / np.sqrt(seen) / 10
        bias_slope = error.sum()
        bias_seen += bias_slope**2
        bias -= bias_slope / np.sqrt(bias_seen) / 10
    return weights


def _calibrate(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the log odds as a function of the score, with smoothed targets, by Newton steps."""
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(1e-9, float(scores.std()) if len(scores) else 1.0)
    z = np.stack([scores / scale, np.ones(len(scores))], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        slope = z.T @ (p - target) + 1e-3 * theta
        bend = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        theta -= np.linalg.solve(bend, slope)
    return float(theta[0] / scale), float(theta[1])


def score_quality(docs: DataFrame, model: dict | None, keep_at: float = KEEP_AT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, base verdict, probability of good quality and final verdict for every row, plus all its columns.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in repeated windows of eight. ``kept`` is false
    then, else whether the probability reaches the threshold. Without a model every document that passes the base is
    kept (probability null). Null and empty texts have no words and fail; null ids and repeated rows are kept as they are.
    Nothing is shuffled; the model has a fixed size and travels with the tasks. Columns of the input whose names clash
    with the results are replaced by the results.
    """
    added = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"}
    carried = [c for c in docs.columns if c not in added]
    scan = "_scan_text"
    # A carried text goes to the tasks once.
    once = text_column in carried and docs.schema[text_column].dataType == T.StringType()
    sent = [] if once else [F.col(text_column).cast("string").alias(scan)]
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], *sent)
    shape = docs.select(*[F.col(f"`{c}`") for c in carried]).schema
    for name in COUNTS.split(", "):
        shape = shape.add(name.split(" ")[0], "long")
    shape = shape.add("base_failed", "boolean").add("probability", "double").add("kept", "boolean")
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = spread.value
        if once:
            batches = (b.append_column(scan, b.column(carried.index(text_column))) for b in batches)
        for batch in pieces(batches, scan, SCAN_BYTES):
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            counts = rule_counts(data, offsets)
            failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])
            if own is None:
                probability, verdict = [None] * batch.num_rows, ~failed
            else:
                log_odds = own["slope"] * raw_scores(data, offsets, own["weights"]) + own["intercept"]
                probability = 1 / (1 + np.exp(-np.clip(log_odds, -700, 700)))
                verdict = ~failed & (probability >= keep_at)
            yield {c: batch.column(k) for k, c in enumerate(carried)} | counts | {
                "base_failed": failed, "probability": probability, "kept": verdict,
            }

    return arrow_map(rows, run, shape)

"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
DIMENSIONS = 16
#: Bound of the training sample: passages in all, and per language; characters of a passage.
SAMPLE_ROWS = 12_000
ROWS_PER_LANGUAGE = 1_500
PASSAGE_CHARS = 600
#: Share of correctly recognised passages that calibration gives up.
REJECTED_SHARE = 0.0005
#: Steps of the descent, whatever the size of the sample: small samples are passed more often.
STEPS = 600
BLOCK_BYTES = 1 << 20
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: ASCII digits, marks and white space all read as a space.
_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def subwords(data: bytes) -> np.ndarray:
    """Hash buckets of all byte strings of two, three and four, digits and marks read as spaces."""
    b = np.frombuffer(data.translate(_FOLD), dtype=np.uint8).astype(np.uint32)
    out, state = [], b * np.uint32(2654435761)
    for n in (2, 3, 4):
        if len(b) < n:
            break
        state = (state[:-1] ^ (state[:-1] >> np.uint32(15))) * np.uint32(2246822519) + b[n - 1:] * np.uint32(3266489917)
        mixed = state + np.uint32(n * 668265263 & 0xFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint32(16))) * np.uint32(2654435761)
        out.append(mixed >> np.uint32(18))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def histogram(text: str) -> np.ndarray:
    """How often each bucket occurs in the whole text, block by block."""
    data = f" {text.lower()} ".encode("utf-8", "replace")
    total = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(data), BLOCK_BYTES):
        total += np.bincount(subwords(data[at:at + BLOCK_BYTES + 3]), minlength=BUCKETS)
    return total


@dataclass
class LanguageModel:
    """Languages, the product of embeddings and output weights, bias, temperature and rejection threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.table / max(counts.sum(), 1) + self.bias

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        z = self.logits(counts) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether the text is rejected."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        p = self.probabilities(histogram(text))
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)


def train(passages: list[tuple[str, str]], least_steps: int = STEPS, rate: float = 8.0, batch: int = 64,
          seed: int = 11) -> LanguageModel:
    """Minibatch gradient descent on (language, passage); every fifth passage is kept for calibration.

    The sample is passed as often as ``least_steps`` steps take.
    """
    languages = sorted({lang for lang, _ in passages})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    sparse = [_shares(histogram(text)) for _, text in passages]
    target = np.asarray([languages.index(lang) for lang, _ in passages])
    order = np.random.default_rng(seed).permutation(len(passages))
    held, fitted = order[::5], np.setdiff1d(order, order[::5])
    fitted = fitted if len(fitted) else order
    rng = np.random.default_rng(seed + 1)
    embedding = (rng.random((BUCKETS, DIMENSIONS), dtype=np.float32) - 0.5) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    batches = max(1, len(fitted) // batch)
    epochs = -(-least_steps // batches)
    steps, step = epochs * batches, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(fitted), batches):
            used = np.unique(np.concatenate([sparse[row][0] for row in rows]))
            x = np.zeros((len(rows), len(used)), dtype=np.float32)
            for k, row in enumerate(rows):
                x[k, np.searchsorted(used, sparse[row][0])] = sparse[row][1]
            hidden = x @ embedding[used]
            z = hidden @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), target[rows]] -= 1
            pace = np.float32(rate * max(1 - step / max(steps, 1), 0.05))
            back = p @ weights.T
            weights -= pace * hidden.T @ p / len(rows)
            bias -= np.float32(0.02) * pace * p.mean(axis=0)
            embedding[used] -= pace * 8 * (x.T @ back) / len(rows)
            step += 1
    model = LanguageModel(languages, embedding @ weights, bias.astype(np.float64))
    logits = np.asarray([sparse[row][1] @ model.table[sparse[row][0]] + model.bias for row in held])
    if len(held):
        scales = np.geomspace(0.02, 2.0, 40)
        losses = [-_log_likelihood(logits / s, target[held]) for s in scales]
        model.temperature = float(scales[int(np.argmin(losses))])
        p = np.exp(logits / model.temperature - (logits / model.temperature).max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        right = p.max(axis=1)[p.argmax(axis=1) == target[held]]
        # a probability of one half is accepted in any case: that language is likelier right than wrong
        model.threshold = min(float(np.quantile(right, REJECTED_SHARE)), 0.5) if len(right) else 0.0
    return model


def _shares(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The used buckets and their shares."""
    used = np.flatnonzero(counts)
    return used.astype(np.int32), (counts[used] / max(counts.sum(), 1)).astype(np.float32)


def _log_likelihood(z: np.ndarray, target: np.ndarray) -> float:
    z = z - z.max(axis=1, keepdims=True)
    return float((z[np.arange(len(z)), target] - np.log(np.exp(z).sum(axis=1))).mean())


def sample(docs: DataFrame, learn: Column) -> list[tuple[str, str]]:
    """A bounded sample of passages at hashed places, about equally many per language."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return []
    each = min(ROWS_PER_LANGUAGE, max(SAMPLE_ROWS // len(sizes), 20))
    rates = docs.sparkSession.createDataFrame([(lang, min(1.0, each / n)) for lang, n in sizes.items()], "lang string, rate double")
    # one row per language, so the broadcast is bounded by the languages just counted
    draw = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    size = F.when(F.pmod(F.xxhash64("doc_id", F.lit("size")), F.lit(3)) == 0, 60).otherwise(PASSAGE_CHARS)
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.length("text") - size, F.lit(0)) + 1).cast("int") + 1
    rows = (known.select("doc_id", "lang", "text").join(F.broadcast(rates), "lang").where(draw < F.col("rate"))
            .select("lang", F.substring(F.col("text"), place, size).alias("passage"), "doc_id").collect())
    ordered = sorted((r["doc_id"], r["lang"], r["passage"]) for r in rows)
    return [(lang, passage) for _, lang, passage in ordered if _LETTER.search(passage)]


def fit(docs: DataFrame, learn: Column | None = None) -> LanguageModel:
    """A model from the non-null languages of the rows where ``learn`` holds (all by default)."""
    return train(sample(docs, F.lit(True) if learn is None else learn))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row, from its whole text alone.

    Null text and text without a letter are ``und`` with score 0 and rejected.
    Any other text gets a learned language; it is rejected where the calibrated
    probability lies below the model's threshold. Without any learned language
    all is ``und``. Repeated rows give repeated results, an empty table none;
    other columns are ignored. Long texts are read in blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id bigint, lang_pred string, score double, rejected boolean"))


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns as they are.

    The text travels through the task beside its row, so no join is needed.
    """
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not model.predict(t.as_py())[2] for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two words is the inner product of their gap-weighted
subsequences: every choice of ORDER characters in order counts with DECAY to the
power of the stretch it spans. A gap or an inserted character lengthens the
stretch but keeps the subsequence, so an altered insult stays close to the plain
one. Landmark words span the feature space; a text is read as sentences, a
sentence as its most toxic word.

Learning takes as witnesses of a toxic text the word of highest margin, where
that word is likelier in toxic texts than chance allows or close to such words,
so that texts labelled by mistake teach nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 4
DECAY = 0.5
SYMBOLS = 32
#: Longer words are read in pieces of so many characters that overlap by half.
PIECE = 24
#: Bounds of the training sample: texts of each label, sentences of a clean and of a toxic text, characters of a sentence.
TEXTS_PER_LABEL = 2_000
SENTENCES_PER_TEXT = 40
SENTENCES_PER_TOXIC_TEXT = 1_000
SENTENCE_CHARACTERS = 400
LANDMARKS = 192
CACHED_WORDS = 500_000
#: Standard errors by which a word must be likelier in toxic texts to be taken for their cause.
BOUND = 2.0
CUT = 0.3
_SENTENCE = regex.compile(r"[^.!?\n]+")
_NOT_LETTER = regex.compile(r"\P{L}+")
_RUN = regex.compile("1{4,}")
_PICKS = {n: np.asarray(list(combinations(range(n), ORDER)), dtype=np.int32).reshape(-1, ORDER) for n in range(PIECE + 2)}


def codes(words: list[str]) -> np.ndarray:
    """Symbols of equally long words behind a start mark: a to z as 1 to 26, all others hashed into the rest."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "replace"), dtype="<u4").reshape(len(words), -1).astype(np.int32)
    out = np.zeros((len(words), points.shape[1] + 1), dtype=np.int32)
    out[:, 1:] = np.where((points >= 97) & (points <= 122), points - 96, 27 + points % 5)
    return out


def pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    return [word[at:at + PIECE] for at in range(0, len(word) - PIECE // 2, PIECE // 2)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index, weight) of every subsequence of equally long words: a row of indexes per word, one row of weights."""
    symbols = codes(words)
    picks = _PICKS[symbols.shape[1]]
    pairs = symbols[:, :, None] * SYMBOLS + symbols[:, None, :]
    pairs = pairs.reshape(len(words), -1)
    size = symbols.shape[1]
    index = pairs[:, picks[:, 0] * size + picks[:, 1]] * SYMBOLS ** 2 + pairs[:, picks[:, 2] * size + picks[:, 3]]
    return index, (DECAY ** (picks[:, -1] - picks[:, 0] + 1.0 - ORDER)).astype(np.float32)


def self_kernel(words: list[str]) -> np.ndarray:
    """The kernel of each of equally long words with itself, by the usual recursion over prefixes of both sides."""
    symbols = codes(words).T.copy()
    size, count = symbols.shape
    same = (symbols[:, None, :] == symbols[None, :, :]).astype(np.float32)
    # ends[a][b] sums, over common subsequences so far, DECAY for each step from their ends to the places a and b
    ends = np.ones((size + 1, size + 1, count), dtype=np.float32)
    total, half = np.zeros(count), np.float32(DECAY)
    for order in range(1, ORDER + 1):
        hit = same * ends[:-1, :-1]
        if order == ORDER:
            total = hit.sum(axis=(0, 1))
            break
        following = np.zeros_like(ends)
        for a in range(size):
            row = np.zeros(count, dtype=np.float32)
            for b in range(size):
                row = row * half + hit[a, b]
                following[a + 1, b + 1] = following[a, b + 1] * half + row
        ends = following
    return total


def features(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct subsequences of one word and their weights, scaled to length one."""
    index, weight = subsequences([word])
    distinct, place = np.unique(index[0], return_inverse=True)
    sums = np.bincount(place, weight, len(distinct)) if len(distinct) else np.empty(0)
    norm = np.sqrt((sums * sums).sum())
    return distinct, sums / norm if norm > 0 else sums


def tokens_of(text: str) -> list[str]:
    """What stands between white space in lower case, and runs of four or more single characters joined."""
    tokens = text.lower().split()
    single = "".join(["1" if len(t) == 1 else "0" for t in tokens])
    if "1111" in single:
        tokens += ["".join(tokens[m.start():m.end()]) for m in _RUN.finditer(single)]
    return tokens


def letters(token: str) -> str:
    return token if token.isalpha() else _NOT_LETTER.sub("", token)


def words_of(text: str) -> list[str]:
    return [letters(t) for t in tokens_of(text)]


@dataclass
class ToxicityModel:
    """The machine's weight of every subsequence, and the sigmoid that turns a margin into a score.

    ``table`` holds the landmarks' subsequences combined with their coefficients,
    so the kernel sum over all landmarks is one lookup for each subsequence.
    """

    table: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, words: list[str]) -> np.ndarray:
        """Decision values of words; of long words the highest of their pieces'."""
        out = np.full(len(words), self.bias)
        by_length: dict[int, list[tuple[int, str]]] = {}
        for at, word in enumerate(words):
            for piece in pieces(word):
                if len(piece) + 1 >= ORDER:
                    by_length.setdefault(len(piece), []).append((at, piece))
        best = np.full(len(words), -np.inf, dtype=np.float64)
        for length, group in by_length.items():
            step = max(1, (1 << 20) // max(len(_PICKS[length + 1]), 1))
            for low in range(0, len(group), step):
                part = group[low:low + step]
                index, weight = subsequences([p for _, p in part])
                value = self.table[index] @ weight / np.sqrt(self_kernel([p for _, p in part])) + self.bias
                np.maximum.at(best, np.asarray([a for a, _ in part]), value)
        return np.where(np.isfinite(best), best, out)

    def probability(self, margin: np.ndarray | float) -> np.ndarray | float:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


class Scorer:
    """Margins of tokens, kept for the next text; emptied when full."""

    def __init__(self, model: ToxicityModel):
        self.model, self.known = model, {}

    def tops(self, texts: list[str]) -> np.ndarray:
        """The highest margin of any word of each whole text; that of the bias without words."""
        tokens = [set(tokens_of(t)) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        fresh = list(set().union(*tokens).difference(self.known)) if tokens else []
        for at in range(0, len(fresh), 1 << 14):
            part = fresh[at:at + (1 << 14)]
            words = [letters(t) for t in part]
            distinct = list(set(words))
            margin = dict(zip(distinct, self.model.margins(distinct).tolist()))
            self.known.update(zip(part, map(margin.__getitem__, words)))
        get = self.known.__getitem__
        return np.asarray([max(map(get, t), default=self.model.bias) for t in tokens])

    def score(self, texts: list[str]) -> list[float]:
        return np.asarray(self.model.probability(self.tops(texts))).tolist()


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss by accelerated gradient descent."""
    z = np.c_[x, np.ones(len(x))]
    signs = np.where(y, 1.0, -1.0)
    lipschitz = 1.0 + 2 * np.linalg.norm(z * np.sqrt(cost)[:, None], 2) ** 2
    w = v = np.zeros(z.shape[1])
    keep = np.r_[np.ones(x.shape[1]), 1e-3]
    for k in range(rounds):
        slack = np.maximum(1 - signs * (z @ v), 0)
        grad = keep * v - 2 * z.T @ (cost * signs * slack)
        following = v - grad / lipschitz
        v, w = following + k / (k + 3) * (following - w), following
    return w[:-1], float(w[-1])


def train(labelled: list[tuple[str, int]], landmarks: int = LANDMARKS, rounds: int = 4) -> ToxicityModel:
    """A model from (text, label). Sentences of texts labelled 1 are witnesses chosen anew in each round.

    All sentences of a text labelled 0 are negative; of a text labelled 1 the
    sentence, and in it the word, with the highest margin is positive. The first
    round picks the word whose share among the toxic texts is highest.
    """
    bags = [([words_of(s) for s in _SENTENCE.findall(t)], label) for t, label in labelled]
    toxic = [[s for s in bag if s] for bag, label in bags if label]
    clean = [[s for s in bag if s] for bag, label in bags if not label]
    seen = [Counter(w for bag in side for w in {w for s in bag for w in s}) for side in (toxic, clean)]
    n1, n0 = max(len(toxic), 1), max(len(clean), 1)
    usable = lambda w: ORDER <= len(w) + 1 and len(w) >= 3
    odds = {w: np.log((c / n1 + 1e-4) / (seen[1][w] / n0 + 1e-4)) * min(c, 5) for w, c in seen[0].items() if usable(w)}

    def credible(word: str) -> bool:
        """Whether the lower bound of the word's log ratio between toxic and clean texts is above zero."""
        c1, c0 = seen[0][word], seen[1][word] + 0.5
        return c1 >= 2 and np.log(c1 / n1 * n0 / c0) > BOUND * np.sqrt(1 / c1 + 1 / c0)

    if not odds or not clean:
        return ToxicityModel(np.zeros(SYMBOLS ** ORDER, np.float32), -1.0, 1.0, 0.0)
    suspects = sorted(odds, key=lambda w: (-odds[w], w))[:landmarks * 2 // 3]
    common = [w for w, _ in sorted(seen[1].items(), key=lambda x: (-x[1], x[0])) if usable(w)][:landmarks - len(suspects)]
    chosen = list(dict.fromkeys(p for w in suspects + common for p in pieces(w)))
    spans = [features(w) for w in chosen]
    columns = np.unique(np.concatenate([index for index, _ in spans]))
    column = np.full(SYMBOLS ** ORDER, -1, dtype=np.int32)
    column[columns] = np.arange(len(columns))
    dense = np.zeros((len(chosen), len(columns)), dtype=np.float32)
    for row, (index, weight) in enumerate(spans):
        dense[row, column[index]] = weight
    values, vectors = np.linalg.eigh((dense @ dense.T).astype(np.float64))
    held = values > 1e-6 * values.max()
    root = vectors[:, held] / np.sqrt(values[held])

    def mapped(words: list[str]) -> np.ndarray:
        """Rows of the pieces of all words, one after the other."""
        words = [p for w in words for p in pieces(w)]
        out = np.zeros((len(words), len(columns)), dtype=np.float32)
        for row, word in enumerate(words):
            index, weight = features(word)
            place = column[index]
            out[row, place[place >= 0]] = weight[place >= 0]
        return out @ dense.T @ root

    # negatives are the most common words of clean texts and, after a round, those of highest margin
    clean_words = sorted((w for w in seen[1] if usable(w)), key=lambda w: (-seen[1][w], w))
    hardest: list[str] = []
    margin = dict(odds)
    for turn in range(rounds):
        witness = Counter()
        for bag in toxic:
            words = [w for s in bag for w in s if w in margin]
            if words:
                witness[max(words, key=lambda w: (margin[w], w))] += 1
        # a word no likelier in toxic texts than chance allows is no witness, unless the last machine finds it close to one
        positives = [w for w in sorted(witness) if credible(w) or turn and margin[w] > 0] or sorted(witness)
        negatives = list(dict.fromkeys(clean_words[:3000] + hardest))
        x1, x0 = mapped(positives), mapped(negatives)
        # every piece of a clean word is clean; the pieces of a witness share its weight
        c0 = np.sqrt(np.asarray([seen[1][w] for w in negatives for _ in pieces(w)], dtype=np.float64))
        c1 = np.asarray([witness[w] / len(pieces(w)) for w in positives for _ in pieces(w)])
        x, y = np.r_[x1, x0], np.r_[np.ones(len(x1), bool), np.zeros(len(x0), bool)]
        cost = np.r_[c1 / c1.sum(), c0 / c0.sum()] * 200
        weights, bias = _machine(x, y, cost)
        table = np.zeros(SYMBOLS ** ORDER, dtype=np.float32)
        table[columns] = (root @ weights) @ dense
        model = ToxicityModel(table, bias, 1.0, 0.0)
        if turn + 1 < rounds:
            known = list(margin)
            margin = dict(zip(known, model.margins(known).tolist()))
            order = np.argsort(-model.margins(clean_words), kind="stable")[:1000]
            hardest = list(dict.fromkeys(hardest + [clean_words[i] for i in order]))
    tops = Scorer(model).tops([t for t, _ in labelled])
    labels = np.asarray([label for _, label in labelled], dtype=float)
    model.slope, model.shift = _sigmoid(tops, labels)
    return model


def _sigmoid(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one variable, lightly regularised."""
    slope, shift = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -40, 40)))
        g = np.asarray([((p - label) * margin).sum() + 0.01 * slope, (p - label).sum()])
        s = p * (1 - p) + 1e-9
        h = np.asarray([[(s * margin * margin).sum() + 0.01, (s * margin).sum()], [(s * margin).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - float(np.clip(step[0], -2, 2)), shift - float(np.clip(step[1], -2, 2))
    return max(slope, 1e-3), shift


def sample(docs: DataFrame, labels: DataFrame, learn: Column) -> list[tuple[str, int]]:
    """A bounded sample of labelled texts.

    Of a text with more sentences than the bound of its label, those of the
    lowest hashes of (doc_id, place) are taken, from all over the text. A
    sentence of more than SENTENCE_CHARACTERS counts as several.
    """
    known = labels.where(learn & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) / float(1 << 30)
    rate = F.lit(0.0)
    for label, n in sizes.items():
        rate = F.when(F.col("toxic") == label, min(1.0, TEXTS_PER_LABEL / n)).otherwise(rate)
    # at most about TEXTS_PER_LABEL ids of each label, whatever the corpus
    drawn = F.broadcast(known.where(draw < rate))
    known = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(drawn, "doc_id")
    parts = F.regexp_extract_all("text", F.lit(rf"[^.!?\n]{{1,{SENTENCE_CHARACTERS}}}[.!?\n]*"), F.lit(0))
    marked = F.transform(parts, lambda s, at: F.struct(F.xxhash64("doc_id", at).alias("h"), at.alias("at"), s.alias("s")))
    bound = F.when(F.col("toxic") == 1, SENTENCES_PER_TOXIC_TEXT).otherwise(SENTENCES_PER_TEXT)
    drawn_parts = F.array_sort(F.transform(F.slice(F.array_sort(marked), F.lit(1), bound), lambda x: F.struct(x["at"], x["s"])))
    rows = known.select("doc_id", "toxic", F.array_join(F.transform(drawn_parts, lambda x: x["s"]), " ").alias("text")).collect()
    return [(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> ToxicityModel:
    """A model from the labelled rows where ``learn`` holds (all by default)."""
    return train(sample(docs, labels, F.lit(True) if learn is None else learn))


def score(docs: DataFrame, model: ToxicityModel, cut: float = CUT) -> DataFrame:
    """(doc_id, score, predicted) of every row, from its whole text alone.

    The score is the calibrated margin of the text's most toxic word; null, empty
    and wordless texts get that of the machine's bias. Words longer than PIECE
    are read in overlapping pieces. Without usable labels all scores are equal
    and low. Repeated rows give repeated results, an empty table none; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [s for at in range(0, len(texts), 64) for s in scorer.score(texts[at:at + 64])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64()), pa.array([int(s >= cut) for s in found], pa.int32())],
                ["doc_id", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id bigint, score double, predicted int"))

"""Toxicity by a string-kernel support vector machine with Nyström landmarks.

The kernel of two words counts the subsequences of three characters that they share; a subsequence may skip
up to ``GAPS`` characters and every skipped one costs the factor ``DECAY``. A word with inserted characters
therefore still shares most subsequences with the word as it was. A word begins with a mark of its own, so
beginnings count.

Landmarks are the beginnings and words that tell toxic training texts from others best (by the log-likelihood
ratio of the texts that hold them), each the longest that says the same. A text is described by its highest
kernel value with every landmark over all its words (divided by the landmark's kernel with itself), multiplied
with the inverse root of the landmarks' own kernel matrix (Nyström). A linear support vector machine (squared
hinge) is trained on that, and a logistic curve turns its margin into a score.

Only labels train, on a bounded sample: per label the ``sample`` labelled texts that come first by a hash of
their id. The whole text of every row is scored. Where two labels of one document differ, the higher counts.

Defined cases: null text counts as empty; an empty text has no word and gets the score of a text without any
likeness. If one of the two labels is missing in training, every score is the share of label 1. Other columns
are kept; ``score`` is replaced. A very long text is scored whole. Landmarks of equal gain
are ranked by length, longest first, then by their text; the sample of a label is the smallest hashes of ids, then the smallest ids.
An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


SAMPLE, LANDMARKS = 8_000, 64
#: Likeness below this is what any two words may have; landmarks are less alike than ``ALIKE``.
FLOOR, ALIKE = 0.5, 0.75
DECAY, GAPS = 0.6, 2
KINDS = 64  # of characters: word start, 26 letters, others by code point
START = "^"
PATTERNS = [(i, j) for i in range(1, GAPS + 2) for j in range(1, GAPS + 3 - i)]
LETTERS = re.compile(r"[^\W\d_]+")
PIECE_CHARS = 400_000


def kind_table() -> np.ndarray:
    """Character kinds below code point 1024; 0 separates words, others share the kinds that letters leave."""
    table = 28 + np.arange(1024) % (KINDS - 28)
    table[: ord("a")] = 28 + np.arange(ord("a")) % (KINDS - 28)
    table[ord("a") : ord("z") + 1] = 2 + np.arange(26)
    for c in " \t\n\x0b\x0c\r":
        table[ord(c)] = 0
    return table


TABLE = kind_table().astype(np.int32)
#: ASCII marks inside and around words are passed over: a word with dots between its letters is the same word.
MARKS = np.array([chr(i).isprintable() and not chr(i).isalnum() and i not in (32, 127) for i in range(128)])


def kinds_of(text: str) -> np.ndarray:
    """The kinds of the characters of a lower-cased text, a start mark before each word."""
    points = np.frombuffer((" " + text.lower()).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points[~MARKS[np.minimum(points, 127)]]
    kinds = TABLE[np.minimum(points, 1023)]
    far = np.flatnonzero(points >= 1024)
    kinds[far] = 28 + points[far] % (KINDS - 28)
    # A separator before a word becomes its start mark, and another separator stands before that.
    starts = np.flatnonzero((kinds[:-1] == 0) & (kinds[1:] != 0))
    out = np.insert(kinds, starts + 1, 1)
    return out.astype(np.int32)


def subsequences(kinds: np.ndarray, pattern: tuple[int, int]) -> np.ndarray:
    i, j = pattern
    n = len(kinds) - i - j
    return (kinds[:n] * KINDS + kinds[i : n + i]) * KINDS + kinds[i + j :]


def features_of(word: str) -> dict[int, float]:
    """The weights of all subsequences of one word or beginning (which begins with ``START`` or not)."""
    kinds = kinds_of(word.removeprefix(START))[1:]  # without the separator in front
    if not word.startswith(START):
        kinds = kinds[1:]
    found: Counter = Counter()
    for p in PATTERNS:
        if len(kinds) > sum(p):
            for code in subsequences(kinds, p).tolist():
                found[code] += DECAY ** (sum(p) - 2)
    return found


@dataclass
class Landmarks:
    """Landmark words and, for every subsequence that one of them has, its weights for all of them."""

    words: list[str]
    row_of: np.ndarray  # code of a subsequence -> row of weights, -1 for none
    weights: np.ndarray
    most: np.ndarray  # the highest weight of each row
    gram: np.ndarray

    @staticmethod
    def of(words: list[str]) -> Landmarks:
        features = [features_of(w) for w in words]
        codes = sorted(set().union(*features)) if features else []
        row_of = np.full(KINDS**3, -1, np.int32)
        row_of[codes] = np.arange(len(codes))
        raw = np.zeros((len(codes), len(words)))
        for k, own in enumerate(features):
            for code, w in own.items():
                raw[row_of[code], k] = w
        gram = raw.T @ raw
        weights = (raw / np.maximum(np.diag(gram), 1e-9)).astype(np.float32)
        return Landmarks(words, row_of, weights, weights.max(axis=1, initial=0), gram)

    def likeness(self, text: str) -> np.ndarray:
        """The highest kernel value of any word of the text with each landmark; below ``FLOOR`` it counts as none."""
        best = np.zeros(len(self.words), np.float32)
        for begin, end in cut(text):
            kinds = kinds_of(text[begin:end])
            word = np.cumsum(kinds == 1, dtype=np.int32)
            first, second = kinds * (KINDS * KINDS), kinds * KINDS
            hits, rows, factors = [], [], []
            for i, j in PATTERNS:
                n = len(kinds) - i - j
                if n <= 0:
                    continue
                row = self.row_of[first[:n] + second[i : n + i] + kinds[i + j :]]
                at = np.flatnonzero(row >= 0)
                at = at[word[at] == word[at + i + j]]
                hits.append(word[at])
                rows.append(row[at])
                factors.append(np.full(len(at), DECAY ** (i + j - 2), np.float32))
            if not hits:
                continue
            word, row, factor = np.concatenate(hits), np.concatenate(rows), np.concatenate(factors)
            # The sum of every hit's best weight bounds the likeness of a word with any landmark.
            bound = np.bincount(word, self.most[row] * factor)
            busy = np.flatnonzero(bound[word] >= FLOOR)
            word, row, factor = word[busy], row[busy], factor[busy]
            if not len(word):
                continue
            order = np.argsort(word, kind="stable")
            word, row, factor = word[order], row[order], factor[order]
            firsts = np.append(np.flatnonzero(np.diff(word, prepend=-1)), len(word))
            for part in range(0, len(firsts) - 1, 4096):  # whole words, so that memory is bounded and no sum is cut
                own = firsts[part : part + 4097]
                inside = slice(own[0], own[-1])
                sums = np.add.reduceat(self.weights[row[inside]] * factor[inside, None], own[:-1] - own[0], axis=0)
                np.maximum(best, sums.max(axis=0), out=best)
        return np.where(best < FLOOR, 0.0, np.minimum(best, 1.0)).astype(np.float32)


def cut(text: str) -> Iterator[tuple[int, int]]:
    """Pieces of a long text that end at white space where there is any, so no word is cut and memory is bounded."""
    begin = 0
    while begin < len(text):
        end = begin + PIECE_CHARS
        if end < len(text):
            space = max(text.rfind(" ", begin, end), text.rfind("\n", begin, end))
            end = space + 1 if space > begin else end
        yield begin, min(end, len(text))
        begin = end


def units_of(text: str) -> set[str]:
    """The words of a text and their beginnings of 4 to 7 characters."""
    found = set()
    for word in set(LETTERS.findall(text.lower())):
        if 3 <= len(word) <= 20:
            found.add(START + word + "$")
            found.update(START + word[:n] for n in range(4, 8) if len(word) > n)
    return found


def choose_landmarks(sample: DataFrame, count: int = LANDMARKS) -> list[str]:
    """Words and beginnings with the highest log-likelihood ratio that more toxic texts hold than expected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                held[toxic].update(units_of(text))
            for toxic, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(counts), pa.string()),
                        pa.array([n if toxic else 0 for n in counts.values()], pa.int64()),
                        pa.array([0 if toxic else n for n in counts.values()], pa.int64()),
                    ],
                    names=["unit", "p", "q"],
                )

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    p_all, q_all = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    if not p_all or not q_all:
        return []
    held = sample.mapInArrow(run, "unit string, p long, q long").groupBy("unit").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    both = F.col("p") + F.col("q")
    share = both / F.lit(p_all + q_all)

    def part(n, whole):
        return F.when(n > 0, n * F.log(n / (whole * share))).otherwise(0.0)

    ratio = part(F.col("p"), F.lit(p_all)) + part(F.col("q"), F.lit(q_all))
    more = F.col("p") / p_all > F.col("q") / q_all
    best = held.where(more & (F.col("p") >= 3)).select("unit", "p", "q", ratio.alias("g")).where("g > 10")
    best = best.orderBy(F.desc("g"), F.desc(F.length("unit")), "unit").limit(20 * count)
    chosen: list[str] = []
    kept: list[dict] = []
    norms: list[float] = []
    counts: list[tuple] = []
    for row in best.collect():
        word = row["unit"].removesuffix("$")
        if any(c == (row["p"], row["q"]) and longer.startswith(word) for longer, c in zip(chosen, counts, strict=True)):
            continue  # a longer one tells the same texts
        own = features_of(word)
        norm = sum(w * w for w in own.values()) ** 0.5
        alike = (sum(w * k.get(c, 0.0) for c, w in own.items()) / (norm * n or 1) for k, n in zip(kept, norms, strict=True))
        if norm and all(a < ALIKE for a in alike):
            chosen.append(word)
            counts.append((row["p"], row["q"]))
            kept.append(own)
            norms.append(norm)
        if len(chosen) == count:
            break
    return chosen


@dataclass
class Model:
    landmarks: Landmarks
    root: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def score(self, text: str) -> float:
        margin = 0.0
        if len(self.weights):
            own = self.landmarks.likeness(text) @ self.root
            margin = float(np.append(own, 1.0) @ self.weights)
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -60, 60))))


def support_vectors(x: np.ndarray, y: np.ndarray, cost: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights (the last is the constant) that minimise squared hinge losses, both classes weighing the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y == 1, 1.0, -1.0)
    weigh = cost * np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton steps on the points inside the margin
        inside = sign * (x @ w) < 1
        xs, c = x[inside], weigh[inside]
        new = np.linalg.solve(ridge + (xs.T * c) @ xs, xs.T @ (c * sign[inside]))
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of the curve from margins to the share of label 1, with softened targets."""
    p, n = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (p + 1) / (p + 2), 1 / (n + 2))
    z = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (q * (1 - q))) @ z + 1e-6 * np.eye(2), z.T @ (target - q))
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, count: int = LANDMARKS) -> Model:
    """``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic`` (others than 0 and 1 are passed over)."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    first = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    picked = first[0].unionByName(first[1])  # at most twice the sample: ids and labels only
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id").select("text", "toxic")
    landmarks = Landmarks.of(choose_landmarks(chosen, count))
    sent = docs.sparkSession.sparkContext.broadcast(landmarks)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.likeness(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.float32()))], names=["toxic", "x"])

    rows = chosen.mapInArrow(describe, "toxic int, x array<float>").toArrow()
    y = rows.column("toxic").to_numpy() if rows.num_rows else np.empty(0, int)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not landmarks.words or y.min(initial=1) == y.max(initial=0):
        return Model(landmarks, np.empty((0, 0)), np.empty(0), 0.0, float(np.log(share / (1 - share))))
    x = np.stack(rows.column("x").to_pylist())
    scale = np.sqrt(np.diag(landmarks.gram))
    values, vectors = np.linalg.eigh(landmarks.gram / np.outer(scale, scale))
    root = (vectors / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    order = np.lexsort([*x.T, y])  # sums do not depend on the order in which rows came
    x, y = (x @ root)[order], y[order]
    weights = support_vectors(x, y)
    slope, offset = logistic(np.hstack([x, np.ones((len(x), 1))]) @ weights, y)
    return Model(landmarks, root, weights, slope, offset)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with ``score``, from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != "score"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.float64())], names=[*names, "score"])

    return docs.select(*names).mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))

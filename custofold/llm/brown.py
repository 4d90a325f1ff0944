"""Scoring texts with a class-based bigram model (Brown classes by exchange).

Words are lower-cased A-Z and split at ASCII white space; every text ends with an end token. The most frequent
``vocabulary`` words are moved between ``classes`` classes by the exchange algorithm: in every round each word
goes to the class that gives the highest likelihood of the class bigrams, the counts of all others held fixed.
A round is one Spark job over the stored word bigrams; only the class of each vocabulary word (a bounded table)
passes the driver. A round moves every ``PARTS``-th word, as words that move at once do not see each other. Rounds end when
as many as there are parts raise the likelihood by less than ``TOLERANCE`` a token; the classes of the highest likelihood count.

The numbers of the training tokens are stored once, and bigrams, places and class bigrams are counted from them.

Every other word of the ``local`` most frequent ones that training saw at least ``evidence`` times is then
placed into the best of the same classes, by the same likelihood, from the classes that stand beside it in all
training texts. Words seen less often, or not at all, are in ``rare`` further classes by a hash of their last two
bytes: so words of one occurrence stand for those that training never saw, and every word has a class. The end
token is a class of its own. Class bigrams are counted anew under the final classes.

Counts cover every training token: word counts (emission), and class bigrams (transition). The probability of a
token is ``mix`` times transition times emission plus (1 - ``mix``) times the unigram probability, both smoothed
by adding a half, so that every text has a finite score:

    P(w | c') = (n(w) + 0.5) * (mix * T(c' -> c) / (n(c) + 0.5 * (v(c) + 1)) + (1 - mix) / (N + 0.5 * (V + 1)))

The bracket depends on classes alone and is summed in the map task that reads the text. The counts of the
``local`` most frequent words (a bounded table) are looked up there; all other words are joined with the table of
word counts, which shuffles only their share of the tokens.

Defined cases: null text counts as empty, which is one end token. Rows that share ``doc_id`` and text share
one score and are all returned. A missing id is the empty text for the fold. Other columns are left behind. With no training
rows every token has probability one half over one half, as the formula says. Words of equal count are ranked by
their text, classes of equal gain by their number. A very long text is one row, scored whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custofold.llm.common import documents_of, mix, stored, trimmed, words_of

VOCABULARY, LOCAL, CLASSES, RARE, ROUNDS = 4096, 200_000, 64, 16, 16
PARTS, EVIDENCE, TOLERANCE = 4, 2, 0.001
MIX = 0.7
END = b"\n"  # no word contains white space, so the end token cannot be a word
MERGE_AT = 400_000


@dataclass
class Words:
    """The most frequent words by number; the first ``movable`` take part in the exchange."""

    number: dict[bytes, int]
    movable: int
    class_of: np.ndarray  # of all of them
    classes: int
    rare: int

    @property
    def all_classes(self) -> int:
        return self.classes + self.rare + 1  # the last is the end token, and what stands before a text

    def class_of_word(self, word: bytes) -> int:
        k = self.number.get(word)
        return int(self.class_of[k]) if k is not None else self.classes + ending(word, self.rare)

    def place_of_word(self, word: bytes) -> int:
        """A number for scoring: the word's own, or one above all for the words of each rare class."""
        k = self.number.get(word)
        return k if k is not None else len(self.number) + ending(word, self.rare)

    def classes_of_places(self) -> np.ndarray:
        """The class of every number that ``place_of_word`` gives."""
        return np.concatenate([self.class_of, self.classes + np.arange(self.rare)]).astype(np.int64)


class Numbers(dict):
    """The numbers of words, each found once as long as the memo is not full; the end token has ``end``."""

    def __init__(self, find, end: int):
        super().__init__()
        self.find, self.end = find, end

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.end if word == END else self.find(word)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 1_000_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def runs_of(column: pa.Array, size: int = 100_000) -> Iterator[list[bytes]]:
    """The tokens of many texts one after the other: an end, then the words and the end of each text.

    An end stands before every text, so the bigrams of a run are those of its texts.
    """
    run = [END]
    for words in words_of(column):
        run.extend(words)
        run.append(END)
        if len(run) > size:
            yield run
            run = [END]
    if len(run) > 1:
        yield run


@lru_cache(maxsize=8)
def ending_classes(rare: int) -> list[int]:
    """The rare class of every pair of last bytes."""
    return (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(rare)).tolist()


def ending(word: bytes, rare: int) -> int:
    return ending_classes(rare)[int.from_bytes(word[-2:], "big")]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (binary) and ``n`` over all tokens, ends included; tasks count before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            counts[END] += batch.num_rows
            for words in words_of(batch.column("text")):
                counts.update(words)
            if len(counts) > MERGE_AT:
                yield rows()
                counts.clear()
        yield rows()

    rows = documents_of(docs).select("text").mapInArrow(run, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def numbered(docs: DataFrame, words: Words) -> DataFrame:
    """The numbers for scoring of all tokens, 32 bits each, packed as ``run``: an end, then the tokens and the end of each text.

    Stored, as three steps of the training read them; which number a word has stays the same while classes change.
    """
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        memo = Numbers(own.place_of_word, end_place(own))
        for batch in batches:
            for tokens in runs_of(batch.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array([memo.of(tokens).astype("<i4").tobytes()], pa.binary())], names=["run"])

    return stored(documents_of(docs).select("text").mapInArrow(trimmed(run), "run binary"))


def end_place(words: Words) -> int:
    """The number of the end token for scoring, above those of all words."""
    return len(words.number) + words.rare


def places_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for run in batch.column("run"):
            yield np.frombuffer(run.as_buffer(), "<i4").astype(np.int64)


def vocabulary_bigrams(runs: DataFrame, words: Words) -> DataFrame:
    """Counts ``n`` of bigrams of numbers, as ``code`` = first * ``bigram_width`` + second."""
    width = bigram_width(words)
    # Words beyond the exchange have the number of their rare class, which is their class before they are placed.
    number_at = np.concatenate([words.classes_of_places() - words.classes + words.movable, [width - 1]])
    number_at[: words.movable] = np.arange(words.movable)
    sent = runs.sparkSession.sparkContext.broadcast(number_at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], names=["code", "n"])

        for places in places_of(batches):
            ids = sent.value[places]
            held.append(ids[:-1] * width + ids[1:])
            size += len(ids)
            if size > 8_000_000:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    return runs.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def bigram_width(words: Words) -> int:
    return words.movable + words.rare + 1


def exchange_round(
    bigrams: DataFrame, classes: np.ndarray, movable: int, free: int, part: int
) -> tuple[np.ndarray, float]:
    """New classes of the numbers, when one part of the movable words goes to the best of the ``free`` classes.

    Beside them the likelihood of the old ones.
    """
    spark = bigrams.sparkSession
    sent = spark.sparkContext.broadcast(classes)
    numbers, width = len(classes), int(classes.max()) + 1

    def to_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of each number with the class after it (side 0) and before it (side 1)."""
        own = sent.value
        sums = np.zeros(numbers * 2 * width)
        for batch in batches:
            code, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            a, b = code // numbers, code % numbers
            np.add.at(sums, (a * 2) * width + own[b], n)
            np.add.at(sums, (b * 2 + 1) * width + own[a], n)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some // (2 * width)),
                pa.array(some // width % 2),
                pa.array(some % width),
                pa.array(sums[some].astype(np.int64)),
            ],
            names=["word", "side", "class", "n"],
        )

    near = stored(
        bigrams.mapInArrow(to_classes, "word long, side long, class long, n long")
        .groupBy("word", "side", "class")
        .agg(F.sum("n").alias("n"))
    )
    follow = near.where("side = 0").mapInArrow(_class_of(sent), "a long, b long, n long")
    matrix = np.zeros((width, width))
    for r in follow.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():  # classes squared rows at most
        matrix[r["a"], r["b"]] = r["n"]
    state = spark.sparkContext.broadcast((classes, matrix, free))
    moved = (
        near.where((F.col("word") < movable) & (F.col("word") % PARTS == part))
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_best_classes(state), "word long, class long")
    )
    out = classes.copy()
    for r in moved.collect():  # a row per movable word at most
        out[r["word"]] = r["class"]
    return out, likelihood(matrix)


def exchanged(bigrams: DataFrame, classes: np.ndarray, movable: int, free: int, rounds: int, tokens: int) -> np.ndarray:
    """The classes of the highest likelihood in at most ``rounds`` rounds, or until it has stopped to rise."""
    reached: list[float] = []
    best = classes
    for step in range(rounds if tokens else 0):
        new, now = exchange_round(bigrams, classes, movable, free, step % PARTS)
        if not reached or now > max(reached):
            best = classes
        if len(reached) >= PARTS and now - max(reached[:-PARTS + 1]) < TOLERANCE * tokens:
            break
        reached.append(now)
        classes = new
    return best


def likelihood(matrix: np.ndarray) -> float:
    """Log likelihood of class bigrams, but for a part that does not depend on the classes."""
    return float(xlogx(matrix).sum() - xlogx(matrix.sum(axis=1)).sum() - xlogx(matrix.sum(axis=0)).sum())


def _class_of(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            word, _, after, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            yield pa.RecordBatch.from_arrays([pa.array(own[word]), pa.array(after), pa.array(n)], names=["a", "b", "n"])

    return run


def _best_classes(sent, best_of=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, matrix, free = sent.value
        parts = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(4)] for b in batches if b.num_rows]
        if not parts:
            return
        word, side, other, n = (np.concatenate(p) for p in zip(*parts, strict=True))
        words, at = np.unique(word, return_inverse=True)
        best = np.empty(len(words), np.int64)
        ends = np.searchsorted(at, np.arange(len(words) + 1))
        for k, w in enumerate(words):
            rows = slice(ends[k], ends[k + 1])
            best[k] = (best_of or best_class)(classes[w], side[rows], other[rows], n[rows], matrix, free)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(best)], names=["word", "class"])

    return run


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300)) * (x > 0)


def best_class(own: int, side: np.ndarray, other: np.ndarray, n: np.ndarray, matrix: np.ndarray, free: int) -> int:
    """The class to which a word moves: highest sum of n log n over class bigrams less that over classes."""
    width = len(matrix)
    after, before = np.zeros(width), np.zeros(width)
    after[other[side == 0]] = n[side == 0]
    before[other[side == 1]] = n[side == 1]
    rest = matrix.copy()
    rest[own] -= after
    rest[:, own] -= before
    np.maximum(rest, 0, out=rest)
    sums_after, sums_before = rest.sum(axis=1), rest.sum(axis=0)
    gain = (xlogx(rest[:free] + after) - xlogx(rest[:free])).sum(axis=1)
    gain += (xlogx(rest[:, :free] + before[:, None]) - xlogx(rest[:, :free])).sum(axis=0)
    gain -= xlogx(sums_after[:free] + after.sum()) - xlogx(sums_after[:free])
    gain -= xlogx(sums_before[:free] + before.sum()) - xlogx(sums_before[:free])
    return int(gain.argmax())


def best_place(own: int, side: np.ndarray, other: np.ndarray, n: np.ndarray, matrix: np.ndarray, free: int) -> int:
    """What ``best_class`` gives for a word of a class that is not free, from the classes beside it alone."""
    width = len(matrix)
    after, before = np.zeros(width), np.zeros(width)
    after[other[side == 0]] = n[side == 0]
    before[other[side == 1]] = n[side == 1]
    rest_after, rest_before = matrix[:free, after > 0], matrix[before > 0, :free]
    if after[own]:
        rest_after[:, int((after[:own] > 0).sum())] -= before[:free]
    if before[own]:
        rest_before[int((before[:own] > 0).sum())] -= after[:free]
    np.maximum(rest_after, 0, out=rest_after)
    np.maximum(rest_before, 0, out=rest_before)
    gain = (xlogx(rest_after + after[after > 0]) - xlogx(rest_after)).sum(axis=1)
    gain += (xlogx(rest_before + before[before > 0][:, None]) - xlogx(rest_before)).sum(axis=0)
    for total, less, more in (
        (matrix[:free].sum(axis=1), before, after),
        (matrix[:, :free].sum(axis=0), after, before),
    ):
        total = np.maximum(total - less[:free], 0)
        gain -= xlogx(total + more.sum()) - xlogx(total)
    return int(gain.argmax())


def placed(runs: DataFrame, words: Words, matrix: np.ndarray, limit: int) -> np.ndarray:
    """The classes of the numbers, when those from ``movable`` up to ``limit`` go to the best of the free classes."""
    spark = runs.sparkSession
    out = words.class_of.copy()
    if limit <= words.movable:
        return out
    width, movable = words.all_classes, words.movable
    sent = spark.sparkContext.broadcast(np.append(words.classes_of_places(), width - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_at = sent.value
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], names=["code", "n"])

        for places in places_of(batches):
            seq = class_at[places]
            at = np.flatnonzero((places >= movable) & (places < limit))  # never an end
            word = places[at] * (2 * width)
            held += [word + seq[at + 1], word + width + seq[at - 1]]
            size += 2 * len(at)
            if size > 4_000_000:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    near = runs.mapInArrow(trimmed(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    word, rest = F.expr(f"code div {2 * width}"), F.col("code") % (2 * width)
    state = spark.sparkContext.broadcast((words.class_of, matrix, words.classes))
    moved = (
        near.select(word.alias("word"), F.expr(f"(code % {2 * width}) div {width}").alias("side"), (rest % width).alias("class"), "n")
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_best_classes(state, best_place), "word long, class long")
    )
    for r in moved.toArrow().to_batches():  # a row per number at most
        out[r.column("word").to_numpy()] = r.column("class").to_numpy()
    return out


def class_bigrams(runs: DataFrame, words: Words) -> np.ndarray:
    """Counts of class bigrams over all texts, by class before and class."""
    width = words.all_classes
    sent = runs.sparkSession.sparkContext.broadcast(np.append(words.classes_of_places(), width - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width * width, np.int64)
        for places in places_of(batches):
            seq = sent.value[places]
            sums += np.bincount(seq[:-1] * width + seq[1:], minlength=width * width)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["code", "n"])

    rows = runs.mapInArrow(trimmed(run), "code long, n long")
    matrix = np.zeros((width, width))
    for r in rows.groupBy("code").agg(F.sum("n").alias("n")).collect():  # classes squared rows at most
        matrix[r["code"] // width, r["code"] % width] = r["n"]
    return matrix


@dataclass
class Model:
    """What a task needs to score a text, but for the counts of words outside the vocabulary."""

    words: Words
    counts: np.ndarray  # of the vocabulary words
    ends: int
    bracket: np.ndarray  # log10 of the class part, by class before and class
    base: float  # log10(N + 0.5 * (V + 1))


def train(
    docs: DataFrame,
    vocabulary: int = VOCABULARY,
    local: int = LOCAL,
    classes: int = CLASSES,
    rare: int = RARE,
    rounds: int = ROUNDS,
    evidence: int = EVIDENCE,
) -> tuple[Model, DataFrame, int]:
    """The model, the table of all word counts, and the number of training tokens."""
    counts = stored(word_counts(docs))
    tokens, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    is_end = F.col("word") == F.lit(END)
    end = counts.where(is_end).first()
    ends = end["n"] if end else 0
    top = counts.where(~is_end).orderBy(F.desc("n"), "word").limit(local).toArrow()
    number = {w: i for i, w in enumerate(top.column("word").to_pylist())}
    top_counts = top.column("n").to_numpy().astype(np.float64)
    movable = min(vocabulary, len(number))
    start = np.arange(movable) % classes
    others = [classes + ending(w, rare) for w in list(number)[movable:]]
    words = Words(number, movable, np.concatenate([start, others]).astype(np.int64), classes, rare)

    width = words.all_classes
    runs = numbered(docs, words)
    bigrams = stored(vocabulary_bigrams(runs, words))
    every = np.concatenate([start, classes + np.arange(rare), [width - 1]]).astype(np.int64)
    every = exchanged(bigrams, every, movable, classes, rounds, tokens)
    words.class_of[:movable] = every[:movable]
    words = Words(number, movable, placed(runs, words, class_matrix(bigrams, every), int((top_counts >= evidence).sum())), classes, rare)
    matrix = class_bigrams(runs, words)

    # Kinds and tokens of every class: of numbered words from their table, of all others from all word counts.
    kinds_of, tokens_of = np.zeros((2, width))
    np.add.at(kinds_of, words.class_of, 1)
    np.add.at(tokens_of, words.class_of, top_counts)
    kinds_of[-1], tokens_of[-1] = 1, ends
    for r in rare_classes(counts, words).collect():  # a row per rare class
        kinds_of[r["class"]] += r["kinds"]
        tokens_of[r["class"]] += r["n"]
    move = (matrix + 0.5) / (matrix.sum(axis=1, keepdims=True) + 0.5 * width)
    base = tokens + 0.5 * (kinds + 1)
    bracket = MIX * move / (tokens_of + 0.5 * (kinds_of + 1)) + (1 - MIX) / base
    return Model(words, top_counts, ends, np.log10(bracket), float(np.log10(base))), counts, tokens


def class_matrix(bigrams: DataFrame, every: np.ndarray) -> np.ndarray:
    """Counts of class bigrams from those of numbers, whose classes are given."""
    numbers, width = len(every), int(every[-1]) + 1
    sent = bigrams.sparkSession.sparkContext.broadcast(every)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width * width)
        for batch in batches:
            code, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            np.add.at(sums, sent.value[code // numbers] * width + sent.value[code % numbers], n)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some].astype(np.int64))], names=["code", "n"])

    rows = bigrams.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    matrix = np.zeros((width, width))
    for r in rows.collect():  # classes squared rows at most
        matrix[r["code"] // width, r["code"] % width] = r["n"]
    return matrix


def rare_classes(counts: DataFrame, words: Words) -> DataFrame:
    """Kinds and tokens that each rare class has of words without a number."""
    sent = counts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found, kinds, tokens = [], np.zeros(own.rare, np.int64), np.zeros(own.rare, np.int64)
            for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if w != END and w not in own.number:
                    k = ending(w, own.rare)
                    kinds[k] += 1
                    tokens[k] += n
            found = own.classes + np.arange(own.rare)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(kinds), pa.array(tokens)], names=["class", "kinds", "n"])

    rows = counts.mapInArrow(run, "class long, kinds long, n long")
    return rows.groupBy("class").agg(F.sum("kinds").alias("kinds"), F.sum("n").alias("n"))


def score(docs: DataFrame, model: Model, counts: DataFrame, tokens: int, held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = documents_of(docs).select("doc_id", held_out.alias("held_out"), "text", F.xxhash64("text").alias("print"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        local = len(m.counts)
        class_at = np.append(m.words.classes_of_places(), m.words.all_classes - 1)
        end = len(class_at) - 1
        memo = Numbers(m.words.place_of_word, end)
        log_at, known_at = np.zeros(end + 1), np.zeros(end + 1, np.int64)
        log_at[:local], log_at[end] = np.log10(m.counts + 0.5), np.log10(m.ends + 0.5)
        known_at[:local], known_at[end] = 1, m.ends > 0
        for batch in batches:
            n_tokens, n_known, class_sum, logs = [], [], [], []
            at, rare_words, rare_counts = [], [], []
            for tokens in runs_of(batch.column("text")):
                places = memo.of(tokens)
                seq = class_at[places]
                ends = np.flatnonzero(places == end)
                begins = ends[:-1]  # of the bigrams of each text, and of its tokens behind the first end
                class_sum.extend(np.add.reduceat(m.bracket[seq[:-1], seq[1:]], begins).tolist())
                logs.extend(np.add.reduceat(log_at[places[1:]], begins).tolist())
                n_known.extend(np.add.reduceat(known_at[places[1:]], begins).tolist())
                far = np.flatnonzero((places >= local) & (places < end))
                far_words = [tokens[i] for i in far.tolist()]
                cuts = np.searchsorted(far, ends).tolist()
                for row, (x, y) in enumerate(pairwise(cuts), len(n_tokens)):
                    if x < y:
                        found = Counter(far_words[x:y])
                        rare_words.extend(found)
                        rare_counts.extend(found.values())
                        at.extend([row] * len(found))
                n_tokens.extend(np.diff(ends).tolist())
            rows = batch.num_rows
            prints = batch.column("print").to_pylist()
            pick = pa.array([*range(rows), *at], pa.int32())
            none = [None] * len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pick),
                    batch.column("print").take(pick),
                    batch.column("held_out").take(pick),
                    pa.array([*n_tokens, *none], pa.int64()),
                    pa.array([*n_known, *none], pa.int64()),
                    pa.array([*class_sum, *none], pa.float64()),
                    pa.array([*logs, *none], pa.float64()),
                    pa.array([*(b" %d" % x for x in prints), *rare_words], pa.binary()),
                    pa.array([*([None] * rows), *rare_counts], pa.int64()),
                ],
                names=["doc_id", "print", "held_out", "n_tokens", "n_known", "classes", "logs", "word", "times"],
            )

    fields = "held_out boolean, n_tokens long, n_known long, classes double, logs double, word binary, times long"
    parts = own.mapInArrow(run, f"doc_id {kind}, print long, {fields}")
    # The row of a text has no word but a blank and its print, which meets no count and is dealt out evenly;
    # a rare word that training never saw counts 0.
    looked = parts.join(counts.withColumnRenamed("n", "count"), "word", "left")
    seen = F.coalesce("count", F.lit(0))
    rare = F.col("times").isNotNull()
    summed = looked.groupBy("doc_id", "print").agg(
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.max("n_known").alias("known"),
        F.max("classes").alias("classes"),
        F.max("logs").alias("logs"),
        F.sum(F.when(~rare, 1)).alias("copies"),
        F.sum(F.when(rare & (seen > 0), F.col("times"))).alias("more_known"),
        F.sum(F.when(rare, F.col("times") * F.log10(seen + 0.5))).alias("more_logs"),
    )
    copies = F.col("copies")
    logs = F.col("logs") + F.coalesce(F.col("more_logs") / copies, F.lit(0.0))
    known = F.col("known") + F.coalesce(F.col("more_known") / copies, F.lit(0.0))
    return summed.select(
        "doc_id",
        "held_out",
        "n_tokens",
        known.cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(model.base)).alias("base_score"),
        (logs + F.col("classes")).alias("score"),
        F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("__copy"),
    ).drop("__copy")


def score_documents(docs: DataFrame, training: Column, held_out: Column, **options) -> DataFrame:
    """Learns from the rows where ``training`` holds and scores all."""
    model, counts, tokens = train(docs.where(training), **options)
    return score(docs, model, counts, tokens, held_out)

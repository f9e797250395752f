"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

The kernel of two words counts their common subsequences of four characters, gaps allowed up to a
span, each character skipped costing a factor; word ends count as characters. Inserted and changed
characters thus leave most of the similarity. Each word is scaled by the weight of its own
subsequences, which depends on its length only.

A character between all letters leaves nothing of the similarity, and no wider span would: the
skipped characters cost too much. Separated words ('i.d.i.o.t', 'i--d-iot', 'ixdxixoxt') therefore
also count as their readings: without all that are not letters, and without one character that
stands in every second place. Different letters put between all letters are not seen through.

Nyström landmarks (words) turn the kernel into few features, a linear machine is trained on them,
and because the machine is a sum over landmarks, it folds into one weight per subsequence. Scoring
a text is then a lookup for each gap pattern; a document scores as its worst word, on a calibrated
scale. A document's score depends on its text only, not on the texts beside it.

Bounds of the fit, all parameters above: sampled documents of each label, and how many of their
words may become landmarks or negatives. Scoring has none.

Labels are given for documents. The machine learns from their sentences by multiple-instance
rounds: in each toxic document the word with the highest score stands for its toxic sentence, all
words of clean documents are clean, and words of clean documents that score high are added.

Nulls: a null text is scored like an empty one, by the score of a text without evidence; labels
with a null id or mark are not used; of contradicting marks the toxic one counts, and of rows that
repeat a doc_id one is learned from. Without labels of both kinds every document gets the share of
toxic labels (0 without any).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTH = 4
SPAN = 5
DECAY = 0.6
N_LANDMARKS = 240
MAX_TRAIN_DOCS = 3_000  # of each label, a bounded sample in hash order, whole documents
LANDMARK_POOL = 12  # words that may become landmarks, for each landmark
COMMON_NEGATIVES = 4_000  # clean words learned from: the most frequent ones,
SPREAD_NEGATIVES = 8_000  # about so many more at even distances in the order of frequency,
HARD_NEGATIVES = 2_000  # and in each round those that score highest
COST = 0.02
ROUNDS = 4
CUT = 0.7
_SLOPE = 4.0  # of the logistic scale, per unit of margin
_EVIDENCE = 1.0  # least log ratio of toxic to clean documents that hold a word
_SURE = 2.7  # the same for further words of a document, which also must be frequent
_WITNESSES = 3
_SYMBOLS = 48
_BETWEEN = "\n\n"
_CHUNK = 1_000  # words of a vocabulary that are compared at once
_BATCH_CHARS = 1 << 18
_PUNCTUATION = ".,;:!?\"'()[]{}«»“”„’¡¿…-–—"
# Letters a-z have symbols 1 to 26, all other characters share 27 to 47; 0 is the end of a word.
_CLASS = np.array([27 + c % 21 for c in range(0x3000)], np.uint8)
_CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
_LEAST_READING = 2  # letters; a shorter word has no subsequence
_LEAST_REGULAR = 7  # characters of a word whose every second one may be an insertion
_SPACE_CODES = np.array([9, 10, 11, 12, 13, 32])
_PUNCTUATION_CODES = np.array(sorted(map(ord, _PUNCTUATION)))
_GAPS = [g for g in product(range(1, SPAN), repeat=LENGTH - 1) if sum(g) < SPAN]


def is_training(doc_id: str = "doc_id") -> Column:
    """Rows whose labels may be learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1


@dataclass
class Words:
    """Words of some texts as symbols, each with its ends: begin at ``first``, ``size`` symbols."""

    symbols: np.ndarray
    first: np.ndarray
    size: np.ndarray
    place: np.ndarray  # of the first character in the joined texts
    letter: np.ndarray  # is the symbol that of a letter


def to_words(text: str, spelled: bool = True) -> Words:
    """Words of a text; ``spelled`` joins runs of single characters to one word."""
    codes = np.frombuffer(("\n" + text.lower() + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    end = np.isin(codes, _SPACE_CODES)
    mark = np.isin(codes, _PUNCTUATION_CODES)
    # A run of punctuation that touches white space ends a word; other punctuation is part of it.
    soft = end | mark
    begins = np.flatnonzero(soft & ~np.append(False, soft[:-1]))
    spaces = np.append(0, np.cumsum(end))
    run = np.cumsum(soft & ~np.append(False, soft[:-1])) - 1
    until = np.flatnonzero(soft & ~np.append(soft[1:], False)) + 1
    end = soft & (spaces[until] > spaces[begins])[run]
    symbols = np.where(codes < len(_CLASS), _CLASS[np.minimum(codes, len(_CLASS) - 1)], 27 + codes % 21)
    symbols = np.where(end, 0, symbols).astype(np.int32)
    # Spelled-out letters are one word: drop the end between two words of one character.
    ends = np.flatnonzero(end)
    sizes = np.diff(ends) - 1
    single = np.flatnonzero((sizes[1:] == 1) & (sizes[:-1] == 1) & spelled) + 1
    keep = np.ones(len(codes), bool)
    keep[ends[single]] = False
    kept = np.flatnonzero(keep)
    symbols = symbols[kept]
    ends = np.flatnonzero(symbols == 0)
    sizes = np.diff(ends) - 1
    real = sizes > 0
    letter = _LETTER[codes[kept]] & (symbols != 0)
    return Words(symbols, ends[:-1][real], sizes[real] + 2, kept[ends[:-1][real]], letter)


def _part(words: Words, keep: np.ndarray, chosen: np.ndarray) -> Words:
    """The chosen words, reduced to the symbols to keep."""
    running = np.append(0, np.cumsum(keep))
    first, size = words.first[chosen], words.size[chosen]
    left = running[first + size] - running[first]
    mark = np.zeros(len(keep) + 1, np.int32)
    mark[first + 1] += 1
    mark[first + size - 1] -= 1
    keep = keep & (np.cumsum(mark[:-1]) > 0)
    begins = np.append(0, np.cumsum(left + 1))
    inner = np.ones(begins[-1] + 1, bool)
    inner[begins] = False
    symbols, letter = np.zeros(len(inner), np.int32), np.zeros(len(inner), bool)
    symbols[inner], letter[inner] = words.symbols[keep], words.letter[keep]
    return Words(symbols, begins[:-1], left + 2, words.place[chosen], letter)


def readings(words: Words) -> list[Words]:
    """Separated words without all that are not letters, and without a regular insertion."""
    if not len(words.first):
        return []
    s = words.symbols
    running = np.append(0, np.cumsum(words.letter))
    letters = running[words.first + words.size] - running[words.first]
    mixed = (letters < words.size - 2) & (letters >= _LEAST_READING)
    # Equal symbols two places apart, summed up over places of the same parity.
    equal = np.zeros(len(s) + len(s) % 2, np.int64)
    equal[: len(s) - 2] = s[2:] == s[:-2]
    equal = equal.reshape(-1, 2).cumsum(axis=0).ravel()
    inner = words.size - 2
    regular = np.flatnonzero((inner >= _LEAST_REGULAR) & (inner % 2 == 1))
    first, inner = words.first[regular], inner[regular]
    regular = regular[equal[first + inner - 3] - equal[first] == (inner - 3) // 2]
    other = np.zeros(len(s) + 2, bool)
    for place, size in zip(words.first[regular].tolist(), words.size[regular].tolist()):
        other[place + 1 : place + size - 1 : 2] = True
    found = [_part(words, words.letter, np.flatnonzero(mixed)), _part(words, other[: len(s)], regular)]
    return [part for part in found if len(part.first)]


def subsequences(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each gap pattern: first places, subsequence numbers and the weight of the pattern."""
    s = words.symbols
    inner = np.cumsum(s == 0)
    for gaps in _GAPS:
        reach = sum(gaps)
        n = len(s) - reach
        if n <= 0:
            continue
        number, at = s[:n].copy(), 0
        for gap in gaps:
            at += gap
            number *= _SYMBOLS
            number += s[at : at + n]
        inside = inner[reach - 1 : reach - 1 + n] == inner[:n]  # no word end strictly between
        yield inside, number, DECAY ** (reach - LENGTH + 1)


def own_weight(size: np.ndarray) -> np.ndarray:
    """Sum of squared weights of the subsequences of a word, by its number of symbols."""
    total = np.zeros(len(size))
    for gaps in _GAPS:
        reach = sum(gaps)
        total += np.maximum(size - reach, 0) * DECAY ** (2 * (reach - LENGTH + 1))
    return np.maximum(total, 1e-9)


def word_sums(words: Words, weights: np.ndarray) -> np.ndarray:
    """For each word the scaled sum of the weights of its subsequences."""
    if not len(words.first):
        return np.zeros(0)
    sums = np.zeros(len(words.symbols), np.float32)
    for inside, number, weight in subsequences(words):
        sums[: len(number)] += np.where(inside, weights[number] * np.float32(weight), 0)
    # A word's subsequences begin at its first symbol up to the one before its last. Each word is
    # summed by itself, so that nothing around it changes its last bits.
    bounds = np.stack([words.first, words.first + words.size - 1], axis=1).ravel()
    total = np.add.reduceat(sums.astype(np.float64), bounds)[::2]
    return total / np.sqrt(own_weight(words.size))


@dataclass
class Landmarks:
    """Landmark words: their subsequences, and the scaled weight of each in each word."""

    numbers: np.ndarray
    weights: np.ndarray  # one row per subsequence, one column per word


def landmarks_of(words: list[str]) -> Landmarks:
    entries = []
    for j, word in enumerate(words):
        one = to_words(word)
        scale = 1 / np.sqrt(own_weight(one.size)[0]) if len(one.size) else 0.0
        for inside, number, weight in subsequences(one):
            entries += [(n, j, weight * scale) for n in number[inside].tolist()]
    numbers, rows = np.unique(np.array([e[0] for e in entries], np.int64), return_inverse=True)
    weights = np.zeros((len(numbers), len(words)))
    np.add.at(weights, (rows, [e[1] for e in entries]), [e[2] for e in entries])
    return Landmarks(numbers, weights)


def kernel(words: list[str], landmarks: Landmarks) -> np.ndarray:
    """Kernel of words with landmarks."""
    known = np.zeros(_SYMBOLS**LENGTH, bool)
    known[landmarks.numbers] = True
    out = np.zeros((len(words), landmarks.weights.shape[1]))
    for begin in range(0, len(words), _CHUNK):
        chunk = to_words("\n".join(words[begin : begin + _CHUNK]), spelled=False)
        owner = np.zeros(len(chunk.symbols), np.int64)
        owner[chunk.first] = 1
        owner = np.cumsum(owner) - 1
        part = np.zeros((len(words[begin : begin + _CHUNK]), len(landmarks.numbers)), np.float32)
        for inside, number, weight in subsequences(chunk):
            hit = np.flatnonzero(inside & known[number])
            np.add.at(part, (owner[hit], np.searchsorted(landmarks.numbers, number[hit])), weight)
        part[: len(chunk.size)] /= np.sqrt(own_weight(chunk.size))[:, None]
        out[begin : begin + len(part)] = part @ landmarks.weights
    return out


def train_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton's method; the last weight is the offset."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.ones(x.shape[1])
    ridge[-1] = 1e-3
    for _ in range(steps):
        slack = 1 - y * (x @ w)
        on = slack > 0
        gradient = ridge * w - 2 * (x[on].T @ (cost[on] * y[on] * slack[on]))
        hessian = np.diag(ridge) + 2 * (x[on].T * cost[on]) @ x[on]
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _calibrated(values: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic scale of raw scores on which the cut with the best F1 of the sample scores ``CUT``.

    The cut stands midway between the raw scores on its sides. A fit to all scores would follow
    the many easy documents and the few mislabelled ones, not the border.
    """
    order = np.argsort(-values, kind="stable")
    ranked, hits = values[order], np.cumsum(np.where(toxic, weight, 0.0)[order])
    named = np.cumsum(weight[order])
    f1 = 2 * hits / (named + weight[toxic].sum())
    last = np.append(ranked[1:] < ranked[:-1], True)  # equal scores are cut together
    best = int(np.argmax(np.where(last, f1, -1.0)))
    border = (ranked[best] + ranked[min(best + 1, len(ranked) - 1)]) / 2
    return _SLOPE, float(np.log(CUT / (1 - CUT)) - _SLOPE * border)


@dataclass
class Model:
    weights: np.ndarray | None
    offset: float
    slope: float
    shift: float
    floor: float  # raw score of a text without words

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Scores of documents from 0 to 1."""
        raw = np.full(len(texts), self.floor)
        if self.weights is not None:
            self._raw(texts, raw)
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))

    def _raw(self, texts: list[str | None], raw: np.ndarray) -> None:
        batch: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if size and size + len(text or "") > _BATCH_CHARS:
                self._score(texts, batch, raw)
                batch, size = [], 0
            batch.append(i)
            size += len(text or "")
        if batch:
            self._score(texts, batch, raw)

    def _score(self, texts, batch: list[int], raw: np.ndarray) -> None:
        parts = [(texts[i] or "").lower() for i in batch]
        # Two ends between texts: single letters on both sides are no spelled-out word.
        words = to_words(_BETWEEN.join(parts))
        if not len(words.first):
            return
        starts = np.cumsum([0] + [len(p) + len(_BETWEEN) for p in parts[:-1]])
        best = np.full(len(parts), self.floor)
        for some in (words, *readings(words)):
            values = word_sums(some, self.weights) + self.offset
            owner = np.searchsorted(starts, some.place, "right") - 1
            np.maximum.at(best, owner, values)
        raw[batch] = best


def _pick_landmarks(good: list[str], bad: list[str], n: int) -> list[str]:
    """Half from each kind; those least like the landmarks already taken, in order of weight."""
    taken: list[str] = []
    for pool, wanted in ((bad, n - n // 3), (good, n // 3)):
        if not pool:
            continue
        pool = pool[: LANDMARK_POOL * n]
        closest = kernel(pool, landmarks_of(pool[:1]))[:, 0]
        own, chosen = np.ones(len(pool)), [0]
        while len(chosen) < min(wanted, len(pool)):
            following = int(np.argmax(own - closest))
            if own[following] - closest[following] < 0.05:
                break
            chosen.append(following)
            closest = np.maximum(closest, kernel(pool, landmarks_of([pool[following]]))[:, 0])
        taken += [pool[i] for i in chosen]
    return taken


@dataclass
class Sample:
    """Sampled documents: their distinct words as numbers in a vocabulary."""

    vocabulary: list[str]
    docs: list[np.ndarray]
    toxic: np.ndarray

    @staticmethod
    def of(docs: list[tuple[list[str], bool]]) -> Sample:
        table = pa.table(
            {"words": pa.array([w for w, _ in docs], pa.list_(pa.string())),
             "toxic": pa.array([int(t) for _, t in docs], pa.int32())}
        )
        return Sample.of_table(table)

    @staticmethod
    def of_table(table: pa.Table) -> Sample:
        words = table.column("words").combine_chunks()
        if isinstance(words, pa.ChunkedArray):  # an empty table has no chunk to combine
            words = pa.array([], pa.list_(pa.string()))
        coded = words.flatten().dictionary_encode()
        numbers = coded.indices.to_numpy()
        lengths = words.value_lengths().to_numpy()
        docs = np.split(numbers, np.cumsum(lengths)[:-1]) if len(lengths) else []
        return Sample(coded.dictionary.to_pylist(), docs, table.column("toxic").to_numpy() == 1)


def vocabulary_values(vocabulary: list[str], weights: np.ndarray) -> np.ndarray:
    out = [
        word_sums(to_words("\n".join(vocabulary[i : i + 20_000]), spelled=False), weights)
        for i in range(0, len(vocabulary), 20_000)
    ]
    return np.concatenate(out) if out else np.zeros(0)


def train(sample: Sample, shares: tuple[float, float], n_landmarks: int = N_LANDMARKS,
          rounds: int = ROUNDS) -> Model:
    """Fit on sampled documents.

    ``shares`` say how many labelled documents a sampled clean and a sampled toxic one stand for.
    """
    vocabulary, toxic = sample.vocabulary, sample.toxic
    n_docs, n_toxic = len(toxic), int(toxic.sum())
    toxic_docs = [d for d, t in zip(sample.docs, toxic) if t and len(d)]
    clean_docs = [d for d, t in zip(sample.docs, toxic) if not t and len(d)]
    if not toxic_docs or not clean_docs:
        share = min(max(n_toxic / max(1, n_docs), 1e-9), 1 - 1e-9)
        return Model(None, 0.0, 0.0, float(np.log(share / (1 - share))), 0.0)
    size = len(vocabulary)
    toxic_df = np.bincount(np.concatenate(toxic_docs), minlength=size)
    clean_df = np.bincount(np.concatenate(clean_docs), minlength=size)
    rate = n_toxic / (n_docs - n_toxic)
    score = np.log((toxic_df + 0.5) / (rate * clean_df + 0.5))
    # Only words that toxic documents hold far more often can stand for a sentence.
    suspects = [d[score[d] > _EVIDENCE] for d in toxic_docs]
    suspects = [d for d in suspects if len(d)] or toxic_docs
    ranked = [d[np.lexsort((d, -score[d]))][:_WITNESSES] for d in suspects]
    sure = (toxic_df >= max(8, n_toxic / 100)) & (score > _SURE)
    strong = [d[sure[d] | (np.arange(len(d)) == 0)] for d in ranked]
    witness = np.bincount(np.concatenate(strong), minlength=size)
    clean = np.flatnonzero(clean_df)
    clean = clean[np.lexsort((clean, -clean_df[clean]))]
    common, others = clean[:COMMON_NEGATIVES], clean[COMMON_NEGATIVES:]
    every = others[:: max(1, len(clean) // SPREAD_NEGATIVES)]
    bad = np.flatnonzero(witness)
    bad = bad[np.lexsort((bad, -witness[bad]))]
    chosen = _pick_landmarks(
        [vocabulary[i] for i in common], [vocabulary[i] for i in bad], n_landmarks
    )
    landmarks = landmarks_of(chosen)
    values, vectors = np.linalg.eigh(kernel(chosen, landmarks))
    solid = values > 1e-4 * values.max()
    root = vectors[:, solid] / np.sqrt(values[solid])
    negatives = np.concatenate([common, every])
    features: dict[int, np.ndarray] = {}

    def rows(numbers: np.ndarray) -> np.ndarray:
        new = [i for i in numbers.tolist() if i not in features]
        found = kernel([vocabulary[i] for i in new], landmarks) @ root
        features.update(zip(new, found.astype(np.float32)))
        return np.stack([features[i] for i in numbers.tolist()]).astype(np.float64)

    for step in range(rounds):
        named = np.flatnonzero(witness)
        x = np.concatenate([rows(named), rows(negatives)])
        y = np.repeat([1.0, -1.0], [len(named), len(negatives)])
        pull = np.sqrt(witness[named])
        cost = np.concatenate([pull * len(negatives) / pull.sum() / 2, np.ones(len(negatives))])
        w = train_svm(x, y, COST * cost)
        weights = np.zeros(_SYMBOLS**LENGTH, np.float32)
        weights[landmarks.numbers] = landmarks.weights @ (root @ w[:-1])
        worth = vocabulary_values(vocabulary, weights) + w[-1]
        if step + 1 < rounds:
            best = [d[np.argmax(worth[d])] for d in suspects]
            picked = [np.union1d(d, [b]) for d, b in zip(strong, best)]
            again = np.bincount(np.concatenate(picked), minlength=size) * (worth > 0)
            witness = again if again.any() else witness
            hard = clean[np.argsort(-worth[clean], kind="stable")[:HARD_NEGATIVES]]
            negatives = np.union1d(negatives, hard)
    floor = float(np.median(worth[clean]))
    raw = np.array([worth[d].max() if len(d) else floor for d in sample.docs])
    slope, shift = _calibrated(raw, toxic, np.where(toxic, shares[1], shares[0]))
    return Model(weights, float(w[-1]), slope, shift, floor)


def _distinct_words(text: str | None) -> list[str]:
    """Words and readings as the kernel sees them: lower case, without outer punctuation."""
    found = {w.strip(_PUNCTUATION) for w in (text or "").lower().split()}
    for word in list(found):
        if not word.isalpha():
            reading = "".join(filter(str.isalpha, word))
            if len(reading) >= _LEAST_READING:
                found.add(reading)
        if len(word) >= _LEAST_REGULAR and len(word) % 2 and len(set(word[1::2])) == 1:
            found.add(word[::2])
    return sorted(w for w in found if w)


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [_distinct_words(text) for text in batch.column("text").to_pylist()]
        columns = [batch.column("_id"), batch.column("_toxic")]
        columns.append(pa.array(words, pa.list_(pa.string())))
        yield pa.RecordBatch.from_arrays(columns, names=["id", "toxic", "words"])


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Train on a bounded sample of the labelled documents that may be learned from."""
    spark = docs.sparkSession
    marks = (
        labels.select("doc_id", "toxic")
        .dropna()
        .filter(is_training())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    totals = dict(marks.groupBy("toxic").count().collect())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = [
        row
        for mark in (0, 1)
        for row in marks.filter(F.col("toxic") == mark).orderBy(*order).limit(max_docs).collect()
    ]
    if not sample:
        return train(Sample.of([]), (1.0, 1.0))
    kind = dict(labels.dtypes)["doc_id"]
    chosen = spark.createDataFrame(sample, f"_id {kind}, _toxic int")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # One of the rows that repeat an id, so that the sample stays within its bound.
    once = texts.groupBy("_id", "_toxic").agg(F.max("text").alias("text"))
    lists = once.mapInArrow(
        _word_lists, f"id {kind}, toxic int, words array<string>"
    )
    found = lists.toArrow().sort_by("id")
    have = Counter(found.column("toxic").to_pylist())
    shares = tuple(totals.get(mark, 0) / max(1, have[mark]) for mark in (0, 1))
    return train(Sample.of_table(found), shares)


def _score(broadcast):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = broadcast.value.scores(batch.column("text").to_pylist())
            yield batch.drop_columns(["text"]).append_column("score", pa.array(values, pa.float64()))

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.select("doc_id", "text").mapInArrow(_score(shared), f"doc_id {kind}, score double")
    held_out = F.coalesce(~is_training(), F.lit(False)).alias("held_out")
    return scored.select(
        "doc_id", held_out, "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def _keep(broadcast, cut: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = broadcast.value.scores(batch.column("text").to_pylist())
            yield batch.filter(pa.array(values < cut, pa.bool_()))

    return keep


def keep_clean(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The documents below the cut, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_keep(shared, cut), docs.schema)

"""Quality by co-training: a text-content view and a page-metadata view teach each other.

Both views are logistic models. The content view sees the shape of a text and its hashed word and
character n-grams, the metadata view language, source and stated length. Each begins with the
labelled sample. In every round both views judge all unlabelled documents; every document that a
view is sure of becomes a pseudo-labelled example of the other view, and both are fitted again.
Each view is calibrated on labelled documents it has not seen, and the calibrated views are added
on the logit scale, where a view without information adds nothing.

Pseudo-labels have no cap: Spark sums gradient and curvature over all sure documents for each Newton
step, and the driver sees these sums only. Documents with equal features count as one, so a group of
copies is one example, and the pseudo-labels of a class weigh at most half as much as its labelled
examples. The labelled sample is bounded, in hash order. Reruns agree up to the order of summation.

Nulls: a null text is an empty one; null metadata has buckets of its own and length 0; labels with
a null id or mark are not used, and of contradicting marks the worse one counts. Of rows that repeat
a doc_id one is learned from. A null doc_id is scored and never used for training. Without labels
of both kinds every document gets the share of good labels (0.5 without any).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiscore.llm.common import byte_values
from stratiscore.sources.staging import Workspace

MAX_LABELLED = 12_000  # bounded sample of labelled documents
ROUNDS = 3
STEPS = 3  # Newton steps of a round, each from the weights of the one before
SURE = 0.95
PSEUDO_SHARE = 0.5  # weight of a class's pseudo-labels against its labelled examples, at most
CUT = 0.5
RIDGE = 1.0
_LANGS, _SOURCES = 16, 64
_CALIBRATION = 5  # every fifth labelled document calibrates
_SYMBOLS = b"#*$%&|<>"
_GRAM_BITS = 7  # buckets of the word n-grams, and as many of the character n-grams
_GRAMS = 2 << _GRAM_BITS
_GRAM_SCALE = 4.0  # shares are far smaller than the other numbers
_CHARS = 1 << 20  # characters hashed at once
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def is_training(doc_id: str = "doc_id") -> Column:
    """Rows whose labels may be learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1


# --- views ------------------------------------------------------------------------------------

_N_CONTENT = 12


def _buckets(hashes: np.ndarray) -> np.ndarray:
    """Counts of the hashes by their mixed leading bits."""
    mixed = (hashes ^ (hashes >> np.uint32(15))) * _MIX[0]
    return np.bincount(mixed >> np.uint32(32 - _GRAM_BITS), minlength=_GRAMS // 2)


def gram_bytes(data: bytes, words: list[bytes]) -> bytes:
    """Square roots of the shares of hashed word n-grams (one and two words) and of hashed runs of
    three bytes, in lower case, as a byte each."""
    numbers = np.fromiter((zlib.crc32(w.lower()) for w in words), np.uint32, len(words))
    counts = [_buckets(numbers) + _buckets(numbers[:-1] * _MIX[1] + numbers[1:])]
    runs = np.zeros(_GRAMS // 2, np.int64)
    for at in range(0, max(1, len(data) - 2), _CHARS):
        a = np.frombuffer(data[at : at + _CHARS + 2].lower(), np.uint8).astype(np.uint32)
        if len(a) > 2:
            runs += _buckets((a[:-2] * _MIX[1] + a[1:-1]) * _MIX[2] + a[2:])
    counts.append(runs)
    shares = [c / max(1, c.sum()) for c in counts]
    return np.rint(255 * np.sqrt(np.concatenate(shares))).astype(np.uint8).tobytes()


def content_numbers(data: bytes, words: list[bytes]) -> list[float]:
    """Shape of a text: length, repetition, symbols, case, digits and lines."""
    n, size = len(words), max(1, len(data))
    if not n:
        return [0.0] * _N_CONTENT
    again = sum(map(bytes.__eq__, words, words[1:]))
    distinct = len(set(words))
    symbols = size - len(data.translate(None, _SYMBOLS))
    marks = size - len(data.translate(None, b".,;:"))
    shouts = size - len(data.translate(None, b"!?"))
    digits = size - len(data.translate(None, b"0123456789"))
    upper = size - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return [
        np.log1p(n) / 5,
        min(1.0, 20 / n),
        again / n,
        distinct / n,
        np.log(distinct) / max(1.0, np.log(n)),
        min(1.0, symbols / n),
        min(1.0, marks / n),
        min(1.0, shouts / n),
        min(1.0, digits / n),
        upper / size,
        1 - len(set(lines)) / len(lines),
        min(2.0, size / n / 10),
    ]


def metadata_columns(docs: DataFrame) -> list[Column]:
    """Language and source buckets and the stated length."""
    have = set(docs.columns)

    def bucket(name: str, n: int) -> Column:
        value = F.col(name).cast("string") if name in have else F.lit(None).cast("string")
        return F.pmod(F.xxhash64(F.coalesce(F.concat(F.lit("="), value), F.lit(""))), F.lit(n)).cast("int")

    length = F.col("n_chars").cast("double") if "n_chars" in have else F.lit(0.0)
    return [
        bucket("lang", _LANGS).alias("lang_bucket"),
        bucket("source", _SOURCES).alias("source_bucket"),
        (F.log1p(F.greatest(F.coalesce(length, F.lit(0.0)), F.lit(0.0))) / 10).alias("log_chars"),
    ]


def _content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers, grams = [], []
        for data in byte_values(batch.column("text")):
            words = data.split()
            numbers.append(content_numbers(data, words))
            grams.append(gram_bytes(data, words))
        kept = batch.drop_columns(["text"])
        kept = kept.append_column("content", pa.array(numbers, pa.list_(pa.float64())))
        yield kept.append_column("grams", pa.array(grams, pa.binary()))


_FEATURES = ("lang_bucket", "source_bucket", "log_chars", "content", "grams")


def views(docs: DataFrame) -> DataFrame:
    """doc_id with the features of both views, one narrow row per document."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", *metadata_columns(docs), "text")
    schema = (
        f"doc_id {kind}, lang_bucket int, source_bucket int, log_chars double,"
        " content array<double>, grams binary"
    )
    return rows.mapInArrow(_content, schema)


def content_matrix(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Content numbers, their squares and the n-gram shares, with a last column of ones."""
    n = batch.num_rows
    numbers = np.array(batch.column("content").to_pylist(), float).reshape(n, _N_CONTENT)
    grams = np.frombuffer(b"".join(batch.column("grams").to_pylist()), np.uint8).reshape(n, _GRAMS)
    return np.hstack([numbers, numbers**2, grams * (_GRAM_SCALE / 255), np.ones((n, 1))])


def metadata_matrix(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Language and source as indicators, the length and its square, with a last column of ones."""
    n = batch.num_rows
    out = np.zeros((n, _LANGS + _SOURCES + 3))
    rows = np.arange(n)
    out[rows, batch.column("lang_bucket").to_numpy(zero_copy_only=False)] = 1
    out[rows, _LANGS + batch.column("source_bucket").to_numpy(zero_copy_only=False)] = 1
    length = batch.column("log_chars").to_numpy(zero_copy_only=False)
    out[:, -3], out[:, -2], out[:, -1] = length, length**2, 1
    return out


# --- models -----------------------------------------------------------------------------------


def newton_sums(x: np.ndarray, y: np.ndarray | float, w: np.ndarray) -> np.ndarray:
    """Curvature and, as its last column, gradient of the logistic loss of some rows."""
    p = _sigmoid(x @ w)
    curved = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x
    return np.hstack([curved, (x.T @ (p - y))[:, None]])


def newton_step(sums: np.ndarray, w: np.ndarray, ridge: float) -> np.ndarray:
    """The next weights; the offset, which comes last, is not held back."""
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    step = np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1] + penalty * w)
    return w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton's method; the last column of x is ones."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        last, w = w, newton_step(newton_sums(x, y, w), w, ridge)
        if np.abs(w - last).max() < 1e-8:
            break
    return w


def _sigmoid(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class Views:
    """Both models with their calibration (slope, offset) and the prior logit."""

    text: np.ndarray
    metadata: np.ndarray
    text_scale: tuple[float, float] = (1.0, 0.0)
    metadata_scale: tuple[float, float] = (1.0, 0.0)
    prior: float = 0.0
    handed_over: list[int] = field(default_factory=list)

    def text_logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.text * self.text_scale[0] + self.text_scale[1]

    def metadata_logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.metadata * self.metadata_scale[0] + self.metadata_scale[1]


def _scale(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    w = fit_logistic(np.column_stack([logit, np.ones(len(y))]), y, 1e-3)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (0.0, float(np.log(y.mean() / (1 - y.mean()))))


def _labelled(features: DataFrame, labels: DataFrame, max_labelled: int) -> pa.Table:
    """Features and marks of the labelled sample, by doc_id."""
    marks = (
        labels.select("doc_id", "quality")
        .dropna()
        .filter(is_training())
        .groupBy("doc_id")
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
    )
    sample = marks.orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(max_labelled).collect()
    kind = dict(labels.dtypes)["doc_id"]
    chosen = features.sparkSession.createDataFrame(sample, f"_id {kind}, quality int")
    joined = features.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # One of the rows that repeat an id, so that the sample stays within its bound.
    one = F.max(F.struct("quality", *_FEATURES)).alias("r")
    return joined.groupBy("doc_id").agg(one).select("doc_id", "r.*").toArrow().sort_by("doc_id")


def unlabelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of the documents without any label, each distinct row once."""
    known = labels.select(F.col("doc_id").alias("_id")).dropna().distinct()
    rows = features.filter("doc_id is not null")
    return rows.join(known, F.col("doc_id") == F.col("_id"), "left_anti").select(*_FEATURES).distinct()


_TEXT, _METADATA = 0, 1
_PART = "student int, class int, row int, sums array<double>"


def _pseudo_sums(teachers: Views, text: np.ndarray, metadata: np.ndarray, sure: float) -> Callable:
    """Per task: rows of the Newton sums of both students over the documents that the other view,
    as it was when the round began, is sure of; by class. Row -1 holds their number."""
    limit = float(np.log(sure / (1 - sure)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        count: dict[tuple[int, int], int] = {}
        for batch in batches:
            x, z = content_matrix(batch), metadata_matrix(batch)
            pairs = (
                (_TEXT, x, text, teachers.metadata_logit(z)),
                (_METADATA, z, metadata, teachers.text_logit(x)),
            )
            for student, own, w, judged in pairs:
                for mark, chosen in ((0, judged <= -limit), (1, judged >= limit)):
                    if chosen.any():
                        key = student, mark
                        total[key] = total.get(key, 0) + newton_sums(own[chosen], mark, w)
                        count[key] = count.get(key, 0) + int(chosen.sum())
        for (student, mark), sums in total.items():
            values = [[float(count[student, mark])], *sums.tolist()]
            n = len(values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([student] * n, pa.int32()),
                    pa.array([mark] * n, pa.int32()),
                    pa.array(range(-1, n - 1), pa.int32()),
                    pa.array(values, pa.list_(pa.float64())),
                ],
                ["student", "class", "row", "sums"],
            )

    return add


def _added(table: pa.Table) -> pa.Table:
    """One row of the sums over all tasks; a short vector from each task."""
    first = table.slice(0, 1)
    sums = np.sum(table.column("sums").to_pylist(), axis=0)
    return first.set_column(3, "sums", pa.array([sums.tolist()], pa.list_(pa.float64())))


def train(
    workspace: Workspace,
    features: DataFrame,
    labels: DataFrame,
    rounds: int = ROUNDS,
    steps: int = STEPS,
    sure: float = SURE,
    max_labelled: int = MAX_LABELLED,
) -> Views | float:
    """Co-train on staged features; a bare share of good labels where there is only one class."""
    sample = _labelled(features, labels, max_labelled)
    y = sample.column("quality").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    x, z = content_matrix(sample), metadata_matrix(sample)
    held = np.arange(len(y)) % _CALIBRATION == 0
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(y), bool)
    fitted, check = ~held, held if held.any() else ~held

    def model(text: np.ndarray, metadata: np.ndarray, handed_over: list[int]) -> Views:
        scales = _scale(x[check] @ text, y[check]), _scale(z[check] @ metadata, y[check])
        return Views(text, metadata, *scales, float(np.log(y.mean() / (1 - y.mean()))), handed_over)

    out = model(fit_logistic(x[fitted], y[fitted]), fit_logistic(z[fitted], y[fitted]), [])
    rows = workspace.stage(unlabelled(features, labels), "unlabelled") if rounds else features
    of_class = [int((y[fitted] == mark).sum()) for mark in (0, 1)]
    for _ in range(rounds):
        weights, handed = [out.text, out.metadata], 0
        for _ in range(steps):
            parts = rows.mapInArrow(_pseudo_sums(out, *weights, sure), _PART)
            found = parts.groupBy("student", "class", "row").applyInArrow(_added, _PART).collect()
            rows_of = {(r["student"], r["class"], r["row"]): r["sums"] for r in found}
            handed = int(sum(v[0] for (_, _, row), v in rows_of.items() if row == -1))
            for student, known in ((_TEXT, x[fitted]), (_METADATA, z[fitted])):
                w = weights[student]
                sums = newton_sums(known, y[fitted], w)
                for mark in (0, 1):
                    n = rows_of.get((student, mark, -1), [0])[0]
                    if n:
                        pseudo = np.array([rows_of[student, mark, i] for i in range(len(w))])
                        sums = sums + pseudo * PSEUDO_SHARE * min(1.0, of_class[mark] / n)
                weights[student] = newton_step(sums, w, RIDGE)
        out = model(*weights, [*out.handed_over, handed])
    return out


def _logits(model: Views) -> Callable:
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = model.text_logit(content_matrix(batch))
            metadata = model.metadata_logit(metadata_matrix(batch))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "held_out"]).columns, pa.array(text), pa.array(metadata)],
                ["doc_id", "held_out", "text", "metadata"],
            )

    return judge


def _share(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def score(features: DataFrame, model: Views | float) -> DataFrame:
    """doc_id, held_out, text_score, metadata_score, score, kept of every document."""
    held_out = F.coalesce(~is_training(), F.lit(False)).alias("held_out")
    if isinstance(model, float):
        rows = features.select("doc_id", held_out)
        text = metadata = both = F.lit(model)
    else:
        kind = dict(features.dtypes)["doc_id"]
        schema = f"doc_id {kind}, held_out boolean, text double, metadata double"
        rows = features.select("doc_id", held_out, *_FEATURES).mapInArrow(_logits(model), schema)
        text, metadata = _share(F.col("text")), _share(F.col("metadata"))
        both = _share(F.col("text") + F.col("metadata") - model.prior)
    return rows.select(
        "doc_id",
        "held_out",
        text.alias("text_score"),
        metadata.alias("metadata_score"),
        both.alias("score"),
        (both >= CUT).alias("kept"),
    )


def classify(workspace: Workspace, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    features = workspace.stage(views(docs), "views")
    return score(features, train(workspace, features, labels, **options))

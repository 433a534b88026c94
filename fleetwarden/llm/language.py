"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.characters import code_points, folded, letters, squeezed
from fleetwarden.llm.frames import row_struct
from fleetwarden.session import ship

UNKNOWN = "und"
#: n-grams of one to three characters fall into this many features.
FEATURES, LONGEST = 1 << 15, 3
#: Bounds of the training sample: documents in all, but so many of each language at least, and characters of a document.
SAMPLE, SAMPLE_EACH, SAMPLE_CHARS = 3_000, 12, 50_000
SEED = 20240607
#: Documents that score less are rejected by a filter: two languages in one text score 0.4 to 0.5 and stay. Among many
#: languages the bound is this many times the score of a guess.
LEAST_SCORE, GUESSES = 0.35, 1.4
#: Characters handled at once, so that a text of any length needs bounded memory.
SLICE = 1_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """weights: features x languages with the idf folded in; idf scales the norm; temperature divides the scores."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def gram_counts(text: str) -> np.ndarray | None:
    """How often each feature occurs in the whole text; None where the text has no letter.

    Letters are put in lower case, everything else is one blank.
    """
    out, found = np.zeros(FEATURES, np.int64), False
    tail = np.array([32], np.uint64)
    for at in range(0, len(text), SLICE):
        points = code_points(text[at : at + SLICE])
        letter = letters()[points]
        found |= bool(letter.any())
        points = np.where(letter, folded()[points], np.uint32(32))
        points = np.concatenate([tail, points.astype(np.uint64)])
        old = len(tail)
        keep = squeezed(points)
        keep[:old] = True
        points = points[keep]
        value = np.zeros(len(points), np.uint64)
        for n in range(1, LONGEST + 1):
            # The gram of n characters that ends at each place; grams inside the last slice were counted there.
            value = value[:-1] if n > 1 else value
            value = (value * np.uint64(0x100000001B3)) ^ ((points[n - 1 :] + np.uint64(n)) * _GOLD)
            new = value[max(0, old - n + 1) :]
            out += np.bincount(((new ^ (new >> np.uint64(29))) * _GOLD >> np.uint64(49)).astype(np.int64), minlength=FEATURES)
        tail = points[-(LONGEST - 1) :]
    return out if found else None


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            counts = gram_counts(text.as_py() or "")
            if counts is not None:
                seen += counts > 0
                n += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([n], pa.int64()), pa.array([seen.tolist()], pa.list_(pa.int64()))], names=["n", "seen"]
    )


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for lang, text, hold in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "hold"))):
            counts = gram_counts(text)
            if counts is not None:
                at = np.flatnonzero(counts)
                rows.append((lang, hold, at.astype(np.int32).tobytes(), counts[at].astype(np.int32).tobytes()))
        columns = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.binary(), pa.binary()))],
            names=["lang", "hold", "at", "times"],
        )


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(
    rows: list, classes: int, epochs: int = 4, alpha: float = 1.0, beta: float = 0.1, l1: float = 0.002, l2: float = 0.01
) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of a multinomial logistic regression by FTRL-proximal, from rows (features, values, class).

    Every coordinate keeps the sum z of its gradients and n of their squares; its weight is 0 while |z| <= l1, and
    -(z - sign(z) l1) / ((beta + sqrt(n)) / alpha + l2) beyond. The bias is one more feature without l1.
    """
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))
    penalty = np.full((FEATURES + 1, 1), l1)
    penalty[-1] = 0

    def weights(at):
        zs, over = z[at], np.maximum(np.abs(z[at]) - penalty[at], 0)
        return -np.sign(zs) * over / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(SEED)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            at, values, label = rows[r]
            w = weights(at)
            off = _softmax(values @ w)
            off[label] -= 1
            g = values[:, None] * off
            ns = n[at]
            z[at] += g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g * g
    w = weights(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def best_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, by golden section over its logarithm.

    The right class of n documents counts (n + 1) / (n + 2), the rest is shared by the others, so that documents
    that are all told apart do not make the scores certain.
    """
    n, classes = scores.shape
    if not n or classes < 2:
        return 1.0
    target = np.full(scores.shape, 1 / (n + 2) / (classes - 1))
    target[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(t):
        return -(target * np.log(np.maximum(_softmax(scores / np.exp(t)), 1e-300))).sum(axis=1).mean()

    low, high, part = np.log(0.1), np.log(10.0), (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(rows: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from rows (id, text, lang), or None where no row has a lang and a letter.

    Document frequencies cover every row, and every language that a row has is learned. The regression is fitted on a
    sample of about `sample` documents, spread evenly over the languages, but SAMPLE_EACH of each language if that is
    more (all, if it has fewer), drawn by a hash; repeated rows are drawn once. Of a text with more than SAMPLE_CHARS
    characters so many from a place drawn by the hash are taken. A fifth of the sample sets the temperature, except
    for languages that would have nothing else to learn from. The sample's features, one row a feature and one row a
    language reach the driver; the model has a weight for each feature and language.
    """
    ship(rows.sparkSession)
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequencies = (
        rows.select("text")
        .mapInArrow(_document_frequencies, "n long, seen array<long>")
        .select("n", F.posexplode("seen").alias("feature", "seen"))
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
        .collect()
    )
    chance = F.xxhash64(F.lit(SEED), "id", "text")
    per_language = rows.groupBy("lang").agg(F.approx_count_distinct(chance).alias("n")).orderBy("lang").collect()
    if not per_language:
        return None
    each = max(sample / len(per_language), SAMPLE_EACH)
    rates = rows.sparkSession.createDataFrame([(r["lang"], each / r["n"]) for r in per_language], "lang string, rate double")
    size = F.char_length("text")
    start = F.when(size > SAMPLE_CHARS, F.pmod(F.xxhash64(F.lit(SEED + 2), "id", "text"), size - SAMPLE_CHARS)).otherwise(0)
    drawn = (
        # One row a language, as the weights have one column a language.
        rows.join(F.broadcast(rates), "lang")
        .where(F.pmod(chance, F.lit(1 << 30)) / (1 << 30) < F.col("rate"))
        .select(
            "lang",
            F.substring("text", start.cast("int") + 1, F.lit(SAMPLE_CHARS)).alias("text"),
            (F.pmod(F.xxhash64(F.lit(SEED + 1), "id", "text"), F.lit(5)) == 0).alias("hold"),
        )
        .distinct()
    )
    found = drawn.mapInArrow(_sparse, "lang string, hold boolean, at binary, times binary").collect()
    languages = sorted({r["lang"] for r in found})
    if not languages:
        return None
    total = max(r["n"] for r in frequencies)
    idf = np.zeros(FEATURES)
    for r in frequencies:
        idf[r["feature"]] = np.log((1 + total) / (1 + r["seen"])) + 1
    learn, hold = [], []
    found.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["times"])))
    learned = {r["lang"] for r in found if not r["hold"]}
    for r in found:
        at = np.frombuffer(r["at"], np.int32)
        values = np.frombuffer(r["times"], np.int32) * idf[at]
        values = np.append(values / np.linalg.norm(values), 1.0)
        (hold if r["hold"] and r["lang"] in learned else learn).append((np.append(at, FEATURES), values, languages.index(r["lang"])))
    weights, bias = follow_the_leader(learn, len(languages))
    whole = np.vstack([weights, bias])
    scores = np.array([v @ whole[at] for at, v, _ in hold]).reshape(len(hold), len(languages))
    temperature = best_temperature(scores, np.array([y for _, _, y in hold], int))
    return Model(languages, idf, (weights * idf[:, None]).astype(np.float64), bias, temperature)


def predict_text(model: Model | None, text: str | None) -> tuple[str, float]:
    """(language, calibrated probability); ("und", 0.0) for a text without a letter or without a model."""
    counts = gram_counts(text) if text and model else None
    if counts is None:
        return UNKNOWN, 0.0
    at = np.flatnonzero(counts)
    times = counts[at]
    norm = np.linalg.norm(times * model.idf[at])
    p = _softmax((times @ model.weights[at] / norm + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One text at a time: the batch stays in Arrow, and no more than one text is a Python string.
            found = [predict_text(model, t.as_py()) for t in batch.column("text")]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    return run


def held_out(id_col: str) -> Column:
    """Documents that no model may learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return rows.where(F.col("id").isNotNull() & ~held_out("id"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None) -> DataFrame:
    """Rows (id, held_out, lang_pred, score), one for each row of docs, over whole texts.

    Without a model, one is trained on the rows that are not held out and have a lang. A null or empty text and one
    without letters is "und" with score 0.0, and so is every text where nothing could be learned. A null id is not
    held out and not learned from. Repeated rows get equal results. Extra columns are not read.
    """
    ship(docs.sparkSession)
    model = model or train(_learnable(docs, id_col, text_col, lang_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_predict(model), "id long, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float | None = None) -> DataFrame:
    """docs in their own columns, without those whose language is "und" or scores less than `least`.

    Without `least` it is LEAST_SCORE, and GUESSES / languages where there are so many that this is less. Texts that
    are null, empty or without letters go, and all texts where nothing could be learned; extra columns stay.
    """
    model = train(_learnable(docs, id_col, text_col, lang_col))
    if least is None:
        least = min(LEAST_SCORE, GUESSES / len(model.languages)) if model else LEAST_SCORE
    rows = docs.select(row_struct(docs), F.col(text_col).alias("text"))
    schema = rows.select("_row").schema.add("lang_pred", "string").add("score", "double")
    scored = rows.select("_row", "text").mapInArrow(_predict(model), schema)
    return scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(
        *[F.col("_row")[c].alias(c) for c in docs.columns]
    )

"""Language identification by a byte convolutional network trained in numpy.

Bytes are mapped to symbols (letters of ASCII without case, bytes beyond
ASCII, and one symbol for everything else). Filters of several widths slide
over windows of a fixed length; each filter's greatest response over the
window goes through a rectifier to a softmax over the languages. All windows of
a text are scored, in batches, and their probabilities are averaged with the
windows' letters as weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordgraph.llm.common import small_batches, text_bytes

WINDOW = 256
SYMBOLS = 155  # 0: other; 1-26: letters; 27-154: bytes from 0x80
WIDTHS = (2, 3, 4)
FILTERS = 12
#: Bounds of the training sample for each language: texts, windows of each text.
SAMPLE_TEXTS = 400
SAMPLE_WINDOWS = 4
UNKNOWN = "und"


def symbol_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for i in range(26):
        table[65 + i] = table[97 + i] = 1 + i
    table[128:] = np.arange(27, 155)
    return table


@dataclass
class Model:
    """Languages, one array ``(width, symbols, filters)`` per width, biases, and the softmax layer."""

    langs: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """Responses of the filters of each width to pairs of symbols (and to the third of width 3)."""
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(SYMBOLS * SYMBOLS, -1)
        two, three, four = self.filters
        return [pair(two[0], two[1]), pair(three[0], three[1]), np.ascontiguousarray(three[2]),
                pair(four[0], four[1]), pair(four[2], four[3])]

    def probabilities(self, codes: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Softmax outputs for windows of symbols, a row each."""
        out = []
        for i in range(0, len(codes), 128):
            c = codes[i:i + 128].astype(np.int32)
            pairs = c[:, :-1] * SYMBOLS + c[:, 1:]
            pooled = [tables[0][pairs].max(axis=1),
                      (tables[1][pairs[:, :-1]] + tables[2][c[:, 2:]]).max(axis=1),
                      (tables[3][pairs[:, :-2]] + tables[4][pairs[:, 2:]]).max(axis=1)]
            z = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0) @ self.dense + self.offset
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)))


def windows_of(data: bytes, table: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """All windows of a text as rows of symbols; the last is filled up with the other-symbol."""
    n = max(1, -(-len(data) // window))
    codes = np.zeros(n * window, np.uint8)
    codes[:len(data)] = table[np.frombuffer(data, np.uint8)]
    return codes.reshape(n, window)


def sample(docs: DataFrame, seed: int = 0) -> list[tuple[str, str]]:
    """(language, passage) pairs of a bounded sample of ``docs(key, text, lang)``.

    ``SAMPLE_TEXTS`` texts of every label by a hash of the key, and ``SAMPLE_WINDOWS`` passages spread over each text.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key", F.lit(seed)), F.xxhash64("text"))
    chosen = known.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= SAMPLE_TEXTS)
    free = F.greatest(F.length("text") - WINDOW, F.lit(0))
    at = lambda i: F.floor(free * (i / max(1, SAMPLE_WINDOWS - 1))).cast("int") + 1
    passages = F.array(*[F.substr(F.col("text"), at(i), F.lit(WINDOW)) for i in range(SAMPLE_WINDOWS)])
    rows = chosen.select("lang", F.explode(F.array_distinct(passages)).alias("passage")).orderBy("lang", F.xxhash64("passage"))
    return [(r["lang"], r["passage"]) for r in rows.collect()]


def train(pairs: list[tuple[str, str]], seed: int = 0, epochs: int = 6, batch: int = 48, rate: float = 0.01) -> Model:
    """Fit the network by Adam; passages are also shown cut short, as short texts occur too."""
    rng, table = np.random.default_rng(seed), symbol_table()
    langs = sorted({lang for lang, _ in pairs})
    y = np.array([langs.index(lang) for lang, _ in pairs])
    x = np.stack([windows_of(text.encode()[:WINDOW], table)[0] for _, text in pairs])
    n_out, width = len(langs), FILTERS * len(WIDTHS)
    params = [rng.normal(0, 0.1, (w, SYMBOLS, FILTERS)) for w in WIDTHS]
    params += [np.zeros(width), rng.normal(0, 0.3, (width, n_out)), np.zeros(n_out)]
    first, second, turn = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            c = x[at].astype(np.int64)
            keep = np.where(rng.random(len(at)) < 0.4, rng.integers(24, WINDOW, len(at)), WINDOW)
            c[np.arange(WINDOW)[None, :] >= keep[:, None]] = 0
            pooled, places = [], []
            for w, f in zip(WIDTHS, params):
                response = sum(f[k][c[:, k:WINDOW - w + 1 + k]] for k in range(w))
                places.append(response.argmax(axis=1))
                pooled.append(np.take_along_axis(response, places[-1][:, None, :], 1)[:, 0])
            pre = np.concatenate(pooled, axis=1) + params[3]
            hidden = np.maximum(pre, 0)
            z = hidden @ params[4] + params[5]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(at)), y[at]] -= 1
            z /= len(at)
            back = (z @ params[4].T) * (pre > 0)
            grads = [np.zeros_like(p) for p in params]
            grads[3], grads[4], grads[5] = back.sum(axis=0), hidden.T @ z, z.sum(axis=0)
            column = np.broadcast_to(np.arange(FILTERS), (len(at), FILTERS))
            for i, (w, place) in enumerate(zip(WIDTHS, places)):
                g = back[:, i * FILTERS:(i + 1) * FILTERS]
                for k in range(w):
                    np.add.at(grads[i][k], (np.take_along_axis(c, place + k, 1), column), g)
            turn += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    small = [p.astype(np.float32) for p in params]
    return Model(langs, small[:3], small[3], small[4], small[5])


def has_letter(data: bytes) -> bool:
    return any(map(str.isalpha, data.decode("utf-8")))


class Scorer:
    """Language and score of texts; ``und`` and 0 without a letter or a model."""

    def __init__(self, model: Model | None):
        self.model, self.table = model, symbol_table()
        self.tables = model.tables() if model else None

    def answers(self, texts: list[bytes]) -> list[pa.Array]:
        langs, scores = [], []
        for data in texts:
            if self.model is None or not has_letter(data):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            codes = windows_of(data, self.table)
            weight = (codes > 0).sum(axis=1) + 1e-9
            p = weight @ self.model.probabilities(codes, self.tables) / weight.sum()
            langs.append(self.model.langs[int(p.argmax())])
            scores.append(float(min(1.0, p.max())))
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]


def identified(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``row, lang_pred, score`` for every row of ``docs``; ``row`` holds all its columns.

    ``lang_pred`` is ``und`` with score 0 for a null text or one without a
    letter, and for every text where nothing was learnt. Only the text is
    looked at.
    """
    small_batches(docs.sparkSession)
    packed = docs.select(F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *scorer.answers(text_bytes(batch.column("text")))],
                names=["row", "lang_pred", "score"])

    # As a schema, not as text: names of the row's columns may hold any character.
    return packed.mapInArrow(run, T.StructType([packed.schema["row"], T.StructField("lang_pred", T.StringType()),
                                                T.StructField("score", T.DoubleType())]))


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for every row of ``docs``."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *scorer.answers(text_bytes(batch.column("text")))],
                names=["key", "lang_pred", "score"])

    small_batches(docs.sparkSession)
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)

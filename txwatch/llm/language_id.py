"""Language identification by sparse multinomial logistic regression.

Features: character 1- to 3-grams of the lower-cased text (each run of non-letters is one
space), hashed into ``2**BITS`` slots; a slot's value is its share of the text's n-grams
times its inverse document frequency, counted over all training documents.  The weights
are fitted with follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties)
on a bounded sample of labelled rows, then one temperature is fitted on rows of the sample
that were held back.  L1 leaves most weights zero.

Because values are shares, a document's logits are a mean of per-n-gram weights: whole
texts are scored by table look-ups and sums, with nothing kept per distinct n-gram.

Every distinct ``lang`` of a training row whose text has a letter is learned.  Bound of the
sample (a parameter): the same number of rows of each language, those with the least hash of
doc_id; ``SAMPLE_ROWS`` rows in all, but not under ``LANG_ROWS`` a language.  So the model grows
with the number of languages: for each, 256 KB of the table that goes to the tasks and 1 MB
of the driver's memory while it learns, and fitting time grows with its square.

Null text or text without a letter: ``und`` with score 1.  Rows with null lang teach
nothing.  No labelled rows at all: every document is ``und``.  Repeated rows are predicted
each; further columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import received, sent

BITS = 16
ORDERS = 3
SCALE = 100.0            # shares are small numbers; this only sets the unit of the weights
SAMPLE_ROWS = 2000
LANG_ROWS = 30           # rows of a language that are sampled if it has them
EPOCHS = 4
ALPHA, BETA = 0.5, 1.0   # learning rate of follow-the-regularised-leader
L1, L2 = 1e-3, 1e-3
HELD_BACK = 5            # one row in so many fits the temperature
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngrams(text: str, letters: np.ndarray) -> np.ndarray:
    """Slots of all n-grams of a text; empty if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters[codes]
    if not is_letter.any():
        return np.zeros(0, np.uint32)
    codes = np.where(is_letter, codes, 32)
    gap = codes == 32
    codes = codes[np.concatenate(([True], ~(gap[1:] & gap[:-1])))]
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    slots, h = [], np.zeros(len(codes), np.uint32)
    for n in range(ORDERS):
        own = codes[n:]
        h = (h[:len(own)] + own) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        slots.append((h * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS))
    return np.concatenate(slots)


def _texts(batch: pd.DataFrame) -> Iterator[str]:
    for t in batch["text"]:
        yield t if isinstance(t, str) else ""


def document_frequencies(train: DataFrame) -> tuple[int, np.ndarray]:
    """Number of training documents and, per slot, how many of them have it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, seen, n = letter_table(), np.zeros(1 << BITS, np.int64), 0
        for b in batches:
            for text in _texts(b):
                flags = np.zeros(1 << BITS, bool)
                flags[ngrams(text, letters)] = True
                seen += flags
                n += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"slot": np.append(at, -1), "n": np.append(seen[at], n)})

    rows = (train.select("text").mapInPandas(run, "slot int, n bigint")
            .groupBy("slot").agg(F.sum("n").alias("n")).toPandas())  # a row per slot at most
    df = np.zeros(1 << BITS, np.int64)
    own = rows[rows["slot"] >= 0]
    df[own["slot"].to_numpy()] = own["n"].to_numpy()
    return int(rows.loc[rows["slot"] < 0, "n"].sum()), df


def sample(train: DataFrame, rows: int = SAMPLE_ROWS, least: int = LANG_ROWS) -> tuple[DataFrame, int]:
    """The training sample and its rows of each language.  Only ids and labels are ranked, no
    text is moved; one row of cuts for each language goes to the tasks."""
    train = train.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    each = max(least, rows // max(1, train.select("lang").distinct().count()))
    key = F.xxhash64(F.col("doc_id"))
    rank = Window.partitionBy("lang").orderBy("h")
    cuts = (train.select("lang", key.alias("h"))
            .withColumn("r", F.row_number().over(rank)).where(F.col("r") <= each + 1)
            .groupBy(F.col("lang").alias("s_lang"))
            .agg(F.count(F.lit(1)).alias("s_n"), F.min("h").alias("s_first"), F.max("h").alias("s_stop")))
    # repeats of one id may fill a language's share: they come in, and fit() takes ``each``
    chosen = (F.col("s_n") <= each) | (key < F.col("s_stop")) | (key == F.col("s_first"))
    return (train.join(F.broadcast(cuts), F.col("lang") == F.col("s_lang")).where(chosen)
            .drop("s_lang", "s_n", "s_first", "s_stop"), each)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class FTRL:
    """Follow-the-regularised-leader for a multinomial model, one column per class."""

    def __init__(self, slots: int, classes: int) -> None:
        self.z, self.n = np.zeros((slots + 1, classes)), np.zeros((slots + 1, classes))  # last row: bias

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        p = _softmax(x @ w)
        p[y] -= 1.0
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


class Model:
    """Languages, per-slot weights (inverse document frequency included), bias, temperature."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float) -> None:
        self.langs, self.table, self.bias, self.temperature = langs, table, bias, temperature

    def logits(self, slots: np.ndarray) -> np.ndarray:
        step = max(1, (1 << 22) // max(1, len(self.langs)))      # rows of the table at a time
        total = sum(self.table[slots[at:at + step]].sum(0, dtype=np.float64) for at in range(0, len(slots), step))
        return total / len(slots) + self.bias

    def predict(self, text: str | None, letters: np.ndarray) -> tuple[str, float]:
        slots = ngrams(text or "", letters)
        if not len(slots) or not self.langs:
            return UNKNOWN, 1.0
        p = _softmax(self.logits(slots) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def fit(train: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the rows of ``train`` (doc_id, text, lang) whose lang is not null."""
    train = train.where(F.col("lang").isNotNull())
    total, df = document_frequencies(train)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for b in batches:
            found = []
            for h, lang, text in zip(b["h"], b["lang"], _texts(b)):
                slots, counts = np.unique(ngrams(text, letters), return_counts=True)
                if len(slots):
                    found.append((h, lang, slots.astype(np.int32), counts.astype(np.int32)))
            yield pd.DataFrame(found, columns=["h", "lang", "slots", "counts"])

    chosen, each = sample(train, rows)
    rank = Window.partitionBy("lang").orderBy("h", "slots", "counts")
    own = chosen.select(F.xxhash64("doc_id").alias("h"), "lang", "text").mapInPandas(
        run, "h bigint, lang string, slots array<int>, counts array<int>").withColumn(
        "r", F.row_number().over(rank)).where(F.col("r") <= each).toPandas()
    own = own.sort_values(["h", "lang", "r"], kind="stable")
    langs = sorted(own["lang"].unique())
    number = {lang: i for i, lang in enumerate(langs)}
    if not langs:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0)
    examples = [(np.asarray(s), SCALE * np.asarray(c) / np.sum(c) * idf[np.asarray(s)], number[lang])
                for s, c, lang in zip(own["slots"], own["counts"], own["lang"])]
    # each language keeps its first rows, so that holding back leaves no language unlearned
    back = (own["r"] % HELD_BACK == 0).to_numpy() & (len(examples) >= 10 * HELD_BACK)
    held = [e for e, x in zip(examples, back) if x]
    kept = [e for e, x in zip(examples, back) if not x]
    model = FTRL(1 << BITS, len(langs))
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(kept)):
            model.learn(*kept[i])
    table, bias = np.empty((1 << BITS, len(langs)), np.float32), model.weights(np.array([1 << BITS]))[0]
    for lo in range(0, 1 << BITS, 1 << 12):
        own_slots = slice(lo, lo + (1 << 12))
        table[own_slots] = SCALE * idf[own_slots, None] * model.weights(own_slots)
    temperature = 1.0
    if held:
        logits = np.stack([x @ model.weights(at) + bias for at, x, _ in held])
        truth = np.array([y for _, _, y in held])
        # smoothed targets: separable rows would otherwise ask for a temperature of zero
        soft = np.full(logits.shape, 1.0 / (len(truth) + 2) / max(1, len(langs) - 1))
        soft[np.arange(len(truth)), truth] = 1.0 - 1.0 / (len(truth) + 2)
        grid = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
        loss = [-(soft * np.log(np.maximum(_softmax(logits / t), 1e-300))).sum() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
    return Model(langs, table, bias, temperature)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without its text, plus lang_pred and score."""
    own = docs.select("text", *[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "lang_pred", "score")])
    fitted_model = sent(docs.sparkSession, model)  # 2**BITS rows of a float for each language

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, fitted = letter_table(), received(fitted_model)
        for b in batches:
            found = [fitted.predict(text, letters) for text in _texts(b)]
            yield b.drop(columns="text").assign(
                lang_pred=pd.Series([x for x, _ in found], index=b.index, dtype=object),
                score=pd.Series([x for _, x in found], index=b.index, dtype=float))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "text")
    return own.mapInPandas(run, f"{kinds}{', ' if kinds else ''}lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """The contract's fold: documents that teach nothing."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2

"""Toxicity grades by cumulative-link ordinal regression on sparse words.

Grades are ordered: 0 clean, 1 toxic in a text of good quality, 2 toxic in a poor one.
P(grade > k) = logistic(w.x - cut_k): one weight per word serves every threshold, the cuts
increase, and the expected severity is the sum of those probabilities. x holds 1 for each
word of the text that is in the vocabulary.

Vocabulary and weights are learned from a bounded sample of the labelled documents,
`sample` rows at most. Null or wordless text: no word is present,
so it gets the severity of the intercept and is not toxic. Repeated labels of a document
count as one, the most severe; labels that are null are left out. No labels: severity 0.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Words that carry weight; labelled rows that are learned from; L2 penalty.
WORDS, SAMPLE, PENALTY = 2048, 20_000, 1.0
#: Chi-square a word needs: about one chance in ten million, so that few of many words pass by luck.
EVIDENCE = 28.0
PATTERN = re.compile(r"[^\W\d_]+")


def present(text: str | None, index: dict) -> list[int]:
    """Vocabulary numbers of the words in a text."""
    return sorted({index[w] for w in set(PATTERN.findall((text or "").lower())) if w in index})


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, grade) of at most `sample` labelled documents, by a hash of the id.

    The sample is drawn from the labels alone, so its ids, bounded in number, go to the
    documents and no text is shuffled but its own.
    """
    toxic, quality = F.col("toxic"), F.coalesce(F.col("quality"), F.lit(1))
    grade = F.when(toxic == 0, 0).when(quality == 0, 2).otherwise(1)
    marked = labels.where(toxic.isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(grade).alias("grade"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    return found.dropDuplicates(["doc_id"]).select("text", "grade")


def vocabulary(labelled: DataFrame, words: int) -> list[str]:
    """Words whose presence differs most between toxic and clean texts (signed chi-square)."""

    def run(batches):
        seen: dict[str, list[int]] = {}
        rows = [0, 0]
        for batch in batches:
            for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bad = int(grade > 0)
                rows[bad] += 1
                for w in set(PATTERN.findall((text or "").lower())):
                    seen.setdefault(w, [0, 0])[bad] += 1
                if len(seen) > 200_000:
                    yield counts(seen)
                    seen = {}
        seen[""] = rows
        yield counts(seen)

    def counts(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()]), pa.array([v[1] for v in seen.values()])], names=["word", "clean", "toxic"])

    both = labelled.select("text", "grade").mapInArrow(run, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both = both.where("clean + toxic > 2 or word = ''")
    whole = both.where("word = ''").first()
    if whole is None or not whole.clean or not whole.toxic:
        return []
    share = (F.col("clean") + F.col("toxic") + 1) / F.lit(float(whole.clean + whole.toxic + 2))
    gap = F.col("toxic") / F.lit(float(whole.toxic)) - F.col("clean") / F.lit(float(whole.clean))
    # chi-square of the two-by-two table; a word must stand out beyond chance among all words
    odds = whole.clean * whole.toxic / (whole.clean + whole.toxic)
    score = F.lit(float(odds)) * gap * gap / (share * (1 - share) + 1e-9)
    best = both.where("word <> ''").withColumn("score", score).where(F.col("score") > EVIDENCE).orderBy(F.desc("score"), "word").limit(words)
    return [r.word for r in best.select("word").collect()]


def fit(rows: list[list[int]], grade: np.ndarray, size: int, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) of greatest penalised likelihood, by accelerated gradient steps."""
    levels = int(grade.max()) if len(grade) else 0
    if not levels:
        return np.zeros(size), np.zeros(0)
    n = len(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    col = np.fromiter((c for r in rows for c in r), np.int64, len(row))
    share = np.array([(grade > k).mean() for k in range(levels)]).clip(1e-6, 1 - 1e-6)
    # cut_0, then logarithms of the steps between cuts, so that cuts stay in order
    cuts = np.maximum.accumulate(-np.log(share / (1 - share)) + 0.01 * np.arange(levels))
    theta = np.concatenate([np.zeros(size), cuts[:1], np.log(np.diff(cuts).clip(1e-3))])

    def unpack(t):
        return t[:size], t[size] + np.concatenate([[0.0], np.cumsum(np.exp(t[size + 1 :]))])

    def slope(t):
        w, cut = unpack(t)
        z = np.bincount(row, w[col], minlength=n)
        above = 1 / (1 + np.exp(-np.clip(z[:, None] - cut, -40, 40)))
        edge = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        p = (edge[np.arange(n), grade] - edge[np.arange(n), grade + 1]).clip(1e-12)
        steep = edge * (1 - edge)
        up, down = steep[np.arange(n), grade], steep[np.arange(n), grade + 1]
        dz = (up - down) / p
        dcut = np.zeros(levels)
        np.add.at(dcut, grade[grade > 0] - 1, -(up / p)[grade > 0])
        np.add.at(dcut, grade[grade < levels], (down / p)[grade < levels])
        g = np.zeros_like(t)
        g[:size] = np.bincount(col, dz[row], minlength=size) - penalty * w
        g[size] = dcut.sum()
        for k in range(1, levels):
            g[size + k] = np.exp(t[size + k]) * dcut[k:].sum()
        return np.log(p).sum() - penalty / 2 * (w @ w), g

    step, ahead, before, momentum = 4.0 / n, theta, theta, 1.0
    value, _ = slope(theta)
    for _ in range(400):
        here, g = slope(ahead)
        while True:
            new = ahead + step * g
            got, _ = slope(new)
            if got >= here + step / 2 * (g @ g) * 0.5 or step < 1e-12:
                break
            step /= 2
        step *= 1.3
        if got < value:  # the momentum overshot: start it afresh
            momentum, ahead = 1.0, before
            if (g @ g) < 1e-8:
                break
            value = min(value, got)
            continue
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, momentum = new + (momentum - 1) / following * (new - before), following
        if got - value < 1e-7 * abs(value) and got > value:
            before = new
            break
        before, value = new, got
    return unpack(before)


def learn(docs: DataFrame, labels: DataFrame, words: int = WORDS, sample: int = SAMPLE) -> dict:
    """Vocabulary, weights and cuts from the labelled documents."""
    labelled = labelled_sample(docs, labels, sample)
    chosen = vocabulary(labelled, words)
    index = {w: i for i, w in enumerate(chosen)}
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for batch in batches:
            found = [present(t, shared.value) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["grade", "x"])

    rows = labelled.mapInArrow(run, "grade int, x array<int>").collect()
    weights, cuts = fit([r.x for r in rows], np.array([r.grade for r in rows], np.int64), len(index))
    return {"index": index, "weights": weights, "cuts": cuts}


def severity(text: str | None, model: dict) -> tuple[float, float, int]:
    """(expected severity, probability of any toxicity, most likely grade)."""
    if not len(model["cuts"]):
        return 0.0, 0.0, 0
    z = model["weights"][present(text, model["index"])].sum()
    above = 1 / (1 + np.exp(-np.clip(z - model["cuts"], -40, 40)))
    each = np.concatenate([[1.0], above]) - np.concatenate([above, [0.0]])
    return float(above.sum()), float(above[0]), int(each.argmax())


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, severity, p_toxic, grade, toxic) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            found = [severity(t, shared.value) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int32()), pa.array([f[1] >= 0.5 for f in found], pa.bool_())], names=["id", "severity", "p_toxic", "grade", "toxic"])

    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, severity double, p_toxic double, grade int, toxic boolean").withColumnRenamed("id", id_col)


def op2_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score(docs, learn(docs, table(spark, folder, "labels")))

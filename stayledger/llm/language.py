"""Language identification by rank-order n-gram profiles.

A profile lists a language's most frequent 1- to 3-grams by rank. A text's own list is
compared with every profile: each n-gram costs the difference of its two ranks, an n-gram
the profile lacks costs the whole list length, and the language of the least sum wins.
Letters are lower-cased; anything that is no letter is one word boundary. Every letter of
every script counts as itself: n-grams of the most frequent letters are counted in a dense
table, those that hold any other letter by their code points.

Null text, or one without a letter: `und`, score 0. Equal distances go to the language
with more training text, then to the name that sorts first. Nothing to learn from: every
text is `und`. Only the id and the text are read for a prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Letters with n-grams in the dense table (the most frequent in training); ranks kept.
LETTERS, KEEP = 62, 400
#: Codes: 0 boundary, 1..62 letters, any other letter 63 and its code point. Dense places of
#: 1-, 2- and 3-grams; places of n-grams with another letter hold three codes of 21 bits,
#: where short n-grams begin with a number that is no code.
ONE, TWO, PLACES = 1 << 18, (1 << 18) + (1 << 12), (1 << 18) + (1 << 12) + (1 << 6)
SHORT = (1_200_000, 1_200_001)
SLAB = 1 << 21


def letter_table() -> np.ndarray:
    """True for the code points that are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def points(text: str | None) -> np.ndarray:
    """The code points of a text in lower case."""
    return np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def encode(text: str | None, codes: np.ndarray) -> np.ndarray:
    """Letter codes with one boundary around each word; empty without a letter."""
    found = points(text)
    out = codes[found].astype(np.int32)
    if not out.any():
        return out[:0]
    out = np.concatenate([[0], np.where(out > LETTERS, out + found.astype(np.int32), out), [0]]).astype(np.int32)
    keep = np.append(True, (out[1:] != 0) | (out[:-1] != 0))
    return out[keep]


def gram_counts(coded: np.ndarray) -> np.ndarray:
    """How often each dense place occurs; n-grams may begin or end at a boundary only."""
    total = np.zeros(PLACES, np.int64)
    for at in range(0, len(coded), SLAB):
        part = coded[at : at + SLAB + 2]
        here = part[: SLAB]
        two = (part[:-1] << 6 | part[1:])[: SLAB]
        three = part[:-2] << 12 | part[1:-1] << 6 | part[2:]
        in_three, good = part[1:-1] != 0, part <= LETTERS
        if not good.all():
            in_three = in_three & good[:-2] & good[1:-1] & good[2:]
            two, here = two[(good[:-1] & good[1:])[: SLAB]], here[good[: SLAB]]
        total[:ONE] += np.bincount(three[in_three][: SLAB], minlength=ONE)
        total[ONE:TWO] += np.bincount(two, minlength=TWO - ONE)
        total[TWO:] += np.bincount(here, minlength=PLACES - TWO)
    total[TWO] = 0  # a boundary alone says nothing
    return total


def other_counts(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of the n-grams that hold a letter outside the dense table."""
    if not (coded > LETTERS).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = []
    for at in range(0, len(coded), SLAB):
        part = coded[at : at + SLAB + 2].astype(np.int64)
        other = part > LETTERS
        two = (SHORT[0] << 42 | part[:-1] << 21 | part[1:])[:SLAB][(other[:-1] | other[1:])[:SLAB]]
        three = (part[:-2] << 42 | part[1:-1] << 21 | part[2:])[(part[1:-1] != 0) & (other[:-2] | other[1:-1] | other[2:])]
        found += [SHORT[1] << 42 | part[:SLAB][other[:SLAB]], two, three]
    return np.unique(np.concatenate(found), return_counts=True)


def top_places(seen: np.ndarray, n: np.ndarray, keep: int) -> np.ndarray:
    """The places of the most frequent n-grams, most frequent first, ties by place."""
    if len(seen) > 4 * keep:
        least = np.partition(n, len(n) - keep)[len(n) - keep]
        seen, n = seen[n >= least], n[n >= least]
    return seen[np.lexsort((seen, -n))][:keep]


def alphabet(train: DataFrame) -> np.ndarray:
    """Code per code point, from the letters' frequency in training; 63 for other letters."""

    def run(batches):
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                p = points(text)
                if len(p):
                    total[: int(p.max()) + 1] += np.bincount(p)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["point", "n"])

    counted = train.select("text").mapInArrow(run, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
    letters = letter_table()
    seen = sorted(((-r.n, r.point) for r in counted.collect() if letters[r.point]))  # at most one row per code point
    codes = np.where(letters, LETTERS + 1, 0).astype(np.uint8)
    for k, (_, point) in enumerate(seen[:LETTERS]):
        codes[point] = k + 1
    return codes


def learn(train: DataFrame, keep: int = KEEP) -> dict:
    """Profiles from (text, lang) rows: counts of all of them, summed by language."""
    codes = alphabet(train)
    shared = train.sparkSession.sparkContext.broadcast(codes)

    def batch_of(lang, place, n):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(place), pa.string()), pa.array(place, pa.int64()), pa.array(n, pa.int64())], names=["lang", "place", "n"])

    def run(batches):
        codes, total = shared.value, {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = total.setdefault(lang, [np.zeros(PLACES, np.int64), [], 0])
                coded = encode(text, codes)
                parts[1].append(coded)
                parts[2] += len(coded)
                if parts[2] > SLAB:
                    whole = np.concatenate(parts[1])
                    parts[0] += gram_counts(whole)
                    parts[1:] = [[], 0]
                    # n-grams without bound on their number are not held
                    yield batch_of(lang, *other_counts(whole))
        for lang, (count, rest, _) in total.items():
            if rest:
                whole = np.concatenate(rest)
                count += gram_counts(whole)
                yield batch_of(lang, *other_counts(whole))
            place = np.flatnonzero(count)
            yield batch_of(lang, place, count[place])

    counted = train.select("text", "lang").mapInArrow(run, "lang string, place long, n long")
    summed = counted.groupBy("lang", "place").agg(F.sum("n").alias("n"))
    best = summed.withColumn("rank", F.row_number().over(_order())).where(F.col("rank") <= keep).collect()
    sizes: dict[str, int] = {}
    for r in best:
        sizes[r.lang] = sizes.get(r.lang, 0) + r.n
    langs = sorted(sizes, key=lambda name: (-sizes[name], name))
    # of the places outside the dense table, those in a profile
    others = np.array(sorted({r.place for r in best if r.place >= PLACES}), np.int64)
    ranks = np.full((len(langs), PLACES + len(others)), keep, np.int16)
    for r in best:
        ranks[langs.index(r.lang), r.place if r.place < PLACES else PLACES + int(np.searchsorted(others, r.place))] = r.rank - 1
    return {"codes": codes, "langs": langs, "ranks": ranks, "others": others, "keep": keep}


def _order():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy(F.desc("n"), "place")


def judge(text: str | None, model: dict) -> tuple[str, float]:
    """(language, score): 1 when the ranks agree, 0 when no n-gram is in the profile."""
    coded = encode(text, model["codes"])
    if not len(coded) or not model["langs"]:
        return "und", 0.0
    count = gram_counts(coded)
    seen = np.flatnonzero(count)
    place, n = other_counts(coded)
    mine = top_places(np.concatenate([seen, place]), np.concatenate([count[seen], n]), model["keep"])
    ranks = np.full((len(model["langs"]), len(mine)), model["keep"], np.int64)
    dense = mine < PLACES
    ranks[:, dense] = model["ranks"][:, mine[dense]]
    if len(model["others"]) and not dense.all():
        at = np.minimum(np.searchsorted(model["others"], mine), len(model["others"]) - 1)
        known = model["others"][at] == mine
        ranks[:, known] = model["ranks"][:, PLACES + at[known]]
    cost = np.where(ranks == model["keep"], model["keep"], np.abs(ranks - np.arange(len(mine)))).sum(axis=1)
    best = int(cost.argmin())
    return model["langs"][best], float(1 - cost[best] / (model["keep"] * len(mine)))


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        model = shared.value
        for batch in batches:
            found = [judge(text, model) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["id", "lang_pred", "score"])

    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str):
    """The fold that is not learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on(docs: DataFrame) -> dict:
    """Profiles from the documents outside the held-out fold that name a language."""
    return learn(docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")).select("text", "lang"))


def op1_language_id(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = identify(docs, train_on(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")

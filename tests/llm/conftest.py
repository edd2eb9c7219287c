import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tk1 long, h long, fp string, id string"


def corpus():
    """Small texts with nulls, empties, repeats, copies and a very long one."""
    rng = random.Random(3)
    words = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "λ", "mu2"]
    texts = [None, "", " \n ", "one", "one", "...", "Σίσυφος 'LL don't", "a" * 2000]
    for _ in range(30):
        texts.append(" ".join(rng.choices(words, k=rng.randint(1, 200))))
    shared = " ".join(rng.choices(words, k=120))
    texts += [f"{t[:200]} {shared} {t[-150:]}" for t in texts[10:20]]
    texts += [texts[12], texts[12], texts[14] + " tail"]
    texts.append("\n".join(texts[8:30]) * 20)
    rows = [(i, t, ("en", "de", None)[i % 3], f"s{i % 12}" if i % 7 else None, 0, 1, 2, "x", "y") for i, t in enumerate(texts)]
    rows.append((None, "one", "en", "s1", 0, 1, 2, "x", "y"))
    rows.append(rows[20])
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

"""Near-duplicates, top-k search and the pipeline against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stayledger.llm import simhash, topk
from stayledger.llm.common import Workspace, components, spanning_edges


def roots(n, pairs):
    """Least reachable number of each of 0..n-1."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(50, 50)]
    edges = spark.createDataFrame([(b, a) for a, b in pairs], "a long, b long")
    got = {r.node: r.root for r in components(edges, Workspace(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_spanning_edges():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 60, 50), rng.integers(0, 60, 50)
    node, root = spanning_edges(a, b)
    assert roots(60, list(zip(a.tolist(), b.tolist(), strict=True))) == roots(60, list(zip(node.tolist(), root.tolist(), strict=True)))


def test_allocation_is_cheapest():
    rng = np.random.default_rng(1)
    costs = [{t: rng.random(20) * (t + 2) for t in (-1, 0, 1, 2)} for _ in range(4)]
    got = simhash.allocate(costs, 1)
    assert (got.sum(axis=1) == 1).all()
    every = [(a, b, c, 1 - a - b - c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if -1 <= 1 - a - b - c <= 2]
    for i in range(20):
        mine = sum(costs[p][int(got[i, p])][i] for p in range(4))
        assert mine == pytest.approx(min(sum(costs[p][t][i] for p, t in enumerate(x)) for x in every))


@pytest.mark.parametrize(("parts", "block", "radius"), [(2, 4096, 4), (3, 4096, 4), (4, 8, 4), (4, 4096, 6), (5, 4, 4)])
def test_links_lose_nothing(spark, monkeypatch, parts, block, radius):
    rng = np.random.default_rng(parts)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = list(seeds)
    for s in seeds:
        for _ in range(12):
            bits = rng.choice(64, rng.integers(0, 7), replace=False)
            fps.append(s ^ np.uint64(sum(1 << int(b) for b in bits)))
    fps = np.unique(np.array([*fps, np.uint64(0)], np.uint64))
    monkeypatch.setattr(simhash, "choose_parts", lambda count, r: parts)
    monkeypatch.setattr(simhash, "BLOCK", block)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    edges = simhash.near_edges(df, radius, len(fps)).collect()
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    near = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= radius]
    assert roots(len(fps), near) == roots(len(fps), [(place[e.a], place[e.b]) for e in edges])


def slow_fingerprint(text):
    import xxhash

    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates_match_brute_force(docs, rows, no_docs):
    fps = [slow_fingerprint(r[1]) for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    label = roots(len(rows), near)
    least: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[label[i]] = min(least.get(label[i], r[0]), r[0])
    want = Counter((r[0], f"{fps[i]:016x}", least[label[i]]) for i, r in enumerate(rows))
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def brute_top(rows, k, scale=1024.0):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            good.setdefault(i, []).append([int(np.floor(scale * x)) for x in v])
    out = set()
    for q in good:
        if q % 100 == 0:
            score = {i: max(sum(a * b for a, b in zip(x, y)) for x in good[q] for y in ys) for i, ys in good.items() if i != q}
            for rank, (i, s) in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k]):
                out.add((q, rank + 1, i, s))
    return out


@pytest.mark.parametrize(("cell", "block"), [(8192, 1024), (50, 2)])
def test_top_k_matches_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(topk, "CELL", cell)
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=30) * rng.random()).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # ties
    rows += [(2000, None), (None, rows[0][1]), (2100, []), (2200, [None, 1.0]), (2300, [float("nan")] * 30), (2400, [float("inf")] * 30), (2500, [1.0, -2.0]), rows[7], (7, rows[8][1]), (2600, [1e30] * 3)]
    vectors = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, norm int").repartition(5)
    got = topk.top_k(vectors, lambda c: F.col(c) % 100 == 0).collect()
    assert {tuple(r) for r in got} == brute_top([r for r in rows if r[0] != 2600], 10) and len(got) == len({tuple(r) for r in got})
    assert topk.top_k(vectors.limit(0), lambda c: F.col(c) % 100 == 0).count() == 0


def test_pipeline_stages(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    whole = docs.count()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, source)
        if name != "bpe":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.count()
        if name == "simhash_near_dedup":
            rows = [r.text for r in before.select("text").collect()]
            fps = [slow_fingerprint(t) for t in rows]
            near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
            assert kept[name] == len(set(roots(len(fps), near))) < len(fps)
    assert kept["language_id"] == kept["line_dedup"] == whole
    assert kept["benchmark_decontamination"] < kept["simhash_near_dedup"] and kept["bpe"] == kept["benchmark_decontamination"]
    assert corpus_pipeline.run(spark, source).count() == kept["bpe"]


def test_pipeline_stages_take_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "...", "en", "a", 3), (4, "some plain text", None, "a", 15), (4, "some plain text", None, "a", 15), (5, "text " * 9000, "en", None, 1)]
    for rows in (odd, []):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, spark.createDataFrame(rows, schema), "/root/testdata/sf0.001").count()


def test_pipeline_stages_keep_clashing_columns(spark):
    """Columns named like a stage's own pass through every stage but the last."""
    names = ["row", "key", "id", "k1", "k2", "h1", "h2", "bad", "stay", "node", "hits", "_key", "_k1", "_lines", "_removed", "n_lines", "n_removed", "component_id"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} long" for n in names)
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t), *(100 * k + i for i in range(len(names)))) for k, t in enumerate([*texts, texts[0]])], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
    got = sorted(tuple(r) for r in docs.collect())
    assert got == [(k, t, "en", "a", len(t), *(100 * k + i for i in range(len(names)))) for k, t in enumerate(texts)]


def test_near_duplicate_stage_keeps_null_and_repeated_ids(spark):
    one, two, three = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    rows = [(None, one), (None, two), (7, two), (8, three), (8, f"{three} end"), (9, "nine " * 3), (9, "other words"), (9, "other words"), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").select("doc_id", "text").collect())
    assert kept.total() == 6 and all(kept[k] == 1 for k in [(None, one), (7, two), (9, "nine " * 3), (9, "other words")])
    assert kept[8, three] + kept[8, f"{three} end"] == 1 and kept[None, None] + kept[None, ""] == 1

"""Embedding near-duplicates, hard negatives and spelling variants against brute force."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayledger.llm import embed_dedup, hard_negatives, spelling
from stayledger.llm.common import attach

VECTORS = "vec_id long, embedding array<double>, label int, node long, vec string, id string, row long"


def vector_table(spark, rows):
    """rows are (vec_id, embedding, label); further columns bear names the operators use."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], VECTORS).repartition(3)


def odd_vectors(width=6):
    nan, inf = float("nan"), float("inf")
    unit = [1.0] + [0.0] * (width - 1)
    return [(900, None, 1), (901, [], 1), (902, [0.0] * width, 1), (903, [nan] * width, 1), (904, [inf, *unit[1:]], 1), (905, [None, *unit[1:]], 1),
            (None, unit, 1), (906, unit, 1), (906, unit, 1), (907, [3.5], 1), (908, [1e200] + [1e190] * (width - 1), 1), (909, [2e-310, *unit[1:]], 1)]


# --- embedding near-duplicates ---------------------------------------------------------


def slow_links(rows, threshold):
    width = max((len(r[1]) for r in rows if r[1]), default=1)

    def unit(v):
        if not v or None in v or not np.isfinite(v).all() or not any(v):
            return None
        x = np.zeros(width)
        x[: len(v)] = v
        x = x / np.abs(x).max()
        return x / np.sqrt(x @ x)

    units = [unit(r[1]) for r in rows]
    near = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if units[i] is not None and units[j] is not None and units[i] @ units[j] >= threshold]
    label = list(range(len(rows)))
    for _ in range(len(rows)):
        before = list(label)
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    count = Counter(itertools.chain.from_iterable(near))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[label[i]] = min(least.get(label[i], r[0]), r[0])
    return Counter((r[0], count[i], least.get(label[i]), r[0] is not None and r[0] == least.get(label[i])) for i, r in enumerate(rows))


def crowded(rng, width, n):
    """Groups whose pairs lie on both sides of 0.9, exact copies and lone vectors."""
    rows = []
    for g in range(6):
        centre = rng.normal(size=width)
        centre /= np.linalg.norm(centre)
        for _ in range(n):
            other = rng.normal(size=width)
            other /= np.linalg.norm(other)
            rows.append(centre + other * rng.uniform(0.1, 0.5))
    rows += [rows[0] * s for s in (1, 1, 1, 2.5, 1e-3)] * 4
    rows += list(rng.normal(size=(40, width)))
    return [(int(i), [float(x) for x in v], int(i) % 3) for i, v in zip(rng.permutation(len(rows)) * 3 + 1, rows, strict=True)]


@pytest.mark.parametrize(("width", "cell", "tile", "product", "threshold"), [(6, 4096, 32768, 1 << 23, 0.9), (6, 20, 16, 100, 0.9), (24, 30, 50, 1000, 0.9), (5, 16, 8, 64, -0.2)])
def test_near_vectors_match_brute_force(spark, monkeypatch, width, cell, tile, product, threshold):
    monkeypatch.setattr(embed_dedup, "CELL", cell)
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    monkeypatch.setattr(embed_dedup, "PRODUCT", product)
    rows = crowded(np.random.default_rng(width), width, 18 if threshold > 0 else 6) + odd_vectors(width)
    got = embed_dedup.near_vectors(vector_table(spark, rows), threshold=threshold)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(tuple(r) for r in got.collect()) == slow_links(rows, threshold)


def test_near_vectors_of_floats_and_of_nothing(spark):
    few = spark.createDataFrame([(1, [0.25, 0.5]), (2, [0.25, 0.5]), (3, [0.5, -0.25])], "vec_id int, embedding array<float>")
    assert sorted(tuple(r) for r in embed_dedup.near_vectors(few).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert embed_dedup.near_vectors(few.where("vec_id < 0")).count() == 0
    none = spark.createDataFrame([(5, None)], "vec_id int, embedding array<float>")
    assert [tuple(r) for r in embed_dedup.near_vectors(none).collect()] == [(5, 0, 5, True)]


@pytest.mark.parametrize("width", [1, 7, 64, 1500])
def test_bounds_hold_every_cosine(width):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(60, width)) * rng.uniform(0.01, 5, size=(60, 1)) ** rng.integers(1, 4, size=(60, 1))
    x[::7, 1:] *= 1e-4
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    codes = embed_dedup.Codes.of(unit)
    whole = codes.code.astype(np.int64)
    value = np.outer(codes.scale, codes.scale) * (whole @ whole.T)
    bound = codes.miss[:, None] + np.outer(codes.size, codes.miss) + 1e-12
    assert (np.abs(unit @ unit.T - value) <= bound).all()
    rounding = np.abs(codes.single() @ codes.single().T - value)
    assert rounding.max() <= (width + 8) * 2.0**-22


def test_cells_lose_no_link():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    cells = embed_dedup.Cells(x[::15], 0.9)
    cell, angle = cells.nearest(x)
    radius = np.array([angle[cell == c].max(initial=-10) for c in range(40)])
    reach = cells.reach(x, cell, radius)
    i, j = np.nonzero(x @ x.T >= 0.9)
    apart = cell[i] < cell[j]
    assert apart.any() and reach[i[apart], cell[j[apart]]].all()
    assert not reach[np.arange(len(x)), cell].any() and reach.mean() < 0.25  # far cells are left out


def test_window_pairs_alone_are_computed_again(spark, tmp_path):
    """Sure links need no second pass; only vectors of open pairs travel again."""
    base = np.eye(8)[:2]
    rows = [(i, [float(x) for x in base[i % 2] + 0.001 * (i // 2) * base[1 - i % 2]], 0) for i in range(20)]
    seen = []
    plain = embed_dedup.tile_links

    def watch(given, threshold, dtype, width, full):
        if full:
            seen.append(given.count())
        return plain(given, threshold, dtype, width, full)

    embed_dedup.tile_links, kept = watch, plain
    try:
        got = embed_dedup.near_vectors(vector_table(spark, rows)).collect()
    finally:
        embed_dedup.tile_links = kept
    assert seen == [0] and {r.n_links for r in got} == {9}


def test_attach_joins_hot_and_cold_keys(spark):
    rows = spark.range(6000).select(F.when(F.col("id") < 4000, 1).when(F.col("id") < 5990, F.col("id")).alias("k"), "id").repartition(3)
    facts = spark.createDataFrame([(1, "hot"), (4001, "cold")], "k long, fact string")
    got = Counter(r.fact for r in attach(rows, facts, ["k"]).collect())
    assert got == {"hot": 4000, "cold": 1, None: 1999}


# --- hard negatives ----------------------------------------------------------------------


def slow_negatives(rows, every=50, positives=5, negatives=3):
    ok = [(i, r[0], r[2], [int(np.floor(256 * np.float64(x))) for x in r[1]]) for i, r in enumerate(rows) if r[2] is not None and r[1] and None not in r[1] and np.isfinite([256 * np.float64(x) for x in r[1]]).all()]
    out = Counter()
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    for i, anchor, label, v in ok:
        if anchor is None or anchor % every:
            continue
        score = [(max(-(2**62), min(2**62, sum(a * b for a, b in zip(v, w, strict=False)))), other, j, kind) for j, other, kind, w in ok if j != i]
        for p in sorted((s for s in score if s[3] == label), key=order)[:positives]:
            found = sorted((s for s in score if s[3] != label and 50 * p[0] <= 100 * s[0] <= 95 * p[0]), key=order)[:negatives]
            for rank, n in enumerate(found, 1):
                out[anchor, p[1], rank, n[1], p[0], n[0]] += 1
    return out


def labelled(rng, width, n):
    centres = rng.normal(size=(4, width))
    rows = []
    for i in range(n):
        v = centres[i % 4] * rng.uniform(0.2, 1) + rng.normal(size=width) * 0.4
        rows.append((i * 5, [float(x) for x in v], int(rng.integers(0, 3))))
    for i in range(30):  # ties and copies, across labels
        rows.append((10000 + i, rows[10][1], i % 2))
    rows += [(50, rows[10][1], 0), (50, rows[11][1], 1), (None, rows[10][1], 0), (None, rows[10][1], 1), (7001, rows[3][1], None)]
    return rows


@pytest.mark.parametrize("settings", [{}, {"BLOCK": 4, "CHUNK": 40, "HELD": 200, "SEED": 3, "WORK": 100, "ENTRIES": 64}])
def test_hard_negatives_match_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = labelled(np.random.default_rng(4), 6, 200) + odd_vectors()
    rows = [(i, v, k) for i, v, k in rows if i not in (906, 907, 908)] + [(907, [0.5], 1), (950, [0.5, 0.25], 0)]
    got = hard_negatives.hard_negatives(vector_table(spark, rows), lambda c: F.col(c) % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(r) for r in got.collect()) == slow_negatives(rows)


def test_hard_negatives_of_very_long_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i * 25, [float(x) for x in rng.normal(size=3) * 10.0 ** (i % 5 * 3)], i % 2) for i in range(60)] + [(50, [1e300, 1e300, -1e290], 1), (1, [1e306] * 3, 0)]
    got = hard_negatives.hard_negatives(vector_table(spark, rows), lambda c: F.col(c) % 50 == 0)
    assert Counter(tuple(r) for r in got.collect()) == slow_negatives(rows)


def test_hard_negatives_without_anchors_or_rows(spark):
    one = vector_table(spark, [(1, [1.0, 2.0], 0), (50, [1.0, 2.0], None)])
    for given in (one, one.limit(0)):
        assert hard_negatives.hard_negatives(given, lambda c: F.col(c) % 50 == 0).count() == 0
    words = spark.createDataFrame([(50, [1.0], "a"), (51, [1.0], "a"), (52, [0.75], "b")], "vec_id long, embedding array<float>, label string")
    assert [tuple(r) for r in hard_negatives.hard_negatives(words, lambda c: F.col(c) % 50 == 0).collect()] == [(50, 51, 1, 52, 256 * 256, 192 * 256)]


def test_spanning_tree_is_minimal():
    vec = np.random.default_rng(3).integers(-20, 20, size=(40, 3)).astype(float)
    order, parent, level, edge = hard_negatives.spanning_tree(vec)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and (level[1:] == level[parent[1:]] + 1).all() and (np.diff(level) >= 0).all()
    gap = np.sqrt(((vec[:, None] - vec[None]) ** 2).sum(axis=2))
    assert edge[1:] == pytest.approx(gap[order[1:], order[parent[1:]]])
    inside, total = {0}, 0.0  # Prim's own sum
    while len(inside) < 40:
        near = {j: min(gap[i, j] for i in inside) for j in range(40) if j not in inside}
        k = min(near, key=near.get)
        total += near[k]
        inside.add(k)
    assert edge.sum() == pytest.approx(total)


def test_tree_bounds_leave_out_most_rows(monkeypatch):
    """Anchors close together: hardly a row outside their windows is scored for a child."""
    rng = np.random.default_rng(6)
    rows = np.round(rng.normal(size=(3000, 16)) * 100)
    anchors = np.round(rows[0] * 3 + rng.normal(size=(30, 16)))
    order, parent, level, edge = hard_negatives.spanning_tree(anchors)
    code = lambda x: [b"\x08" + v.astype("<f8").tobytes() for v in x]
    norm = lambda x: np.sqrt((x**2).sum(axis=1))
    at = np.arange(3000)
    held = hard_negatives.Held(pa.RecordBatch.from_pydict({"row": at, "id": at, "label": at % 2, "norm": norm(rows), "vec": code(rows)}), 16)
    ask = anchors[order]
    block = hard_negatives.Block(pa.RecordBatch.from_pydict({"row": 10000 + np.arange(30), "label": np.zeros(30, np.int64), "vec": code(ask), "norm": norm(ask), "parent": parent, "level": level, "edge": edge, "lows": [[-hard_negatives.TOP]] * 30, "highs": [[hard_negatives.TOP]] * 30}), 16, 5)
    count = []
    dense, pairs = hard_negatives.scores, hard_negatives.pair_scores
    monkeypatch.setattr(hard_negatives, "scores", lambda a, b, top: count.append(len(a) * len(b)) or dense(a, b, top))
    monkeypatch.setattr(hard_negatives, "pair_scores", lambda a, b, top: count.append(len(a)) or pairs(a, b, top))
    got = held.answer(block, True).to_pydict()
    every = ask @ rows[::2].T
    assert sorted(got["score"]) == sorted(np.sort(every, axis=1)[:, -5:].ravel().astype(int).tolist())
    assert sum(count) < 0.35 * every.size


# --- spelling variants ---------------------------------------------------------------------


def slow_words(rows):
    count = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(rows):
    words = slow_words(rows)
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(12)
    letters = list("abcdéß")
    base = ["".join(rng.choice(letters, rng.integers(6, 12))) for _ in range(25)] + ["a" * k for k in range(5, 15)] + ["abcabc", "xyzxyzxyz" * 40]
    words = Counter()
    for k, w in enumerate(base):
        words[w] += 5 if k % 3 else 400
        for _ in range(12):
            i, c, kind = int(rng.integers(0, len(w) + 1)), rng.choice(letters), rng.integers(0, 3)
            v = w[:i] + c + w[i + (kind == 0) :] if kind < 2 else w[:i] + w[i + 1 :]
            words[v] += int(rng.integers(5, 60))
            words[v[: len(v) // 2] + c + v[len(v) // 2 :]] += int(rng.integers(5, 12))
    flat = [w.upper() if i % 11 == 0 else w for i, w in enumerate(itertools.chain.from_iterable([w] * n for w, n in words.items()))]
    flat = [flat[i] for i in rng.permutation(len(flat))]
    rows = [(k, " ".join(flat[k::40]) + ",x2y-Ω") for k in range(40)]
    return [*rows, (None, rows[0][1]), (3, rows[3][1]), (41, None), (42, ""), (43, "short"), (44, "\n".join(r[1] for r in rows))]


@pytest.mark.parametrize(("lists", "slab"), [(16384, 1 << 22), (3, 500)])
def test_spelling_variants_match_brute_force(spark, monkeypatch, texts, lists, slab):
    monkeypatch.setattr(spelling, "LIST", lists)
    monkeypatch.setattr(spelling, "SLAB", slab)
    monkeypatch.setattr(spelling, "FRONT", 300)
    docs = spark.createDataFrame([(*r, "w", 1, "n") for r in texts], "doc_id long, text string, word string, n int, run string").repartition(3)
    got = spelling.variant_groups(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = slow_variants(texts)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert sum(1 for r in want if r[1]) > 20 and any(r[2] != r[1] for r in want if r[1])
    assert spelling.variant_groups(docs.limit(0)).count() == 0


def test_band_rows_are_edit_distances():
    rng = np.random.default_rng(1)
    for _ in range(300):
        q, v = (" " + "".join(rng.choice(list("ab"), 7)) for _ in range(2))
        row = spelling.STEPS[0, 0] * 0 + 2 * 9 + 0 * 3 + 1  # nothing read yet: no letter p - 1
        full = [[i + j if not i * j else 0 for j in range(8)] for i in range(8)]
        for i in range(1, 8):
            for j in range(1, 8):
                full[i][j] = min(full[i - 1][j] + 1, full[i][j - 1] + 1, full[i - 1][j - 1] + (v[i] != q[j]))
        for p in range(7):
            equal = (p > 0 and q[p] == v[p + 1]) | (q[p + 1] == v[p + 1]) << 1 | (p + 2 < 8 and q[p + 2 : p + 3] == v[p + 1]) << 2
            row = spelling.STEPS[row, equal]
            cells = [min(2, full[p + 1][j]) if 0 <= j < 8 else None for j in (p, p + 1, p + 2)]
            assert all(c is None or c == got for c, got in zip(cells, spelling.CELL[row].tolist(), strict=True))


def test_ranges_past_one_edit_are_skipped(monkeypatch):
    """A range of words behind a dead prefix is never entered."""
    words = sorted("prefix" + "".join(x) for x in itertools.product("abcd", repeat=4))
    listed, asked = spelling.letters(words, 11), spelling.letters([words[0]], 11)
    steps = []
    plain = spelling.STEPS

    class Watch:
        def __getitem__(self, at):
            steps.append(len(at[0]))
            return plain[at]

    monkeypatch.setattr(spelling, "STEPS", Watch())
    q, a = spelling.near_pairs(asked, listed, np.array([0]), np.array([0]), 6, 10)
    assert sorted(words[i] for i in a) == sorted(w for w in words if one_apart(w, words[0]))
    assert sum(steps) < 110  # 596 rows without skipping

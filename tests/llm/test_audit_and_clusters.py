"""The source divergence audit and the centroid clustering against plain Python, odd rows included."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tollgate.llm import divergence, vafile

WORDS = [f"{a}{b}" for a in ("ka", "Lo", "mé", "тu", "n") for b in ("ra", "si", "TO", "vü", "x", "yy", "zé")]


def plain_audit(docs, least, scale, add, top):
    """The contract, term by term."""
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang, source].update(words)
        held[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, n in held[lang].items() if n >= least]
        own = [g for g in groups if g[0] == lang]

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + scale * (c[t] + add) // (total + add * len(kept)) for t in kept}

        p = shares(counts[lang, source])
        pairs = []
        for other in own:
            if other[1] != source:
                q = shares(counts[other])
                pairs.append((-sum(abs(p[t] - q[t]) for t in kept), other[1].encode()))
        q = shares(sum((counts[g] for g in own), Counter()))
        terms = [(q[t] - p[t], t.encode()) for t in kept if counts[lang, source][t] > 0 and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            out += [(lang, source, part, i.decode(), -v, k) for k, (v, i) in enumerate(sorted(found)[:most], 1)]
    return out


def texts(seed, n, languages=3, sources=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        k = int(rng.integers(sources)) if i % 3 else 0  # a third of one source
        words = rng.choice(WORDS, int(rng.integers(1, 30)), p=np.roll(np.arange(1, len(WORDS) + 1) / sum(range(len(WORDS) + 1)), k * 3))
        rows.append((" ".join(words) + " , 12!", f"l{i % languages}" if i % 7 else None, f"s{k}" if k else None))
    return rows


ODD = [(None, "l0", "s1"), ("", "l0", "empty"), ("1 2 _ [ `", "odd", "only"), ("ka", "odd", "other"), ("x" * 100_000, "l1", "s2"), ("ka " * 50_000, "l1", "s2")]


@pytest.mark.parametrize("block, tile, piece", [(1024, 96, 1 << 20), (4, 2, 64)])
def test_audit_against_plain_python(spark, monkeypatch, block, tile, piece):
    for name, value in (("BLOCK", block), ("TILE", tile), ("PIECE", piece), ("ENTRIES", 50)):
        monkeypatch.setattr(divergence, name, value)
    docs = texts(1, 240) + ODD
    rows = [(*d, 1, "x", 3) for d in docs]
    frame = spark.createDataFrame(rows, "text string, lang string, source string, n long, who string, p int").repartition(4)
    got = divergence.audit(frame, least_docs=10, scale=10**9, add=5, top=6)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_audit(docs, 10, 10**9, 5, 6))


def test_audit_of_equal_sources_is_zero_and_ranks_by_name(spark):
    docs = [("ka ra si", "l", s) for s in ("b", "a", "é", "Z") for _ in range(3)]
    got = divergence.audit(spark.createDataFrame(docs, "text string, lang string, source string"), least_docs=2).collect()
    pairs = {r["source"]: [(x["rank"], x["item"], x["value"]) for x in sorted(got, key=lambda x: x["rank"]) if x["source"] == r["source"]] for r in got}
    assert pairs["a"] == [(1, "Z", 0), (2, "b", 0), (3, "é", 0)] and not [r for r in got if r["part"] == "term"]


def test_audit_without_kept_terms_or_rows(spark):
    docs = spark.createDataFrame([("ka", "l", "a"), (None, "l", "b")], "text string, lang string, source string")
    got = divergence.audit(docs).collect()
    assert sorted(map(tuple, got)) == [("l", "a", "pair", "b", 0, 1), ("l", "b", "pair", "a", 0, 1)]
    assert divergence.audit(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB zÉé-1\n", max_size=40), max_size=4), st.integers(1, 20))
def test_terms_do_not_depend_on_pieces(parts, piece):
    text, whole = "".join(parts).encode(), divergence.PIECE
    try:
        divergence.PIECE = piece
        got = [t for some in divergence.terms(text) for t in some]
    finally:
        divergence.PIECE = whole
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text.decode())
    assert got == [t.encode() for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)]


def test_joint_cells_are_those_of_plain_sets():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 2**63, (n, 3), dtype=np.uint64) for n in (7, 5))
    sets = [[{k for k in range(192) if int(row[k // 64]) >> (k % 64) & 1} for row in m] for m in (a, b)]
    assert divergence.joint(a, b).tolist() == [[len(x & y) for y in sets[1]] for x in sets[0]]


# ---------------------------------------------------------------- clusters


def plain_clusters(rows, k, rounds, dims):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(x)) for x in v], [float(x) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[2]))
    centroids = [v for _, v, _ in order[:k]]

    def place(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v, _ in kept:
            members[place(v)[1]].append(v)
        centroids = [[sum(x) // len(members[j]) for x in zip(*members[j], strict=True)] if members[j] else c for j, c in enumerate(centroids)]
    placed = [(i, *place(v)) for i, v, _ in kept]
    inertia = Counter()
    for _, d, j in placed:
        inertia[j] += d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, inertia[j], sum(inertia.values()), shas[j]) for i, d, j in placed]


def vectors(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    x = (centres[rng.integers(6, size=n)] + spread * rng.normal(size=(n, dims))).astype(np.float32)
    x[n // 3 : 2 * n // 3] = x[0]  # one vector for a third of the rows
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("dims, spread", [(64, 0.05), (64, 1.0), (5, 0.3)])
def test_clusters_against_plain_python(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(vafile, "BLOCK", 37)
    odd = [None, [], [0.5] * (dims - 1), [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1), [None] + [1.0] * (dims - 1)]
    rows = vectors(7, 300, dims, spread) + [(1000 + i, v) for i, v in enumerate(odd)] + [(None, [0.25] * dims), (5, [-0.75] * dims)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, cluster int, d int")
    got, found = vafile.cluster(frame.repartition(3), dims=dims)
    want = plain_clusters(rows, 8, 10, dims)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert found.vectors == 302 and all(0 <= n <= 302 for n in found.fetched)


def test_intervals_hold_the_distance_and_decide_only_what_is_sure():
    rng = np.random.default_rng(8)
    for dims in (64, 7):
        x = rng.integers(-500, 500, (400, dims))
        x[:50] = x[0]
        cells = vafile.Cells.learn(x.min(axis=0), x.max(axis=0), x[::9].astype(float))
        centroids = np.concatenate([rng.integers(-700, 700, (6, dims)), x[:2]])
        packed, tables = cells.encode(x), cells.tables(centroids)
        bounds = sum(tables[j][packed[:, j]] for j in range(packed.shape[1]))
        apart = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        apart -= ((x - vafile.middle(centroids)) ** 2).sum(axis=1)[:, None]
        assert (bounds[:, :8] <= apart).all() and (apart <= bounds[:, 8:]).all()
        told = vafile.decided(packed, tables)
        assert ((told < 0) | (told == vafile.nearest(x, centroids)[0])).all()


def test_clusters_far_apart_are_told_by_their_cells():
    rng = np.random.default_rng(9)
    centres = rng.integers(-1000, 1000, (6, 64))
    x = centres[rng.integers(6, size=3000)] + rng.integers(-30, 30, (3000, 64))
    cells = vafile.Cells.learn(x.min(axis=0), x.max(axis=0), x[::7].astype(float))
    assert (vafile.decided(cells.encode(x), cells.tables(centres)) >= 0).mean() > 0.95


def test_few_vectors_none_and_large_ones(spark):
    schema = "vec_id long, embedding array<double>"
    got = vafile.cluster(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema), dims=2)[0].collect()
    assert sorted(tuple(r)[:5] for r in got) == [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0)]
    none = vafile.cluster(spark.createDataFrame([(1, [1.0])], schema), dims=2)[0]
    assert none.count() == 0 and none.columns == [c.split()[0] for c in vafile.RESULT.split(", ")]
    with pytest.raises(Exception, match="do not fit a long"):
        vafile.cluster(spark.createDataFrame([(1, [1e30, 1.0])], schema), dims=2)

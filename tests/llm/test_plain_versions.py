"""Learned operators and the stages of the pipeline against plain versions of their rules."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tollgate.llm import QUERIES, langid, quality

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def crc(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


# ---------------------------------------------------------------- quality


def logit(x):
    return math.log((x + 0.002) / (1.002 - x))


def plain_statistics(text):
    raw = (text or "").encode()
    words, n = raw.split(), len(raw.split())
    size, counts = max(1, len(raw)), Counter(words)
    letters = max(1, size - sum(raw.count(bytes([c])) for c in (32, *range(9, 14))))
    shares = [v / max(1, n) for v in counts.values()] or [1.0]
    pairs = list(zip(words, words[1:], strict=False))
    marks = sum(raw.count(bytes([c])) for c in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)) if c not in (44, 46))
    return [
        math.log1p(len(raw)), math.log1p(n), math.log1p(letters / max(1, n)),
        logit(sum(65 <= c <= 90 for c in raw) / letters), logit(sum(48 <= c <= 57 for c in raw) / letters),
        logit(marks / letters), logit(min(1, raw.count(b".") / max(1, n))), logit(min(1, raw.count(b"\n") / max(1, n))),
        logit(len(counts) / n if n else 1.0), logit(max(shares)) if n > 1 else 0.0,
        logit(sum(a == b for a, b in pairs) / len(pairs) if pairs else 0.0), logit((len(set(pairs)) or 1) / max(1, n - 1)),
        logit(sum(c > 127 for c in raw) / size), -sum(s * math.log(s) for s in shares) / math.log(max(2, n)),
        logit(min(1, (raw.count(b"!") + raw.count(b"|")) / max(1, n))),
    ]


def test_quality_scores_are_those_of_plain_densities(spark, docs):
    labels = dict(spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect())
    rows = docs.select("doc_id", "text").collect()
    x = np.array([plain_statistics(r["text"]) for r in rows])
    of = {c: np.array([k for k, r in enumerate(rows) if crc(r["doc_id"], 3) != 1 and labels.get(r["doc_id"]) == c]) for c in (0, 1)}
    own = {c: np.cov(x[of[c]].T) for c in (0, 1)}
    pooled = sum(own[c] * (len(of[c]) - 1) for c in (0, 1)) / (sum(map(len, of.values())) - 2)
    dens = []
    for c in (0, 1):
        held = 0.1 + 0.9 * 15 / (15 + len(of[c]))
        cov = (1 - held) * own[c] + held * pooled
        cov = 0.98 * cov + 0.02 * (np.trace(cov) / 15 + 1e-6) * np.eye(15)
        z = x - x[of[c]].mean(axis=0)
        dens.append(-0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) + np.linalg.slogdet(cov)[1]))
    odds = np.clip(dens[1] - dens[0] + math.log((len(of[1]) + 1) / (len(of[0]) + 1)), -40, 40)
    want = dict(zip([r["doc_id"] for r in rows], 1 / (1 + np.exp(-odds)), strict=True))
    got = {r["doc_id"]: r["score"] for r in QUERIES["op8_quality"](spark, SF_DIR).collect()}
    assert got == pytest.approx(want, abs=1e-6)


# ---------------------------------------------------------------- language


def test_language_is_the_codeword_of_least_loss(docs):
    """Of each text's n-gram counts, bits and losses by plain loops."""
    rows = [r for r in docs.select("doc_id", "text", "lang").collect() if r["text"]][:60]
    names = sorted({r["lang"] for r in rows})
    counts = langid.counts_of([r["text"].encode() for r in rows]).astype(float)
    sums = np.array([counts[[k for k, r in enumerate(rows) if r["lang"] == n]].sum(axis=0) for n in names])
    model = langid.model_of(names, sums)
    best, score, _ = model.decode(counts)
    smoothed = (sums + 0.5) / (sums + 0.5).sum(axis=1, keepdims=True)
    seen = np.flatnonzero(counts.sum(axis=0))
    for b in range(model.code.shape[1]):
        one, other = (smoothed[model.code[:, b] == side].mean(axis=0) for side in (1, -1))
        assert np.allclose(model.weights[seen, b], np.log(one[seen] / other[seen]), atol=1e-5)
    for k in range(len(rows)):
        held = np.flatnonzero(counts[k])
        losses = []
        for code in model.code.tolist():
            loss = 0.0
            for b, side in enumerate(code):
                margin = langid.SHARPNESS * sum(counts[k, g] * float(model.weights[g, b]) for g in held) / counts[k].sum()
                loss += float(model.trust[b]) * math.log1p(math.exp(-side * margin))
            losses.append(loss)
        odds = [math.exp(-(v - min(losses)) * len(model.trust)) for v in losses]
        assert best[k] == losses.index(min(losses)) and score[k] == pytest.approx(1 / sum(odds), abs=1e-4)


# ---------------------------------------------------------------- pipeline


def plain_kept(rows):
    """One document of each group of near copies: sets of five words, similarity of 0.8."""
    sets = {}
    for r in rows:
        words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        size = min(5, len(words))
        sets[r["doc_id"]] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    root = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
    return {i for i, r in root.items() if i == r}


def test_stages_keep_what_their_rules_keep(spark, docs):
    from test_operators import plain_leaks

    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(quality.remainder(3) != 1)
    model = quality.train(quality.measured(docs), labels)
    good = {r["doc_id"] for r in quality.score(docs, model).collect() if r["score"] >= corpus_pipeline.LEAST_QUALITY}
    first = stages["quality classifier"](spark, docs, SF_DIR).cache()
    assert {r["doc_id"] for r in first.collect()} == good
    second = stages["near-duplicates"](spark, first, SF_DIR).cache()
    assert {r["doc_id"] for r in second.collect()} == plain_kept(first.collect())
    third = stages["benchmark decontamination"](spark, second, SF_DIR).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [(r["doc_id"], r["text"]) for r in second.collect()]
    leaked = {row[0] for row in plain_leaks([d for d in kept if len(d[1] or "") < 20_000], items)}
    left = {r["doc_id"] for r in third.collect()}
    assert {i for i, t in kept if len(t or "") < 20_000} - leaked == {i for i, t in kept if i in left and len(t or "") < 20_000}
    fourth = stages["personal data"](spark, third, SF_DIR)
    assert {r["doc_id"] for r in fourth.collect()} == left


def test_stages_take_odd_rows(spark, docs):
    """Nulls in any column, empty and long texts, repeats and clashing column names."""
    text = docs.first()["text"]
    rows = [
        (1, text, "en", "a"), (1, text, "en", "a"), (2, text, None, None), (3, None, "en", "a"), (4, "", "en", "a"), (None, text + " more", "en", "b"),
        (5, None, None, None), (6, "a@b.cd " * 20_000, "en", "b"), (7, " \n\t", "en", "b"),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, score double, copy int, shard int, part string, id long, n long"
    current = spark.createDataFrame([(*r, 1, 0.5, 1, 2, "p", 3, 4) for r in rows], names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, current, SF_DIR)
        assert after.schema == current.schema, name
        current = spark.createDataFrame(after.collect(), names)
    mixed = corpus_pipeline.STAGES[-1][1](spark, current, SF_DIR)
    assert set(current.columns) <= set(mixed.columns) and mixed.count() >= 0


# ---------------------------------------------------------------- registered queries


def test_op1_takes_what_its_contract_says(spark, docs):
    from test_operators import targets

    rows = {r["doc_id"]: r for r in docs.collect()}
    got = QUERIES["op1_mix_sources"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    sizes, taken = Counter(), Counter()
    for r in got:
        source, size = rows[r["doc_id"]]["source"], len(words_of(rows[r["doc_id"]]["text"]))
        assert r["size"] == size and 0 <= r["taken"] <= 3 * size and (not size or r["taken"] % size == 0)
        sizes[source] += size
        taken[source] += r["taken"]
    wanted = targets(dict(sizes))
    for r in got:
        source = rows[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(wanted[source])
    longest = max(len(words_of(r["text"])) for r in rows.values())
    assert all(abs(taken[s] - wanted[s]) <= min(longest, 0.2 * wanted[s] + 50) for s in sizes)
    again = QUERIES["op1_mix_sources"](spark, SF_DIR).collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in got}


def test_op9_finds_what_brute_force_finds(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in rows}
    ids, got = sorted(x), {}
    for r in QUERIES["op9_nearest"](spark, SF_DIR).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [i for i in ids if i % 20 == 0]
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [k for k, _, _ in found] == list(range(1, 21)) and q not in {v for _, v, _ in found}
        assert all(s == pytest.approx(float(x[v] @ x[q]), abs=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        best = sorted((-float(x[v] @ x[q]), v) for v in ids if v != q)[:20]
        hit += len({v for _, v in best} & {v for _, v, _ in found})
    assert hit >= 0.95 * 20 * len(got)


def test_op13_and_op12_do_not_depend_on_partitions(spark):
    from tollgate.llm import divergence, vafile

    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    runs = [sorted(map(tuple, vafile.cluster(v)[0].collect())) for v in (vectors, vectors.repartition(7, "embedding"))]
    assert runs[0] == runs[1]
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", "lang", "source")
    runs = [sorted(map(tuple, divergence.audit(d, least_docs=5).collect())) for d in (texts, texts.repartition(7, "source"))]
    assert runs[0] == runs[1] and runs[0]

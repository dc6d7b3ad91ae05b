"""The operators on odd rows (nulls, empty and long texts, ties, repeats, no rows, clashing
columns), their queries against SQL or plain versions, and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tollgate.llm import ORACLES, QUERIES, ann, decontaminate, langid, mix, neardup, quality, substrings, toxicity, urls

SF_DIR = "/root/testdata/sf0.001"
PROSE = "the cat sat on a mat and looked at the dog who was not amused by any of this " * 3
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, kept string, shard int, label int, hash string"
TEXTS = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, None, None), (4, "", "en", None),
    (5, "  \n\t", None, "b"), (6, "one", "en", "b"), (7, "12 34 !!", "en", "a"), (8, "lang " * 40_000, "de", "a"),
    (9, PROSE + "and more", None, "c"), (None, PROSE, "en", "c"), (10, "le chat et la souris " * 20, "fr", "c"),
    (11, "idiot moron " * 5, "en", "b"), (12, "x" * 100_000, "de", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, len(t) if t else None, 0.5, "z", "k", 3, 1, "h") for i, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 2), int(i == 11)) for i in range(1, 13)] + [(1, 1, 0), (40, 1, 1), (None, 1, 1), (2, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_mix(docs, none):
    got = mix.mix(docs).collect()
    assert len(got) == len(TEXTS) and mix.mix(none).count() == 0 and mix.mixture(none).count() == 0
    again = {(r["doc_id"], r["source"]): r["shards"] for r in mix.mix(docs).collect()}
    for r in got:
        assert r["size"] == len((r["text"] or "").split()) and r["kept"] == "k"
        assert len(r["shards"]) <= 3 and again[r["doc_id"], r["source"]] == r["shards"]
    copies = mix.mixture(docs)
    assert copies.count() == sum(len(r["shards"]) for r in got) and copies.columns.count("shard") == 1


def targets(sizes: dict) -> dict:
    """Shares by weight, stopped at three times the size, the excess shared again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights, total = {s: 1 + i % 3 for i, s in enumerate(order)}, sum(sizes.values())
    full: set = set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weights[s] for s in order if s not in full)
        share = {s: 3 * sizes[s] if s in full else rest * weights[s] / open_weight for s in order}
        more = {s for s in order if s not in full and share[s] > 3 * sizes[s]}
        if not more:
            return share
        full |= more


@pytest.mark.parametrize("tilt", [1, 40])
def test_mix_meets_its_targets(spark, tilt):
    rows = [(i, f"s{i % 7}" if i % 7 else None, "w " * (1 + i % 50) * (tilt if i % 7 == 3 else 1)) for i in range(1500)]
    got = mix.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    sizes, taken, said = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * len(r["shards"])
        said[r["source"]] = (r["source_size"], r["target"])
    for source, target in targets(sizes).items():
        assert said[source][0] == sizes[source] and said[source][1] == pytest.approx(target)
        assert abs(taken[source] - target) <= max(3, target / 1000)
    shards = defaultdict(int)
    for r in got:
        for s in r["shards"]:
            shards[s] += 1
    assert set(shards) == set(range(64))


def test_near_duplicates(docs, none):
    got = rows_by_id(neardup.link(docs))
    assert [got[i]["component_id"] for i in (1, 2, 9)] == [1, 1, 1]
    assert all(got[i]["n_shingles"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in (3, 4, 5))
    assert got[6]["n_shingles"] == 1 and got[None]["component_id"] is None and got[None]["kept"]
    assert neardup.link(docs).count() == len(TEXTS) and neardup.link(none).count() == 0
    left = neardup.deduplicated(docs)
    assert left.schema == docs.schema
    assert {r[0] for r in left.select("doc_id").collect()} == {1, 3, 4, 5, 6, 7, 8, 10, 11, 12, None}


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(neardup.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_near_copies_in_a_large_group_are_all_linked(spark):
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.choice(150, 6, replace=False):
            words[k] = f"x{i}-{k}"
        rows.append((i, " ".join(words)))
    sets = [set(zip(t.split(), t.split()[1:], strict=False)) for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    got = rows_by_id(neardup.link(spark.createDataFrame(rows, "doc_id long, text string"), size=2))
    assert [got[i]["component_id"] for i in range(len(rows))] == root


def test_language(docs, none):
    model = langid.train(docs)
    got = rows_by_id(langid.identify(docs, model))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5, 7))
    assert got[10]["lang_pred"] == "fr" and got[9]["lang_pred"] == "en" and got[8]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    empty = langid.train(none)
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0


def test_toxicity(docs, labels, none):
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model)
    assert got.columns.count("score") == 1 and all(0 <= r["score"] <= 1 for r in got.collect())
    assert toxicity.score(none, model).count() == 0
    blank = toxicity.train(none, labels.limit(0))
    assert all(r["score"] < 0.01 for r in toxicity.score(docs, blank).collect())


def test_terms_misspelled_within_their_first_letters_are_found(spark):
    rng, terms = random.Random(7), ["disgusting", "pathetic", "stupid", "worthless", "idiot"]
    plain = [f"{a}{b}" for a in ("ban", "cor", "mil", "tev") for b in ("ado", "lory", "nex", "quin", "vale")]
    text = lambda *more: " ".join(rng.sample([*rng.choices(plain, k=14 - len(more)), *more], 14))

    def misspelled(term):
        k = rng.randrange(4)
        return term[:k] + rng.choice("jkqwxyz") + term[k + 1 :]

    learned = [(i, text(rng.choice(terms), misspelled(rng.choice(terms))) if i % 4 == 0 else text(), int(i % 4 == 0)) for i in range(800)]
    learned += [(1000 + i, text(misspelled(rng.choice(terms))), 1) for i in range(60)]
    model = toxicity.train(
        spark.createDataFrame([r[:2] for r in learned], "doc_id long, text string"),
        spark.createDataFrame([(r[0], r[2]) for r in learned], "doc_id long, toxic int"),
    )
    held = [(i, text(misspelled(terms[i % 5])), 1) for i in range(40)] + [(100 + i, text(), 0) for i in range(40)]
    got = rows_by_id(toxicity.score(spark.createDataFrame(held, "doc_id long, text string, toxic int"), model))
    assert min(r["score"] for r in got.values() if r["toxic"]) > 2 * max(r["score"] for r in got.values() if not r["toxic"])


def test_rare_terms_are_entries(spark):
    terms = [f"{a}{b}" for a in "bcdfghjklm" for b in "aeiou" for _ in "x"]
    words = [f"{t}{i}zz" for i in range(4) for t in terms]  # 200, each in a few of the toxic texts
    rows = [(i, f"calm words here {words[i // 2 % 200]} {words[i // 2 * 7 % 200]}" if i % 2 else "calm words here", i % 2) for i in range(4000)]
    rows += [(5000 + i, "calm words here grimzz", 1) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    weights = toxicity.train(df.drop("toxic"), df.drop("text")).lexicon.weights
    assert {*words, "grimzz"} <= set(weights)


def test_quality(docs, labels, none):
    stats = quality.measured(docs)
    model = quality.train(stats, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[3] == got[4]
    assert {r["doc_id"]: r["score"] for r in quality.rated(stats, model).collect()} == pytest.approx(got)
    assert quality.accepted(docs, model, 0.5).schema == docs.schema
    assert quality.score(none, model).count() == 0 and quality.rated(quality.measured(none), model).count() == 0
    quality.train(quality.measured(none), labels)


def test_substrings(spark, docs, none):
    got = rows_by_id(substrings.deduplicated(docs))
    n = len(PROSE.split())
    assert got[1]["n_words"] == n and got[2]["n_removed"] == n and got[2]["kept"] == ""
    assert got[None]["n_removed"] == 0 and got[3]["n_words"] == 0 and got[8]["n_removed"] == 39_999
    assert substrings.deduplicated(docs).count() == len(TEXTS) and substrings.deduplicated(none).count() == 0


def test_substrings_of_few_words_against_plain_windows(spark):
    rng = np.random.default_rng(3)
    phrases = [" ".join(rng.choice(["a", "b", "c", "d"], 30)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choice(["a", "b", "c", "d", "e"], rng.integers(0, 25))) for _ in range(4)]
        rows.append((i, " ".join(x for p in parts for x in (p, phrases[rng.integers(4)][: rng.integers(60)]))))
    seen, want = set(), {}
    for i, text in rows:
        words = text.split()
        gone = [False] * len(words)
        for a in range(len(words) - 19):
            window = tuple(words[a : a + 20])
            if window in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(window)
        want[i] = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
    got = rows_by_id(substrings.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: r["kept"] for i, r in got.items()} == want
    assert any(r["n_removed"] for r in got.values())


@pytest.mark.parametrize("heavy", [1, 20, 1000, 10**9])
def test_substrings_are_the_same_however_heavy_a_passage_is(spark, monkeypatch, heavy):
    monkeypatch.setattr(substrings, "HEAVY", heavy)
    rng = np.random.default_rng(4)
    common = [f"c{i}" for i in range(45)]
    rows = []
    for i in range(90):
        own = [f"w{k}" for k in rng.integers(0, 3000, rng.integers(5, 60))]
        at = int(rng.integers(0, len(own)))
        passage = common if i % 3 else common[: int(rng.integers(15, 45))]
        rows.append((90 - i, " ".join([*own[:at], *passage, *own[at:], *(passage if i % 10 == 0 else [])])))
    seen, want = set(), {}
    for i, text in sorted(rows):
        words = text.split()
        gone = [False] * len(words)
        for a in range(len(words) - 19):
            window = tuple(words[a : a + 20])
            if window in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(window)
        want[i] = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
    got = rows_by_id(substrings.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert {i: r["kept"] for i, r in got.items()} == want


def test_urls(spark):
    rows = [
        (1, "http://www.Example.com/en/x", "p"), (2, "http://example.com/en/", "p"), (3, None, "p"), (4, "example.com/en/", "p"),
        (5, "ftp://a.net/es/?q", "p"), (6, "http://xexample.com/en/", "p"), (7, "http://com", "p"), (8, "http://a.b://c.net/fr/", "p"),
        (9, "", "p"), (10, "https://sub.www.example.com/en/#f", "p"), (1, "http://www.Example.com/en/x", "p"), (11, "http:///fr/" + "y" * 50_000, "p"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, path string")
    got = sorted(((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in urls.judge(pages, urls.RULES).collect()), key=str)
    assert got == sorted(
        [
            (1, "www.example.com", "www.example.com/en/", "allow"), (2, "example.com", "example.com/en/", "block"), (3, "", None, "allow"),
            (4, "", None, "allow"), (5, "a.net", "net/es/", "block"), (6, "xexample.com", "com/", "allow"), (7, "com", None, "allow"),
            (8, "a.b:", None, "allow"), (9, "", None, "allow"), (10, "sub.www.example.com", "www.example.com/en/", "allow"),
            (1, "www.example.com", "www.example.com/en/", "allow"), (11, "", None, "allow"),
        ],
        key=str,
    )
    assert urls.judge(pages.limit(0), urls.RULES).count() == 0


def test_rules_with_letters_of_several_bytes_fit(spark):
    pages = spark.createDataFrame([(1, "http://a.org/é/x"), (2, "http://a.org/e/x")], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, [("a.org", "/é/", "block")]).collect()}
    assert got == {1: ("a.org/é/", "block"), 2: (None, "allow")}


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[300:500] = x[300]  # one vector for a third of the rows
    odd = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(1000 + 20 * i, v, 1) for i, v in enumerate(odd)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in ann.search(vectors, vectors.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 600, 20))
    found, wide = 0, x.astype(np.float64)
    for q, rows in got.items():
        scores = wide @ wide[q]
        order = [i for i in np.lexsort((np.arange(600), -scores)) if i != q][:20]
        found += len(set(order) & {v for v, _ in rows})
        assert len(rows) == 20 and all(abs(s - scores[v]) < 1e-9 for v, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
    assert found >= 0.95 * 20 * len(got)
    few = ann.search(vectors.where("vec_id < 5"), vectors.where("vec_id = 0"))
    assert few.count() == 4
    assert ann.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, PROSE), (2, None), (3, ""), (4, "not in there at all")], "item_id long, text string")
    got = decontaminate.leaks(docs, items).select("doc_id", "item_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == [(1, 1), (2, 1), (2, 1), (9, 1), (None, 1)]
    left = decontaminate.clean(docs, items)
    assert left.schema == docs.schema and left.count() == len(TEXTS) - 5
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0 and decontaminate.clean(docs, items.limit(0)).count() == len(TEXTS)
    assert decontaminate.leaks(none, items).count() == 0


def plain_leaks(docs, items):
    """What `leaks` gives, from its definitions: BM25 shares by dicts, 5-grams by sets."""
    words_of = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    known = {(i, t): words_of(t) for i, t in items}
    known = {k: w for k, w in known.items() if w}
    df, mean = Counter(w for ws in known.values() for w in set(ws)), np.mean([len(w) for w in known.values()])

    def own(ws):
        norm = 1.2 * (0.25 + 0.75 * len(ws) / mean)
        part = {w: math.log(1 + (len(known) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + norm) for w, n in Counter(ws).items()}
        return {w: x / sum(part.values()) for w, x in part.items()}

    def share(part, passage):
        n = min(5, len(part))
        grams = lambda ws: {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}
        return len(grams(part) & grams(passage)) / len(grams(part)) if part else 1.0

    def changed(part, passage):
        row = [0] * (len(passage) + 1)
        for i, w in enumerate(part, 1):
            new = [i]
            for j, v in enumerate(passage, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != v)))
            row = new
        return min(row)

    weights, out = {k: own(w) for k, w in known.items()}, set()
    for doc, text in docs:
        words, best = words_of(text), {}
        for (item, body), whole in known.items():
            if not set(whole) & set(words):
                continue
            size = 64
            while size < len(whole):
                size *= 2
            first, second = (words_of(p) for p in decontaminate.parts(body))
            for start in range(0, max(len(words) - size, 1), size):
                passage = words[start : start + 2 * size]
                score = sum(weights[item, body].get(w, 0) for w in set(passage))
                if score < 0.5 - 1e-6:
                    continue
                shares = [share(p, passage) for p in (whole, first, second)]
                held = shares[0] >= 0.8 and min(shares[1:]) >= 0.5
                edited = changed(whole, passage) <= 0.15 * len(whole) and all(changed(p, passage) <= 0.5 * len(p) for p in (first, second))
                if (held or edited) and (item not in best or score > best[item][1] + 1e-9):
                    best[item] = (start, score, *shares)
        out |= {(doc, item, row[0], round(row[1], 6), *(round(x, 9) for x in row[2:])) for item, row in best.items()}
    return out


@pytest.mark.parametrize("index_bytes", [16 << 20, 2000])
def test_leaks_are_those_of_the_definitions(spark, monkeypatch, index_bytes):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", index_bytes)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    rng = random.Random(9)
    for i, (_, text) in enumerate(items[:25]):  # one word changed
        words = text.split()
        words[rng.randrange(len(words))] = "otherwise"
        docs.append((10_000 + i, f"{docs[i][1]} {' '.join(words)} {docs[i + 1][1][:2000]}"))
    docs = [d for d in docs if len(d[1] or "") < 20_000]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.leaks(frame, spark.createDataFrame([*items, items[0]], "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"], r["start"], round(r["score"], 6), *(round(r[c], 9) for c in ("overlap", "question", "answer"))) for r in got}
    assert got == plain_leaks(docs, items)
    assert {10_000 + i for i in range(25)} <= {r[0] for r in got}


def test_given_benchmark_passages_are_found(spark):
    plain = lambda s: " ".join(s.split())
    items = [plain(r[0]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect()]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    held = {r["doc_id"] for r in docs if any(i in plain(r["text"]) for i in items)}
    assert held <= {r["doc_id"] for r in QUERIES["op10_decontaminate"](spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", ORACLES)
def test_query_gives_the_rows_of_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize(
    "name, column, label, least",
    [("op3_language", "lang_pred", "lang", 0.97), ("op4_toxicity", "predicted", "toxic", 0.85), ("op8_quality", "predicted", "quality", 0.93)],
)
def test_held_out_accuracy(spark, name, column, label, least):
    sf_dir = "/root/testdata/sf0.01"
    table = "documents" if label == "lang" else "labels"
    truth = dict(spark.read.parquet(f"{sf_dir}/{table}.parquet").select("doc_id", label).collect())
    divisor, left = (3, 1) if label == "quality" else (4, 2)
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % divisor == left) for r in rows)
    out = [r[column] == truth[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(out) >= least * len(out)


def test_pipeline(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
        docs = docs.cache()
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] > 0
    mixed = corpus_pipeline.run(spark, SF_DIR)
    assert set(columns) | {"copy", "shard", "position"} == set(mixed.columns)
    ids = {r[0] for r in docs.select("doc_id").collect()}
    assert {r[0] for r in mixed.select("doc_id").collect()} <= ids
    assert mixed.groupBy("doc_id").count().where("count > 3").count() == 0
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0, name

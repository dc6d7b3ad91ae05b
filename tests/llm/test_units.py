"""Parts of the operators that need no Spark, against plain versions."""

import itertools
import random

import numpy as np
import pytest

from tollgate.llm import ann, decontaminate, langid, mix, neardup, quality, substrings, toxicity, urls
from tollgate.llm.text import MARKS, PIECE, SPACES, Hasher, hashed

ROWS = [b"", b"one two  three", b"\x0b one\x0c", "é è".encode(), b"a" * 50, b"one two three"]


def words_by_row(rows, separators=SPACES):
    out = {}
    for first, (words,), offsets in hashed(rows, [Hasher(1)], separators):
        for k in range(len(offsets) - 1):
            out[first + k] = words[offsets[k] : offsets[k + 1]].tolist()
    return [out[i] for i in range(len(rows))]


def test_words_are_those_of_split():
    got = words_by_row(ROWS)
    names = {}
    for row, hashes in zip(ROWS, got, strict=True):
        assert len(hashes) == len(row.split())
        for word, value in zip(row.split(), hashes, strict=True):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)
    assert len(words_by_row([b"a.b-c d"], MARKS)[0]) == 4


def test_long_rows_hash_like_short_ones():
    row = b" ".join(b"w%d" % (i % 1000) for i in range(3 * PIECE // 4))
    assert len(row) > 2 * PIECE
    long, short = words_by_row([b"x y", row, b"z"])[1], words_by_row([b" ".join(row.split()[:1000])])[0]
    assert len(long) == 3 * PIECE // 4 and long[:1000] == short and long[1000:2000] == short
    assert words_by_row([b"q" * (3 * PIECE)])[0] == words_by_row([b"q" * (3 * PIECE)] * 2)[1]


def test_tree_keeps_quotas_and_capacities():
    quotas, shards = np.array([5, 0, 17, 1]), np.array([6, 6, 6, 5])
    split = mix.tree(quotas, shards, [1])
    assert (split.sum(axis=0) == quotas).all() and (split.sum(axis=1) == shards).all()
    assert (split == mix.tree(quotas, shards, [1])).all()


def test_sketches_estimate_and_bound():
    rng = np.random.default_rng(1)
    for share in (0.99, 0.9, 0.8):
        common = rng.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        own = [np.unique(np.concatenate([common, rng.integers(0, 2**63, int(1000 * (1 - share)), dtype=np.uint64)])) for _ in "ab"]
        true = len(np.intersect1d(*own)) / len(np.union1d(*own))
        bits = np.bitwise_count(np.bitwise_xor(*[neardup.odd_sketch(neardup.minhash(s)) for s in own])).sum()
        assert abs(neardup.similarity_of(float(bits)) - true) < 0.1
        apart = np.bitwise_count(np.bitwise_xor(*[neardup.parity(s, neardup.PARITY_BITS) for s in own])).sum()
        assert apart <= len(np.setxor1d(*own))


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 30):
        code = langid.codewords(n)
        assert len(code) == n
        gaps = [(a != b).sum() for a, b in itertools.combinations(code, 2)]
        assert min(gaps) >= (1 if n == 2 else 2)


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_trie_finds_what_edit_distance_finds():
    entries = ["idiot", "stupid", "worthless", "disgusting", "moron", "scum"]
    lexicon = toxicity.Lexicon({e: 2.0 + i for i, e in enumerate(entries)})
    rng, letters = random.Random(1), "abcdeghimnorstuw"
    for _ in range(2000):
        word = list(rng.choice(entries))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(word))
            word[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
            word = word or ["x"]
        word = "".join(word)
        if len(word) < 5:
            continue
        near = [
            (d, -lexicon.weights[e], e) for e in entries
            if (d := distance(word, e)) <= min(toxicity.edits(len(word)), toxicity.edits(len(e)))
        ]
        got = lexicon.near(word)
        assert got == ((min(near)[0], min(near)[2]) if near else None), word


def test_many_words_match_as_each_one_against_plain_edit_distance():
    rng, letters = random.Random(3), "abcdeéнt"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    entries = [word(rng.randint(2, 24)) for _ in range(60)] + ["stup*", "abcd*"]
    weights = {e: rng.choice([2.0, 3.0, 4.0]) for e in entries}
    lexicon = toxicity.Lexicon(weights, frozenset({"abce"}))
    words = {word(rng.randint(1, 26)) for _ in range(2000)} | {"abcé", "abce", "stupid", "x" * 100_000}
    for _ in range(8000):  # entries with letters changed, left out and put in
        w = list(rng.choice(entries).rstrip("*"))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w)) if w else 0
            w[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
        words.add("".join(w) or "x")
    assert len(words) > 6000
    got = lexicon.matches(words)
    for w in words:
        want = None
        stems = [(weights[f"{w[:n]}*"], -n) for n in toxicity.STEMS if len(w) >= n and f"{w[:n]}*" in weights]
        if w in weights:
            want = "exact", w, weights[w]
        elif stems:
            want = "stem", w[: -max(stems)[1]], max(stems)[0]
        elif w != "abce":
            near = [
                (d, -weights[e], e) for e in entries
                if not e.endswith("*") and abs(len(e) - len(w)) <= 2
                and (d := distance(w, e)) <= min(toxicity.edits(len(w)), toxicity.edits(len(e)))
            ]
            want = ("misspelled", min(near)[2], -min(near)[1] / (1 + min(near)[0])) if near else None
        assert got.get(w) == want, w
    assert {kind for kind, _, _ in got.values()} == {"exact", "stem", "misspelled"}


def test_what_is_forgotten_is_matched_again(monkeypatch):
    lexicon = toxicity.Lexicon({"moron": 3.0, "idiot": 4.0})
    texts = [f"what a mor{c}n and id{c}ot w{i}{c} you idiot" for i in range(30) for c in "aeiou"]
    want = [toxicity.Scanner(lexicon).features(t) for t in texts]
    for memory, together in ((5, 10), (3, 1000), (1, 1)):
        monkeypatch.setattr(toxicity, "MEMORY", memory)
        monkeypatch.setattr(toxicity, "TOGETHER", together)
        assert list(toxicity.Scanner(lexicon).features_of(texts * 2)) == want * 2


def test_words_that_a_stem_covers_are_found_misspelled():
    entries = ["stupid", "stup*", "stupid*", "disgusting", "disg*"]
    lexicon = toxicity.Lexicon(dict.fromkeys(entries, 3.0))
    assert lexicon.match("sxupid") == ("misspelled", "stupid", 1.5)
    assert lexicon.match("tsupid") is None and lexicon.match("dixgustng")[:2] == ("misspelled", "disgusting")
    assert lexicon.match("stupxd")[0] == "stem"


def test_short_terms_are_found_misspelled_and_stems_of_the_same_documents_dropped():
    lexicon = toxicity.Lexicon({"scum": 4.0})
    assert lexicon.match("scxm") == ("misspelled", "scum", 2.0) and lexicon.match("scxx") is None
    assert lexicon.match("scuum") == ("misspelled", "scum", 2.0) and lexicon.match("scm") is None
    picked = {"idiot": (0, 5, 4.0), "idio*": (1, 6, 3.0), "idiot*": (1, 6, 3.0), "idiots*": (0, 4, 3.5)}
    assert toxicity._entries(picked) == {"idio*": 3.0, "idiot": 4.0, "idiots*": 3.5}


def test_quotation_is_kept_apart():
    scanner = toxicity.Scanner(toxicity.Lexicon({"moron": 3.0}, frozenset({"boron"})))
    of = lambda text: dict(zip(toxicity.FEATURES, scanner.features(text), strict=True))
    assert of("what a moron")["exact"] > 0 == of("what a moron")["quoted"]
    assert of('a "moron" here')["quoted"] > 0 == of('a "moron" here')["exact"]
    assert of("the word moron is used")["quoted"] > 0
    assert of("a m0ron")["misspelled"] > 0 == of("some boron")["misspelled"]
    assert of("you moron")["addressed"] > 0
    assert of("") == dict.fromkeys(toxicity.FEATURES, 0.0)


def test_edits_against_plain_edit_distance():
    rng = np.random.default_rng(6)
    for _ in range(300):
        item = rng.integers(0, 6, rng.integers(1, 12)).astype(np.uint64)
        words = rng.integers(0, 6, rng.integers(0, 25)).astype(np.uint64)
        spans = [words[a:b].tolist() for a in range(len(words) + 1) for b in range(a, len(words) + 1)]
        assert decontaminate.edits(item, words) == min(distance(item.tolist(), s) for s in spans)


@pytest.mark.parametrize("size", [7, 12, 15, 18, 21, 25, 28, 30, 57])
def test_an_item_with_one_word_changed_is_found_at_every_length(size):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=size))) for i in range(40)]
    indexes, found = decontaminate.build(items), 0
    for item, text in items:
        for change in ("put", "drop", "add"):
            words = text.split()
            k = rng.randrange(size)
            words[k : k + (change != "add")] = [] if change == "drop" else ["other"]
            doc = " ".join([*rng.choices(vocabulary, k=rng.randint(0, 300)), *words, *rng.choices(vocabulary, k=50)])
            found += item in {row[0] for row in decontaminate._of_batch([doc.encode()], indexes)[0]}
    assert found == 3 * len(items)


def test_passages_that_share_words_with_items_stay():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(15, 40)))) for i in range(60)]
    indexes = decontaminate.build(items)
    for _, text in items:
        words = text.split()
        half, other = words[: len(words) // 2], rng.choices(vocabulary, k=200)
        shuffled = rng.sample(words, len(words))
        third = [w if i % 3 else "other" for i, w in enumerate(words)]
        docs = [" ".join(x).encode() for x in (half + other, other + shuffled, third + other, words[2 * len(words) // 5 :])]
        assert decontaminate._of_batch(docs, indexes) == [[], [], [], []]


def test_retrieval_is_whole():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(6, 60)))) for i in range(150)]
    (index,) = decontaminate.build(items)
    scores = np.zeros((len(index.terms), len(items)))
    for postings in index.postings:
        for term, own in postings.items():
            for item, score in own:
                scores[term, item] = score
    assert np.allclose(scores.sum(axis=0), 1)
    for least in (0.05, 0.2, 0.5):
        for _ in range(20):
            terms = sorted(rng.sample(range(len(index.terms)), 60))
            want = {i for i, s in enumerate(scores[terms].sum(axis=0)) if s >= least}
            got = {i for b in range(len(index.postings)) for i, _ in index.retrieve(b, terms, least)}
            assert got == want


def test_leaks_are_found_anywhere():
    rng = random.Random(3)
    text = lambda n: " ".join(f"v{rng.randrange(3000)}" for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([3, 12, 40, 64, 65, 130, 700])] + [(98, ""), (99, None)]
    indexes = decontaminate.build(items)
    docs, want = [], []
    for before in (0, 1, 63, 64, 100, 129, 500):
        for item, own in items[:7]:
            docs.append(f"{text(before)} {own.upper()}! {text(37)}")
            want.append(item)
    docs += [text(900), "", items[5][1][: len(items[5][1]) // 2]]
    got = decontaminate._of_batch([d.encode() for d in docs], indexes)
    assert [[x[0] for x in rows] for rows in got] == [[i] for i in want] + [[], [], []]


@pytest.mark.parametrize("large", [10**6, 3 * 10**9, 10**14])
def test_a_tree_over_any_number_of_blocks(large):
    quotas = np.array([large, 7, large // 3, 0, 5 * large], dtype=np.int64)
    total = int(quotas.sum())
    shards = np.full(8, total // 8, dtype=np.int64)
    shards[: total % 8] += 1
    got = mix.tree(quotas, shards, [1, 2])
    assert (got.sum(axis=0) == quotas).all() and (got.sum(axis=1) == shards).all() and (got >= 0).all()
    assert (mix.tree(quotas, shards, [1, 2]) == got).all()
    wanted = quotas[0] / 8
    assert np.abs(got[:, 0] - wanted).max() < 8 * np.sqrt(wanted)


def test_hamming_search_is_whole():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 256, (500, 16), dtype=np.uint8)
    index = ann.Index(codes)
    for radius in (0, 7, 30, 45, 50, 64, 128):
        for q in codes[:5]:
            apart = np.bitwise_count(codes ^ q).sum(axis=1)
            assert index.within(q, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


@pytest.mark.parametrize("bits", [8, 9, 13, 16])
def test_hamming_search_is_whole_for_substrings_of_any_length(bits):
    rng = np.random.default_rng(bits)
    signs = rng.integers(0, 2, (400, 128 // bits * bits), dtype=np.uint8)
    signs[200:] = signs[0] ^ (rng.random((200, signs.shape[1])) < 0.1)
    codes = np.packbits(signs, axis=1)
    index = ann.Index(codes, bits)
    for radius in (0, 5, 13, 31, 60, 128):
        for q in codes[[0, 1, 300]]:
            apart = np.bitwise_count(codes ^ q).sum(axis=1)
            assert index.within(q, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_clustered_vectors_are_found_by_probing_few():
    rng = np.random.default_rng(11)
    x = np.repeat(rng.normal(size=(400, 64)), 40, axis=0) + 0.1 * rng.normal(size=(16_000, 64))
    coder = ann.learn(x[rng.permutation(len(x))[:4096]], 20, len(x))
    codes, found, asked = coder.codes(x), 0, range(0, len(x), 100)
    index = ann.Index(codes, coder.bits)
    for i in asked:
        at = index.within(codes[i], coder.radius)
        near = np.argsort(-(x @ x[i]), kind="stable")[:21]
        found += len(set(near.tolist()) & set(at.tolist()))
    assert index.probed < 0.1 * len(x) * len(asked) and found >= 0.95 * 21 * len(asked)


def test_parse_follows_the_furthest_reference():
    ranges = [(0, 20, 5, 100), (1, 21, 5, 101), (2, 22, 5, 102), (10, 40, 7, 0), (60, 80, 5, 3)]
    assert substrings.parse(ranges) == [(0, 22, 5, 100), (22, 18, 7, 12), (60, 20, 5, 3)]
    assert substrings.parse([]) == []


def test_anchors_hold_every_window():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 4, 300).astype(np.uint64)
    offsets = np.array([0, 5, 25, 25, 180, 300])
    own = substrings.Anchors(words, offsets)
    windows = [i for a, b in itertools.pairwise(offsets) for i in range(a, b - 19)]
    assert own.windows.tolist() == windows
    assert sum((own.high - own.low + 1).tolist()) == len(windows)
    by_content = {}
    for k, i in enumerate(windows):  # equal windows have equal anchors at equal places
        key = (own.values[own.group[k]], own.places[own.group[k]] - i)
        assert by_content.setdefault(tuple(words[i : i + 20].tolist()), key) == key


def test_quadratic_discriminant_separates_what_means_do_not():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, (400, quality.D)), rng.normal(0, 3, (400, quality.D))])
    sums = {c: (400.0, z.sum(axis=0), z.T @ z) for c, z in enumerate((x[:400], x[400:]))}
    scores = quality.model_of(sums).scores(x)
    assert ((scores > 0.5) == np.repeat([False, True], 400)).mean() > 0.95
    one = (1.0, x[0], np.outer(x[0], x[0]))
    for sums in ({0: one, 1: one}, {0: one, 1: (0.0, 0 * x[0], np.zeros((quality.D,) * 2))}):
        assert np.isfinite(quality.model_of(sums).scores(x)).all()


def test_statistics_of_odd_texts_are_finite():
    rows = [b"", b" \n", b"a", b"!" * 1000, b"x" * 100_000, "ü".encode() * 10, b"the " * 5000]
    assert np.isfinite(quality.statistics(rows)).all()


def test_digests_that_collide_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "digest", lambda keys: np.fromiter((len(k) % 2 for k in keys), np.uint64, len(keys)))
    rules = [(f"h{i}.com", "/", "allow" if i % 3 else "block") for i in range(20)]
    (tmp_path / "rules").write_bytes(urls.build(rules))
    table = urls.Rules(str(tmp_path / "rules"))
    found = table.find([f"h{i}.com/".encode() for i in range(25)])
    assert (found[:20] >= 0).all() and (found[20:] < 0).all()
    assert [table.verdict(i) for i in found[:20]] == [v for _, _, v in rules]
    with pytest.raises(ValueError):
        urls.build([("a", "/", "allow"), ("a", "/", "block")])
    (tmp_path / "none").write_bytes(urls.build([]))
    assert urls.Rules(str(tmp_path / "none")).find([b"a"]).tolist() == [-1]

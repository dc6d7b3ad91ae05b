"""Personal data: base spans against Python's own matching, labelers, and defined edge cases."""

import hashlib
import re

import pytest

from tollgate.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def passes(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


CARD = "4845168114407329"
TEXTS = [
    None,
    "",
    "no data here",
    "a@b.c_d@e.f x@y.z.@q.r a@b a@b..c é@x.y ü.b@x-y.z",
    "1.2.3.4.5.6.7.8 999.1.2.3.4 1.2.3 01.002.0003.4 1.2.3.256",
    f"{CARD} 4845-1681-1440-7329 4845 1681 1440 7329 4845  1681 1440 7329 1{CARD} {CARD}0",
    f"{CARD}-{CARD} {CARD}-1 x{CARD}y 12345678901234567",
    "+1 (017) 555-7713 +49 30 1234567 +1-2 +12345678901234567890 ++1 2345678 +1.",
    "é" * 50 + " +1 (017) 555-7713 " + "ü\n" + "😀 a.b@c.de 😀 10.0.0.1",
    "a" * 5_000,
    "1" * 30_000,
    "1-" * 20_000,
    "1." * 20_000,
    "12.34.56.78 " * 1_500,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS + TEXTS[:5])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_base_spans_are_those_of_plain_matching(docs):
    got = {r["doc_id"]: r["base"] for r in pii.find(docs).collect()}
    assert len(got) == len(TEXTS) + 5
    for i, text in enumerate(TEXTS):
        assert [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in got[i]] == base_spans(text), text


def test_all_spans_hold_the_base_ones(docs):
    for r in pii.find(docs).collect():
        assert set(r["base"]) <= set(r["all"])


def test_given_documents(spark):
    from tollgate.llm import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op7_personal_data"](spark, sf_dir).collect():
        spans = base_spans(texts[r["doc_id"]])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]


def test_further_spans_are_found_and_numbers_left_alone(spark):
    rows = [(i, f"please call (415) 555-{1000 + i} or write to ann.{i} (at) mail.example.com") for i in range(40)]
    rows += [(100 + i, f"order 98{i:02d}915762804490 of part") for i in range(40)]
    rows += [(200 + i, f"mail x.{i}@mail.example.com or call +1 (415) 555-{2000 + i}") for i in range(40)]
    got = {r[0]: r["all"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(sorted(s["kind"] for s in got[i]) == [0, 3] for i in range(40))
    numbers = [(i, t) for i, t in rows if 100 <= i < 200]
    assert all(len(got[i]) == len(base_spans(t)) for i, t in numbers)
    assert all(len(got[200 + i]) == 2 for i in range(40))


def test_estimates_tell_a_random_labeler():
    # check and shape agree with the truth, alone votes at random
    counts = {}
    for truth, n in ((1, 300), (-1, 700)):
        for alone in (1, -1):
            counts[(0, truth, truth, 0, 0, alone)] = n
    post, rates = pii.estimate(counts)
    assert all((p > 0.9) == (k[1] == 1) for k, p in post.items())
    a, b = rates[0, "alone"]
    assert abs(a - b) < 0.1 < rates[0, "shape"][0] - rates[0, "shape"][1]


def test_masking_replaces_spans_and_keeps_columns(spark):
    schema = "doc_id long, text string, n_chars long, spans string, base string"
    rows = [(1, "mail a@b.cd now", 15, "x", "y"), (1, "mail a@b.cd now", 15, "x", "y"), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    out = pii.masked(docs)
    assert out.schema == docs.schema
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "mail [email] now", 16, "x", "y")] * 2 + [(2, None, None, None, None)], key=str
    )


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(empty).count() == 0 and pii.masked(empty).count() == 0


def test_plan_runs_no_python(spark, docs):
    plan = pii.find(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_may_clash(spark):
    rows = [(1, "a@b.cd", "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, start int")
    assert tuple(pii.masked(docs).first()) == rows[0][:1] + ("[email]", "z", 5)

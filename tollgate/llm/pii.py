"""Personal data by weak supervision, in DataFrame operations only.

Base patterns find e-mail addresses, IP addresses, card and phone numbers that pass
their checks; these spans are always kept. Looser patterns give further candidates
(cards and addresses that fail their check, phone numbers without a plus sign, e-mail
addresses written with " at "). Labelers vote on base and further candidates alike:
1 for, -1 against, 0 for no opinion. Some look at the text of the span (the pattern's
check, its length, its grouping), some at lists (known domains, card prefixes, area
codes), some at the words around it. Spark counts the vote patterns, of which there is
a fixed number; expectation-maximisation on these counts estimates how reliable each
labeler is and how likely each pattern is personal data, without any label. A final
logistic classifier over the span's features, among them ones that no labeler votes
on, is trained on those probabilities, again from counts, and decides on candidates.

Positions are code points: the lengths of what lies between the matches, and of the
matches, add up to where each one starts.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import stored

KINDS = ["email", "ip", "card", "phone"]

# Each pattern starts where no earlier start can have failed, and never backtracks, so
# a match costs time in proportion to its text; \G lets one follow right after another.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    # a maximal run of digits, each after at most one blank or hyphen, of 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates besides the base ones. Kinds may give the same span; it is then voted on
#: once for each kind.
MORE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+(-])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9-])",
}
#: Characters before and after a span that context labelers see.
NEAR = 40
#: Fixed words and lists of the labelers.
CUES = {
    "email": "e-?mail|mailto|contact|kontakt|correo|courriel|write to|reach",
    "ip": "ip|server|host|address|login|client|router",
    "card": "card|visa|mastercard|credit|debit|karte|carte|tarjeta|payment",
    "phone": "phone|call|tel|mobile|cell|fax|telefon|whatsapp",
}
AGAINST = "version|isbn|section|chapter|figure|page|sha|token|key|hash|id[:=]"
DOMAINS = "com|org|net|edu|gov|io|de|fr|es|uk|info"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    """Whether the digits of ``x`` pass the Luhn check."""
    each = F.reverse(F.split(_digits(x), ""))
    each = F.filter(each, lambda c: c != "")
    value = F.transform(
        each,
        lambda c, i: F.when(
            i % 2 == 1, F.get(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int"))
        ).otherwise(c.cast("int")),
    )
    return F.aggregate(value, F.lit(0), lambda s, v: s + v) % 10 == 0


def _passes(kind: str, x: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.try_to_number(p, F.lit("999")) <= 255))
    if kind == "card":
        return _luhn(x)
    if kind == "phone":
        return F.length(_digits(x)).between(8, 15)
    return F.lit(True)


#: Matches whose places are summed in one fold; the blocks' places are summed in another.
_FOLD = 256


def found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of all matches, in code points from 0.

    Folding matches in blocks keeps a text of many matches from copying a growing
    array once for each.
    """
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pairs = F.zip_with(matches, F.split(text, pattern, -1), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))
    # the last gap has no match; a text without a match has one gap
    pairs = F.filter(pairs, lambda p: p["m"].isNotNull())
    none = "array<struct<start:int,end:int,match:string>>"

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["gap"])
        end = start + F.length(p["m"])
        got = F.struct(start.alias("start"), end.alias("end"), p["m"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(got)).alias("out"))

    def block(i: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(none).alias("out"))
        return F.aggregate(F.slice(pairs, i * _FOLD + 1, F.lit(_FOLD)), zero, step)

    folded = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _FOLD).cast("int")), block)

    def join(acc: Column, b: Column) -> Column:
        at = acc["at"]
        moved = F.transform(
            b["out"],
            lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["match"].alias("match")),
        )
        return F.struct((at + b["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{none}>").alias("out"))
    return F.when(F.size(pairs) > 0, F.flatten(F.aggregate(folded, zero, join)["out"])).otherwise(
        F.array().cast(none)
    )


#: A text holds no match of a kind if it lacks this.
_HINT = {"email": "@", "phone": "+"}


def _spans(text: Column, kind: str, pattern: str, base: bool) -> Column:
    hint = _HINT.get(kind) if base else None
    all_of = found(text, pattern)
    # a cheap look first: most texts hold no match
    some = F.contains(text, F.lit(hint)) if hint else text.rlike(pattern)
    got = F.when(some, all_of).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))
    place = lambda s: F.greatest(s["start"] - NEAR + 1, F.lit(1))
    return F.transform(
        got,
        lambda s: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["match"].alias("match"), F.lit(base).alias("matched"),
            (F.coalesce(_passes(kind, s["match"]), F.lit(False)) if base else F.lit(False)).alias("base"),
            F.substring(text, place(s), F.least(s["start"], F.lit(NEAR))).alias("left"),
            F.substring(text, s["end"] + 1, F.lit(NEAR)).alias("right"),
        ),
    )


def candidates_of(text: Column) -> Column:
    """Base spans and further candidates of a text, null as empty."""
    whole = F.coalesce(text, F.lit(""))
    parts = [_spans(whole, k, p, True) for k, p in BASE.items()]
    parts += [_spans(whole, k, p, False) for k, p in MORE.items()]
    return F.concat(*parts)


def candidates(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", candidates_of(F.col("text")).alias("spans"))


def _per_kind(s: Column, by: dict[str, Column]) -> Column:
    out = F.lit(False)
    for name, value in by.items():
        out = F.when(s["kind"] == KINDS.index(name), value).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.when(F.coalesce(yes, F.lit(False)), 1).when(F.coalesce(no, F.lit(False)), -1).otherwise(0)


#: The labelers, in the order of a vote pattern.
LABELERS = ("check", "shape", "list", "cue", "alone")


def votes(s: Column) -> dict[str, Column]:
    """One vote of each labeler on a span: 1, -1 or 0."""
    m, n = s["match"], F.length(_digits(s["match"]))
    near = F.lower(F.concat_ws(" ", s["left"], s["right"]))
    cue = _per_kind(s, {k: near.rlike(rf"\b(?:{c})\b") for k, c in CUES.items()})
    alone = s["left"].rlike(r"(?s)(?:^|[\s(\[<\"',;:])$")
    listed = _per_kind(
        s,
        {
            "email": m.rlike(rf"(?i)(?:\.|dot\W*)(?:{DOMAINS})$"),
            "ip": ~m.rlike(r"^(?:0|127|255)\."),
            "card": m.rlike(r"^(?:4|5[1-5]|2[2-7]|34|37|6011|65)"),
            "phone": m.rlike(r"^\+(?:1|33|34|44|49)\b|^\("),
        },
    )
    shape = _per_kind(
        s,
        {
            "email": F.length(m).between(6, 60),
            "ip": m.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$|:"),
            "card": m.rlike(r"^(?:[0-9]{16}|(?:[0-9]{4}[ -]){3}[0-9]{4})$"),
            "phone": n.between(10, 12) & m.rlike("[ ().-]"),
        },
    )
    return {
        "check": _vote(s["base"], s["matched"] & ~s["base"]),
        "shape": _vote(shape, ~shape),
        "list": _vote(listed, ~listed),
        "cue": _vote(cue, near.rlike(AGAINST)),
        "alone": _vote(alone, ~alone),
    }


def features(s: Column) -> dict[str, Column]:
    """Small whole numbers that the final classifier sees besides the kind and the votes."""
    m, left, right = s["match"], s["left"], s["right"]
    return {
        "size": F.least(F.floor(F.length(m) / 6), F.lit(5)).cast("int"),
        "signs": F.least(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), F.lit(4)),
        "before": F.when(F.length(left) == 0, 0).when(left.rlike(r"(?s)\s$"), 1).otherwise(2),
        "after": F.when(F.length(right) == 0, 0).when(right.rlike(r"^\s"), 1).otherwise(2),
    }


@dataclass
class Model:
    """The classifier's weights by feature and value, and what was learned on the way."""

    weights: dict[tuple[str, int], float] = field(default_factory=dict)
    reliability: dict[tuple[int, str], tuple[float, float]] = field(default_factory=dict)


#: Pseudo-counts of what is known of the labelers beforehand: votes for, given personal
#: data and given none. A checksum passes a tenth of random numbers; that is firmly
#: known, while the others are only expected to be right more often than not.
KNOWN = {"check": (950.0, 1000.0, 100.0, 1000.0)}
EXPECTED = (4.0, 5.0, 1.0, 5.0)


def estimate(
    counts: dict[tuple, int], rounds: int = 100
) -> tuple[dict[tuple, float], dict[tuple[int, str], tuple[float, float]]]:
    """Expectation-maximisation over vote patterns (kind, vote, ...).

    Returns each pattern's probability of being personal data, and for each kind and
    labeler how likely a vote for is given personal data and given none, abstentions
    left out. Starts from the balance of votes, the check counted four times.
    """
    post = {p: min(0.95, max(0.05, 0.5 + (4 * p[1] + sum(p[2:])) / 16)) for p in counts}
    rates: dict[tuple[int, str], tuple[float, float]] = {}
    for _ in range(rounds):
        prior, rates = {}, {}
        for kind in {p[0] for p in counts}:
            own = [p for p in counts if p[0] == kind]
            total = sum(counts[p] for p in own)
            prior[kind] = (sum(counts[p] * post[p] for p in own) + 1) / (total + 2)
            for j, name in enumerate(LABELERS, 1):
                for_one, one, for_none, none = KNOWN.get(name, EXPECTED)
                for p in own:
                    if p[j] != 0:
                        one += counts[p] * post[p]
                        none += counts[p] * (1 - post[p])
                        for_one += counts[p] * post[p] * (p[j] == 1)
                        for_none += counts[p] * (1 - post[p]) * (p[j] == 1)
                rates[kind, name] = (for_one / one, for_none / none)
        new = {}
        for p in counts:
            odds = math.log(prior[p[0]] / (1 - prior[p[0]]))
            for j, name in enumerate(LABELERS, 1):
                a, b = rates[p[0], name]
                odds += math.log(a / b) if p[j] == 1 else math.log((1 - a) / (1 - b)) if p[j] else 0
            new[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max((abs(new[p] - post[p]) for p in counts), default=0)
        post = new
        if moved < 1e-6:
            break
    return post, rates


def _fit(cells: list[tuple[tuple, float, float]], names: list[str], steps: int = 400) -> dict:
    """Logistic regression over (values, weight, probability), by gradient steps."""
    total = sum(w for _, w, _ in cells) or 1.0
    keys = [[(n, v) for n, v in zip(names, values, strict=True)] for values, _, _ in cells]
    theta: dict[tuple[str, int], float] = defaultdict(float)
    for _ in range(steps):
        grad: dict[tuple[str, int], float] = defaultdict(float)
        for own, (_, w, p) in zip(keys, cells, strict=True):
            z = sum(theta[k] for k in own)
            d = (w / total) * (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            for k in own:
                grad[k] += d
        for k, g in grad.items():
            theta[k] += 4.0 * (g - 1e-5 * theta[k])
    return dict(theta)


def train(spans: DataFrame) -> Model:
    """Learn from the candidates of all documents; what reaches the driver are counts of
    vote patterns and of feature values, whose numbers are fixed."""
    s = F.col("s")
    v, f = votes(s), features(s)
    table = (
        spans.select(F.explode("spans").alias("s"))
        .select(s["kind"].alias("kind"), *[c.alias(n) for n, c in {**v, **f}.items()])
        .groupBy("kind", *v, *f)
        .count()
        .collect()
    )
    counts: dict[tuple, int] = defaultdict(int)
    for r in table:
        counts[(r["kind"], *[r[n] for n in v])] += r["count"]
    post, rates = estimate(dict(counts))
    cells = [
        (
            (r["kind"], *[_cell(r["kind"], r[n]) for n in (*v, *f)]),
            float(r["count"]),
            post[(r["kind"], *[r[n] for n in v])],
        )
        for r in sorted(table)
    ]
    return Model(_fit(cells, ["kind", *v, *f]), rates)


def _cell(kind, value):
    """A feature's value within a kind, as one number; of numbers or of columns."""
    return kind * 100 + value + 10


def _odds(s: Column, model: Model) -> Column:
    def weight(name: str, at: Column) -> Column:
        known = sorted((k[1], w) for k, w in model.weights.items() if k[0] == name)
        if not known:
            return F.lit(0.0)
        table = F.create_map(*[F.lit(x) for pair in known for x in pair])
        return F.coalesce(F.try_element_at(table, at), F.lit(0.0))

    cells = {"kind": s["kind"], **{n: _cell(s["kind"], c) for n, c in {**votes(s), **features(s)}.items()}}
    return reduce(lambda a, b: a + b, [weight(n, c.cast("int")) for n, c in cells.items()])


def _place(s: Column) -> Column:
    return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def decided(spans: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id and two arrays of struct<kind, start, end> in order: ``base`` and ``all``.

    ``all`` holds the base spans and every candidate that the classifier finds likely
    and that meets neither a base span nor an earlier accepted candidate.
    """
    limit = math.log(least / (1 - least))
    base = F.transform(F.filter("spans", lambda s: s["base"]), _place)
    more = F.transform(F.filter("spans", lambda s: ~s["base"] & (_odds(s, model) > limit)), _place)
    meets = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    out = spans.select("doc_id", F.array_sort(base).alias("base"), F.array_sort(more).alias("more"))
    free = F.filter("more", lambda s: ~F.exists("base", lambda b: meets(s, b)))
    out = out.withColumn("more", free)
    first = F.filter("more", lambda s, i: ~F.exists(F.slice("more", 1, i), lambda b: meets(s, b)))
    return out.select("doc_id", "base", F.array_sort(F.concat("base", first)).alias("all"))


def digest(places: Column) -> Column:
    """kind:start:end of each place, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(places, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base and all of every row of ``docs`` (doc_id, text), learned on the same rows.

    A null or empty text has no span; equal texts have equal spans; no rows give no rows.
    The candidates are stored, so texts are read once.
    """
    spans = stored(candidates(docs), "pii-candidates")
    return decided(spans, train(spans))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets, and n_chars,
    where there is such a column, counted again. A null text stays null.

    The model is learned on all of ``docs``; spans are then found again on each row, so
    no text is shuffled, and rows may share a doc_id.
    """
    model = train(stored(candidates(docs), "pii-candidates"))
    # the whole row stands in for its id
    row = docs.select(F.struct(*docs.columns).alias("doc_id"))
    spans = row.withColumn("spans", candidates_of(F.col("doc_id.text")))
    out = decided(spans, model).select("doc_id.*", F.col("all").alias("__all"))
    whole = F.coalesce(F.col("text"), F.lit(""))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    by_place = F.array_sort("__all", lambda a, b: a["start"] - b["start"])

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(whole, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        text = F.concat(acc["out"], before, F.get(names, s["kind"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), text.alias("out"))

    folded = F.aggregate(by_place, zero, step)
    text = F.concat(folded["out"], F.substring(whole, folded["at"] + 1, F.length(whole)))
    changed = F.col("text").isNotNull() & (F.size("__all") > 0)
    out = out.withColumn("__text", F.when(changed, text).otherwise(F.col("text")))
    shown = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        counted = F.length("__text").cast(docs.schema["n_chars"].dataType)
        shown["n_chars"] = F.when(changed, counted).otherwise(F.col("n_chars"))
    return out.select(*[shown.get(c, F.col(c)).alias(c) for c in docs.columns])


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = find(docs)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{kind}")
        for i, kind in enumerate(KINDS)
    ]
    base = F.sha2(digest(F.col("base")), 256).alias("base_sha256")
    return out.select("doc_id", *counts, base, digest(F.col("all")).alias("spans"))


QUERIES = {"op7_personal_data": op7_personal_data}
ORACLES: dict[str, str] = {}

"""Personal data by patterns and by weak supervision, in DataFrame functions only.

Patterns find e-mail addresses, ip addresses, card and phone numbers. Loose patterns propose further
spans: masked e-mail addresses, phone numbers without a country, and secrets. Labelers vote on each
proposal: a strict pattern, a gazetteer of words before it, the characters around it, and its make.
Expectation maximisation over the counts of vote patterns estimates how far each labeler is to be
trusted, and so the probability of each pattern. A logistic classifier of votes, kind and length is
fitted to these probabilities; proposals it accepts become spans.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
#: Runs are matched from their start and without giving characters back, which finds the same spans.
#: Runs of digits that are too short or too long for a card are no candidates.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this character cannot match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

PROPOSED = ("email", "phone", "secret")
PROPOSALS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,64}+(?:\x20?[(\[]dot[)\]]\x20?[A-Za-z0-9-]{1,64}+)+",
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9])[A-Za-z0-9]{24,}+",
}
#: Words that speak for a proposal when they stand shortly before it.
GAZETTEER = {
    "email": r"(?i)\b(mail|e-mail|email|contact|write|kontakt|correo|courriel)\b",
    "phone": r"(?i)\b(tel|telephone|phone|call|fax|mobile|cell|tél|telefon|teléfono)\b",
    "secret": r"(?i)\b(token|key|secret|password|passwd|api|bearer|auth|credential)\b",
}
STRICT = {
    "email": r"[(\[]dot[)\]]\x20?[A-Za-z]{2,}$",
    "phone": r"^(\([2-9][0-9]{2}\)|[2-9][0-9]{2})[\x20.-][0-9]{3}[\x20.-][0-9]{4}$",
    "secret": r"^([0-9a-f]{32,}|[0-9A-F]{32,})$",
}
LABELERS = ("strict", "gazetteer", "around", "make")
CONTEXT = 24


#: Elements of a block of running values.
BLOCK = 512


def numbers_below(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def with_running(df: DataFrame, values: dict[str, str], add, zero: int) -> DataFrame:
    """Add columns: for each element of an array of longs what ``add`` makes of all before it.

    ``values`` names the arrays by the names of the new columns. An aggregate that appends to its
    result copies it at each step, so it takes blocks; what precedes a block comes from the totals
    of the blocks before. Arrays are arguments of ``zip_with`` and never named alone inside a
    lambda, where Spark might compute them anew for each element.
    """
    start = F.lit(zero).cast("long")

    def appended(part, begin):
        state = F.struct(begin.alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda state, v: F.struct(add(state["at"], v).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))
        return F.aggregate(part, state, step, lambda state: state["out"])

    def blocks(name):
        return numbers_below(F.ceil(F.size(name) / BLOCK))

    def block(name, b):
        return F.slice(name, b * BLOCK + 1, F.lit(BLOCK))

    def begins(name):
        return appended(F.transform(blocks(name), lambda b: F.aggregate(block(name, b), start, add)), start)

    begun = df.select("*", *(begins(name).alias(f"{out}_begins") for out, name in values.items()))
    def joined(out, name):
        return F.flatten(F.zip_with(blocks(name), f"{out}_begins", lambda b, at: appended(block(name, b), at)))

    run = begun.select("*", *(joined(out, name).alias(out) for out, name in values.items()))
    return run.drop(*(f"{out}_begins" for out in values))


def spans_of(name: str, context: bool) -> Column:
    """Spans (start, end, found) of a pattern in code points, leftmost and without overlaps.

    With ``context`` also ``before``, the CONTEXT characters before a span, and ``after``, the next
    one. They come from the pieces around it, since cutting them out of the text walks from its start;
    a find has a third of CONTEXT characters or more, so three finds back are enough.
    """
    found, gaps = F.col(f"{name}_found"), F.col(f"{name}_gaps")

    def tail(pieces, i):
        return F.coalesce(F.substring(F.get(pieces, i), -CONTEXT, CONTEXT), F.lit(""))

    def about(i):
        before = F.concat(tail(found, i - 3), tail(gaps, i - 2), tail(found, i - 2), tail(gaps, i - 1), tail(found, i - 1), tail(gaps, i))
        after = F.concat(F.substring(gaps[i + 1], 1, 1), F.coalesce(F.substring(F.get(found, i + 1), 1, 1), F.lit("")))
        return F.substring(before, -CONTEXT, CONTEXT).alias("before"), F.substring(after, 1, 1).alias("after")

    def span(i, passed):
        start = passed + F.length(gaps[i])
        return F.struct(start.alias("start"), (start + F.length(found[i])).alias("end"), found[i].alias("found"), *(about(i) if context else ()))

    return F.zip_with(numbers_below(F.size(found)), f"{name}_passed", span)


def with_spans(df: DataFrame, names: dict[str, str], needs: dict[str, str], context: bool = False) -> DataFrame:
    """Add a column of spans in ``body`` for each named pattern."""
    pattern, none = {name: F.lit(p) for name, p in names.items()}, F.array().cast("array<string>")

    def matched(name):
        all_ = F.regexp_extract_all("body", pattern[name], F.lit(0))
        return F.when(F.contains("body", F.lit(needs[name])), all_).otherwise(none) if name in needs else all_

    def size(name):
        gaps = F.col(f"{name}_gaps")
        return F.transform(f"{name}_found", lambda f, i: (F.length(gaps[i]) + F.length(f)).cast("long"))

    found = df.select("*", *(matched(name).alias(f"{name}_found") for name in names))
    gaps = found.select(
        "*", *(F.when(F.size(f"{name}_found") > 0, F.split("body", names[name], -1)).otherwise(none).alias(f"{name}_gaps") for name in names)
    )
    sizes = gaps.select("*", *(size(name).alias(f"{name}_sizes") for name in names))
    passed = with_running(sizes, {f"{name}_passed": f"{name}_sizes" for name in names}, lambda x, y: x + y, 0)
    spans = passed.select("*", *(spans_of(name, context).alias(f"{name}_spans") for name in names))
    return spans.drop(*(f"{name}_{part}" for name in names for part in ("found", "gaps", "sizes", "passed")))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a string of digits pass the check sum? Every second digit from the right counts double."""
    def add(total, i):
        digit = F.substring(F.reverse(number), i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, span: Column) -> Column:
    number = digits(span["found"])
    if kind == "ip":
        return span["found"].rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        return F.when(F.length(number).between(16, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(number).between(8, 15)
    return F.lit(True)


def base_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, body, a column of valid spans per kind)."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    spans = with_spans(texts, PATTERNS, NEEDS)

    def right(kind):
        return F.filter(f"{kind}_spans", lambda span: valid(kind, span)).alias(kind)

    return spans.select("id", "body", *map(right, KINDS))


def proposals(found: DataFrame) -> DataFrame:
    """Add the column ``proposed``: spans outside the base ones, with kind, votes and length."""
    renamed = found.select("id", "body", *KINDS)
    loose = with_spans(renamed, {f"loose_{kind}": p for kind, p in PROPOSALS.items()}, {"loose_email": "at"}, context=True)

    def described(kind):
        def describe(s):
            last = F.substring(F.rtrim(s["before"]), -1, 1)
            strict = F.when(s["found"].rlike(STRICT[kind]), 1).otherwise(-1)
            gazetteer = F.when(s["before"].rlike(GAZETTEER[kind]), 1).otherwise(0)
            around = F.when(last.isin(":", "=", '"', "'", "<", "("), 1).when(s["after"].rlike("^[A-Za-z0-9_]"), -1).otherwise(0)
            number = F.length(digits(s["found"]))
            mixed = (number > 0) & (number < F.length(s["found"])) if kind == "secret" else ~s["found"].rlike(r"([0-9])\1{5}")
            make = F.when(mixed, 0).otherwise(-1) if kind != "secret" else F.when(mixed & (number >= 6), 1).when(mixed, 0).otherwise(-1)
            return F.struct(
                s["start"].alias("start"), F.lit(True).alias("loose"), s["end"].alias("end"), F.lit(kind).alias("kind"), strict.alias("strict"),
                gazetteer.alias("gazetteer"), around.alias("around"), make.alias("make"), F.least(F.floor((s["end"] - s["start"]) / 8), F.lit(8)).cast("int").alias("length"),
            )

        return F.transform(f"loose_{kind}_spans", describe)

    kept = "array<struct<start:bigint,loose:boolean,end:bigint,kind:string,strict:int,gazetteer:int,around:int,make:int,length:int>>"
    candidates = loose.select("id", *KINDS, F.concat(*(described(kind) for kind in PROPOSED)).cast(kept).alias("candidates"))
    blank = [F.lit(None).cast("string").alias("kind"), *(F.lit(None).cast("int").alias(n) for n in (*LABELERS, "length"))]
    base = F.transform(F.concat(*KINDS), lambda s: F.struct(s["start"].alias("start"), F.lit(False).alias("loose"), s["end"].alias("end"), *blank))
    ordered = F.when(F.size("candidates") > 0, F.array_sort(F.concat(base.cast(kept), F.col("candidates")))).otherwise(F.array().cast(kept))
    return outside(candidates.select("id", *KINDS, ordered.alias("ordered"))).select("id", *KINDS, "proposed")


def outside(spans: DataFrame) -> DataFrame:
    """Add ``proposed``: the loose ones of the spans ``ordered`` by start, base ones first, that overlap no base one.

    Those before reach as far as their greatest end, those behind begin at the least start.
    """
    far = 2**62
    bounded = spans.select(
        "*",
        F.transform("ordered", lambda s: F.when(s["loose"], F.lit(-1).cast("long")).otherwise(s["end"])).alias("ends"),
        F.reverse(F.transform("ordered", lambda s: F.when(s["loose"], F.lit(far).cast("long")).otherwise(s["start"]))).alias("starts"),
    )
    reached = with_running(bounded, {"reached": "ends"}, lambda x, y: F.greatest(x, y), -1)
    both = with_running(reached, {"following": "starts"}, lambda x, y: F.least(x, y), far)
    free = F.zip_with("reached", F.reverse("following"), lambda r, f: F.struct(r.alias("from"), f.alias("to")))
    apart = F.zip_with("ordered", free, lambda s, gap: F.when(s["loose"] & (gap["from"] <= s["start"]) & (gap["to"] >= s["end"]), s))
    return both.withColumn("proposed", F.filter(apart, lambda s: s.isNotNull()))


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Probability that a proposal with each pattern of votes is personal data.

    Two-class expectation maximisation with independent labelers: each has a chance of each vote in
    either class. It starts from the majority of votes.
    """
    p = 1 / (1 + np.exp(-1.5 * votes.sum(axis=1)))
    for _ in range(rounds):
        total = np.zeros((len(votes), 2))
        for c, weight in enumerate((counts * (1 - p), counts * p)):
            total[:, c] = np.log((weight.sum() + 1) / (counts.sum() + 2))
            for j in range(votes.shape[1]):
                chance = {v: (weight[votes[:, j] == v].sum() + (2 if v == 2 * c - 1 else 1)) / (weight.sum() + 4) for v in (-1, 0, 1)}
                total[:, c] += np.log([chance[v] for v in votes[:, j]])
        p = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -30, 30)))
    return p


def features(rows) -> np.ndarray:
    return np.array([[1, *(r[k] for k in LABELERS), *(float(r["kind"] == k) for k in PROPOSED[1:]), r["length"] / 8] for r in rows], float)


def fit_spans(found: DataFrame) -> list[float]:
    """Weights of the span classifier, from votes on all proposals of all documents.

    The driver sees one row per kind, vote pattern and length class, a few hundred at most.
    """
    names = ("kind", *LABELERS, "length")
    rows = found.select(F.explode("proposed").alias("p")).groupBy(*(F.col(f"p.{n}").alias(n) for n in names)).agg(F.count(F.lit(1)).alias("times")).orderBy(*names).collect()
    if not rows:
        return [-1.0] + [0.0] * (len(LABELERS) + len(PROPOSED))
    counts = np.array([r["times"] for r in rows], float)
    p = reliabilities(np.array([[r[k] for k in LABELERS] for r in rows]), counts)
    x, w = features(rows), np.zeros(len(LABELERS) + len(PROPOSED) + 1)
    weight = counts / counts.sum()
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(bend, x.T @ (weight * (p - q)) - 1e-3 * w), -4, 4)
    return [float(v) for v in w]


def accepted(weights: list[float]) -> Column:
    """The proposals which the classifier takes for personal data."""

    def margin(s):
        inputs = itertools.chain([F.lit(1.0)], (s[k] for k in LABELERS), ((s["kind"] == k).cast("int") for k in PROPOSED[1:]), [s["length"] / 8])
        return sum((F.lit(w) * x for w, x in zip(weights, inputs)), F.lit(0.0))

    return F.filter("proposed", lambda s: margin(s) >= 0)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: list[float] | None = None) -> DataFrame:
    """(id, counts per kind, base_sha256, spans) per row of ``docs``.

    Spans are ``kind:start:end`` in code points, end exclusive, by kind and start. Counts and hash are
    those of the patterns alone; ``spans`` has the accepted proposals too, secrets last. Null texts
    are empty texts: no spans. Repeated rows and rows without an id get a row each, an empty table
    gives none. Proposals are written once to the shared folder, so the patterns run once.
    """
    found = stored(proposals(base_spans(docs, id_col, text_col)), "proposals")
    weights = fit_spans(found) if weights is None else weights
    judged = found.select("id", *KINDS, accepted(weights).alias("more"))

    def named(kind, spans):
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    def merged(kind):
        pair = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
        own = F.transform(kind, pair) if kind in KINDS else F.array().cast("array<struct<start:bigint,end:bigint>>")
        return named(kind, F.array_sort(F.concat(own, F.transform(F.filter("more", lambda s: s["kind"] == kind), pair))))

    base = F.concat(*(named(kind, F.col(kind)) for kind in KINDS))
    every = F.concat(*(merged(kind) for kind in (*KINDS, "secret")))
    return judged.select(
        F.col("id").alias(id_col), *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"),
    )


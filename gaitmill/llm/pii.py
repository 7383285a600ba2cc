"""Personal data by weak supervision.

Wide patterns propose spans. Labelers (strict pattern, usual format, gazetteer, words of
the context for and against) vote on each one or abstain. Expectation-maximisation over
the counts of vote patterns of the whole corpus estimates how reliable each labeler is,
and its posteriors train a logistic classifier over votes and shape of the span, which
decides. Spans of the strict patterns always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: A text without any of this has no candidates; checked before it goes to Python.
POSSIBLE = r"[0-9@]|[(\[]at[)\]]"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_SPELT_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]{1,63}){1,8}"
)

# Fixed values of the labelers.
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn in br ru ch at se no".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
FOR = {
    "email": "mail email e-mail contact write",
    "ip": "ip host server address login",
    "card": "card visa mastercard payment credit",
    "phone": "call phone tel telephone mobile fax",
}
AGAINST = frozenset("version section chapter page isbn issn figure release equation no nr number".split())
FORMATS = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    "ip": re.compile(r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}"),
    "card": re.compile(r"[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}|[0-9]{4}([ -]?)[0-9]{6}\2[0-9]{5}"),
    "phone": re.compile(r"(?:\+[0-9]{1,3}[ .-])?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}"),
}
LABELERS = ("strict", "format", "gazetteer", "context_for", "context_against")
#: Prior counts of the estimates: labelers are better than chance until data say more.
PRIOR_RIGHT, PRIOR_WRONG = 8.0, 2.0


@dataclass(frozen=True, order=True)
class Span:
    start: int
    kind: int
    end: int
    strict: bool


def strict_spans(text: str) -> list[Span]:
    """Matches of the base patterns, leftmost and non-overlapping for each kind."""
    found = [*_emails(text), *_addresses(text)]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(Span(m.start(), 2, m.end(), True))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append(Span(m.start(), 3, m.end(), True))
    return sorted(found)


def _emails(text: str) -> Iterator[Span]:
    """From each at sign to both sides: linear, also in one word of any length."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = at + 1
        if domain:
            free = domain.end()
            yield Span(start, 0, free, True)
        at = text.find("@", free)


def _addresses(text: str) -> Iterator[Span]:
    """Four parts at a time of every longest run of dotted numbers."""
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts = list(_PART.finditer(text, run.start(), run.end()))
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(n := p[0].lstrip("0")) < 4 and int(n or "0") <= 255 for p in four):
                yield Span(four[0].start(), 1, four[3].end(), True)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def candidate_spans(text: str) -> list[Span]:
    """Strict spans and what the wide patterns add outside them."""
    strict = strict_spans(text)
    wide = [Span(m.start(), 3, m.end(), False) for m in _LOCAL_PHONE.finditer(text)]
    if "at)" in text or "at]" in text:
        wide += [Span(m.start(), 0, m.end(), False) for m in _SPELT_EMAIL.finditer(text)]
    wide += [
        Span(m.start(), 2, m.end(), False)
        for m in _CARD.finditer(text)
        if 14 <= len(d := _digits(m[0])) <= 19 and not luhn(d)
    ]
    out, last = list(strict), -1
    taken, i = strict, 0
    for s in sorted(wide):
        while i < len(taken) and taken[i].end <= s.start:
            i += 1
        # Strict spans of several kinds may overlap; a few to the right are enough.
        clash = any(t.start < s.end and s.start < t.end for t in taken[max(0, i - 3) : i + 4])
        if s.start >= last and not clash:
            out.append(s)
            last = s.end
    return sorted(out)


def votes(text: str, span: Span) -> tuple[int, ...]:
    """For each labeler 1 for, -1 against, 0 no opinion."""
    kind, said = KINDS[span.kind], text[span.start : span.end]
    before = re.findall(r"[a-z-]+", text[max(0, span.start - 48) : span.start].lower())[-5:]
    well_formed = FORMATS[kind].fullmatch(said) is not None
    return (
        1 if span.strict else -1 if kind == "card" else 0,  # a card without checksum
        1 if well_formed else -1,
        _gazetteer(kind, said),
        1 if any(w in FOR[kind].split() for w in before) else 0,
        -1 if before and before[-1] in AGAINST else 0,
    )


def _gazetteer(kind: str, said: str) -> int:
    digits = _digits(said)
    if kind == "email":
        tail = re.split(r"[^A-Za-z]+", said.rstrip("])"))[-1].lower()
        return 1 if tail in TOP_LEVEL else 0
    if kind == "ip":
        first = int(said.split(".")[0].lstrip("0")[:4] or "0")
        return 1 if 1 <= first <= 223 and first != 127 else -1
    if kind == "card":
        return 1 if digits[0] in "3456" else -1
    if said[0] == "+":
        return 1 if any(digits[:n] in CALLING_CODES for n in (1, 2, 3)) else -1
    return 0


def shape(text: str, span: Span) -> tuple[int, int]:
    """Length in steps of four up to 32, number of separators up to 4."""
    said = text[span.start : span.end]
    return min((span.end - span.start) // 4, 8), min(sum(said.count(c) for c in " -().["), 4)


Key = tuple[int, ...]  # kind, votes, shape


def key_of(text: str, span: Span) -> Key:
    return (span.kind, *votes(text, span), *shape(text, span))


def estimate(counts: dict[Key, float], rounds: int = 50) -> tuple[dict[Key, float], dict]:
    """Posteriors by key, and the reliabilities P(vote | truth) by kind and labeler.

    A labeler that abstains says nothing. Where the data are silent the priors hold.
    """
    posterior: dict[Key, float] = {}
    reliability: dict[tuple[int, int], tuple[float, float]] = {}
    for kind in range(len(KINDS)):
        keys = [k for k in counts if k[0] == kind]
        rates = [(PRIOR_RIGHT / (PRIOR_RIGHT + PRIOR_WRONG), PRIOR_WRONG / (PRIOR_RIGHT + PRIOR_WRONG))] * len(LABELERS)
        share = 0.5
        for _ in range(rounds if keys else 0):
            for k in keys:
                odds = math.log(share / (1 - share))
                for (yes, no), vote in zip(rates, k[1:]):
                    if vote > 0:
                        odds += math.log(yes / no)
                    elif vote < 0:
                        odds += math.log((1 - yes) / (1 - no))
                posterior[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            mass = sum(counts[k] for k in keys)
            share = (1 + sum(counts[k] * posterior[k] for k in keys)) / (2 + mass)
            rates = []
            for i in range(len(LABELERS)):
                a = [PRIOR_RIGHT, PRIOR_WRONG, PRIOR_WRONG, PRIOR_RIGHT]  # yes|1 no|1 yes|0 no|0
                for k in keys:
                    if vote := k[1 + i]:
                        a[vote < 0] += counts[k] * posterior[k]
                        a[2 + (vote < 0)] += counts[k] * (1 - posterior[k])
                rates.append((a[0] / (a[0] + a[1]), a[2] / (a[2] + a[3])))
        reliability |= {(kind, i): r for i, r in enumerate(rates)}
    return posterior, reliability


def features(key: Key) -> np.ndarray:
    kind, said, form = key[0], key[1 : 1 + len(LABELERS)], key[1 + len(LABELERS) :]
    x = [1.0]
    x += [float(kind == i) for i in range(len(KINDS))]
    x += [float(v > 0) for v in said] + [float(v < 0) for v in said]
    x += [form[0] / 8, form[1] / 4]
    return np.array(x)


def train(counts: dict[Key, float], posterior: dict[Key, float], steps: int = 400) -> np.ndarray:
    """Weights of a logistic regression on the posteriors, by gradient steps over keys."""
    if not counts:
        return np.zeros(len(features((0,) * (3 + len(LABELERS)))))
    keys = sorted(counts)
    x = np.stack([features(k) for k in keys])
    y = np.array([posterior[k] for k in keys])
    w = np.array([math.log1p(counts[k]) for k in keys])
    w /= w.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ weights))
        weights -= 2.0 * (x.T @ (w * (p - y)) + 1e-4 * weights)
    return weights


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]

    def spans(self, text: str) -> list[Span]:
        """Strict spans and the candidates that the classifier takes, by start and kind."""
        w = np.array(self.weights)
        return [
            s
            for s in candidate_spans(text)
            if s.strict or features(key_of(text, s)) @ w > 0
        ]


def possible(text: Column) -> Column:
    """The text where it can hold candidates, else null: only such texts go to Python."""
    return F.when(text.rlike(POSSIBLE), text)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Estimates reliabilities and trains the classifier over all rows of ``docs``.

    Spark counts the keys; there are at most some tens of thousands, whatever the data.
    """

    @F.arrow_udf("array<array<int>>")
    def keys(texts: pa.Array) -> pa.Array:
        rows = (t.as_py() for t in texts)
        return pa.array(
            [None if t is None else [key_of(t, s) for s in candidate_spans(t)] for t in rows],
            pa.list_(pa.list_(pa.int32())),
        )

    there = docs.select(possible(F.col(text)).alias("_text")).where("_text is not null")
    counted = there.select(F.explode(keys("_text")).alias("key")).groupBy("key").count()
    counts = {tuple(r["key"]): float(r["count"]) for r in counted.collect()}
    posterior, _ = estimate(counts)
    return Model(tuple(train(counts, posterior).tolist()))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


REPORT = (
    "struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint,"
    " base_sha256: string, spans: string>"
)


def report(text: Column, model: Model) -> Column:
    """Counts and digest of the strict spans, and the list of all spans."""
    of = pa.struct(
        [(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())]
    )
    nothing = hashlib.sha256(b"").hexdigest()
    none = {f"n_{k}": 0 for k in KINDS} | {"base_sha256": nothing, "spans": ""}

    def row(text: str | None) -> dict:
        if text is None:
            return none
        spans = model.spans(text)
        base = [s for s in spans if s.strict]
        counts = {f"n_{k}": sum(s.kind == i for s in base) for i, k in enumerate(KINDS)}
        digest = hashlib.sha256(listed(base).encode()).hexdigest()
        return counts | {"base_sha256": digest, "spans": listed(spans)}

    @F.arrow_udf(REPORT)
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([row(t.as_py()) for t in texts], of)

    return found(possible(text))


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, counts by kind, ``base_sha256``, ``spans``.

    Null texts count as empty; a text without spans has zero counts, the digest of the
    empty string and an empty list; repeated rows stay; empty tables give empty ones.
    Other columns are ignored. Documents are not moved, each is read twice.
    """
    model = fit(docs, text)
    return docs.select(F.col(key).alias(key), report(F.col(text), model).alias("_r")).select(
        key, "_r.*"
    )


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with a mark in the place of each span; of overlapping ones the first."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], f"[{KINDS[s.kind].upper()}]"]
            at = s.end
        elif s.end > at:
            at = s.end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with marks in the place of personal data. Null stays null."""
    model = fit(docs, text)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        rows = (t.as_py() for t in texts)
        return pa.array(
            [None if t is None else redacted(t, model.spans(t)) for t in rows], pa.string()
        )

    return docs.withColumn(text, F.coalesce(clean(possible(F.col(text))), F.col(text)))

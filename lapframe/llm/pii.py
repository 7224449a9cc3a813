"""Personal data: high-recall generators, boosted trees, calibrated thresholds; Spark expressions only.

Four base kinds have fixed forms and checks and are always reported. Further generators propose spans
of any look: number groups, keyed values, hexadecimal runs, dashed numbers, account numbers, addresses
written out. They overlap each other and the base spans. Boosted trees score every proposal on binned
format and context features; each kind's threshold is set where its precision on the weak labels is
as wanted. The weak labels are strict checks (check digits, key forms) that the trees do not see.

All positions are code points. The patterns use possessive quantifiers, so long runs need neither
recursion nor quadratic time, and match the same spans as the plain forms.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapframe.llm.boosting import Trees, boost

BASE = ("email", "ip", "card", "phone")
EXTRA = ("number", "keyed", "hex", "dashed", "account", "written")
KINDS = (*BASE, *EXTRA)

_LOCAL = "[A-Za-z0-9._%+-]"
# A run is tried from its first character, or from where the last match ended.
PATTERN = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![0-9])[0-9](?:[\x20./-]?+[0-9]){8,}+",
    "keyed": r"(?<=(?:[Pp]assword|PASSWORD|[Pp]asswd|[Pp]wd|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Kk]ey|KEY)[\"']?\x20{0,2}[=:]\x20{0,2}[\"']?)(?<![^\x20=:\"'])[^\s\"',;]{6,}+",
    "hex": r"(?<![0-9A-Za-z])(?:[0-9a-f]{24,}+|AKIA[0-9A-Z]{16}+)(?![0-9A-Za-z])",
    "dashed": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){3,7}(?:\x20?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "written": rf"(?<!{_LOCAL}){_LOCAL}++\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?[A-Za-z0-9-]++)++",
}
# A cheap test that every text with a match passes.
HINT = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?+[0-9]){15}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
    "number": lambda t: t.rlike(r"[0-9](?:[\x20./-]?+[0-9]){8}"),
    "keyed": lambda t: t.rlike(r"(?i)(?:d|t|n|y)[\"']?\x20{0,2}[=:]"),
    "hex": lambda t: t.rlike(r"[0-9a-f]{24}|AKIA"),
    "dashed": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
    "account": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "written": lambda t: t.rlike(r"[\[(]\x20?at\x20?[\])]"),
}
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}|)"
_BEFORE = 24
# Bins per feature: kind, length, digits, letters, separators, cue before, word character beside.
BINS = (len(KINDS), 8, 8, 6, 5, 6, 2)
PRECISION = 0.9
# Least number of positive cases before a kind is trusted at all.
SUPPORT = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def running_ends(lengths: Column, chunk: int = 128) -> Column:
    """Running sums of an integer array, in two levels so that long arrays stay near linear."""

    def sums(part: Column, base: Column) -> Column:
        grown = F.aggregate(part, F.array(base), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return F.slice(grown, F.lit(2), F.greatest(F.size(grown) - 1, F.lit(0)))

    def whole(a: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(chunk))
        parts = F.transform(starts, lambda s: F.slice(a, s, F.lit(chunk)))
        bases = F.aggregate(
            parts,
            F.array(F.lit(0)),
            lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.aggregate(p, F.lit(0), lambda x, y: x + y))),
        )
        return let(
            F.struct(parts.alias("parts"), bases.alias("bases")),
            lambda v: F.flatten(F.transform(v["parts"], lambda p, i: sums(p, v["bases"][i]))),
        )

    return let(lengths, whole)


_SPAN = "array<struct<kind:int,start:int,end:int,match:string,before:string,after:string>>"


def proposals(text: Column, kind: str) -> Column:
    """All matches of a kind's pattern with positions and context, leftmost first."""
    pattern = F.lit(PATTERN[kind])
    number = F.lit(KINDS.index(kind))

    def build(v: Column) -> Column:
        # gap, match, gap, match, ...: the text is their concatenation
        lengths = F.zip_with(F.slice(v["gaps"], F.lit(1), F.size(v["matches"])), v["matches"], lambda g, m: F.char_length(g) + F.char_length(m))
        return let(
            running_ends(lengths),
            lambda ends: F.transform(
                v["matches"],
                lambda m, i: F.struct(
                    number.alias("kind"),
                    (ends[i] - F.char_length(m)).alias("start"),
                    ends[i].alias("end"),
                    m.alias("match"),
                    F.substring(v["gaps"][i], -_BEFORE, _BEFORE).alias("before"),
                    F.substring(v["gaps"][i + 1], 1, 1).alias("after"),
                ),
            ),
        )

    found = let(
        F.struct(F.split(text, PATTERN[kind], -1).alias("gaps"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("matches")),
        build,
    )
    return F.when(HINT[kind](text), found).otherwise(F.array().cast(_SPAN))


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def passes_luhn(s: Column) -> Column:
    """Whether a digit string's check digit is right."""

    def term(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    # a string of digits reversed, one element per character
    terms = F.transform(F.split(F.reverse(s), "(?!^)(?!$)"), term)
    return F.aggregate(terms, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def is_valid(kind: str, match: Column) -> Column:
    """The check of a base kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = digits_of(match)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.when(F.length(digits).between(16, 19), passes_luhn(digits)).otherwise(False)


def base_spans(text: Column) -> Column:
    """Spans of the four base kinds that pass their checks, by kind and start."""

    def valid(kind: str) -> Column:
        return F.filter(proposals(text, kind), lambda s: is_valid(kind, s["match"]))

    return F.concat(*map(valid, BASE))


def _count(s: Column, drop: str) -> Column:
    return F.char_length(F.regexp_replace(s, drop, ""))


def _bin(value: Column, limits: tuple[int, ...]) -> Column:
    out = F.lit(len(limits))
    for i in reversed(range(len(limits))):
        out = F.when(value <= limits[i], i).otherwise(out)
    return out


_CUES = (
    r"(?i)(?:password|passwd|pwd|secret|token|key)[\"']?\x20{0,2}[=:]\x20{0,2}[\"']?$",
    r"(?i)(?:tel|phone|mobile|fax|call|whatsapp)\W{0,4}$",
    r"(?i)(?:card|visa|iban|account|konto|cuenta|compte)\W{0,4}$",
    r"(?i)(?:ssn|social|passport|tax|id|no|nr)\W{0,3}$",
    r"[+(\[]\x20?$",
)


def features(s: Column) -> list[Column]:
    """Bins of a proposal; see ``BINS``. No check of ``weak_label`` is among them."""
    match, cue = s["match"], F.lit(0)
    for i, pattern in enumerate(_CUES, 1):
        cue = F.when(s["before"].rlike(pattern), i).otherwise(cue)
    beside = F.coalesce(s["before"].rlike(r"\w$") | s["after"].rlike(r"^\w"), F.lit(False))
    return [
        s["kind"],
        _bin(s["end"] - s["start"], (8, 11, 14, 17, 20, 30, 40)),
        _bin(_count(match, "[^0-9]"), (0, 3, 7, 9, 11, 15, 19)),
        _bin(_count(match, "[^A-Za-z]"), (0, 2, 5, 10, 20)),
        _bin(_count(match, r"[0-9A-Za-z]"), (0, 1, 2, 4)),
        cue,
        beside.cast("int"),
    ]


def weak_label(s: Column) -> Column:
    """1 if a strict check of the proposal's kind holds, else 0."""
    match, digits = s["match"], digits_of(s["match"])
    checks = {
        **{k: is_valid(k, match) for k in BASE},
        "number": F.when(F.length(digits).between(16, 19), passes_luhn(digits)).otherwise(False),
        "keyed": match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (F.char_length(match) >= 10),
        "hex": match.rlike("^AKIA") | s["before"].rlike(r"(?i)(?:token|secret|key|password)\W{1,5}$"),
        "dashed": ~match.rlike(r"^(?:000|666|9)|-00-|-0000$"),
        "account": F.char_length(F.regexp_replace(match, " ", "")).between(15, 34)
        & match.rlike(r"^(?:AD|AT|BE|CH|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IS|IT|LI|LT|LU|LV|MT|NL|NO|PL|PT|RO|SE|SI|SK)[0-9]{2}"),
        "written": F.lit(True),
    }
    out = F.lit(False)
    for i, kind in enumerate(KINDS):
        out = F.when(s["kind"] == i, checks[kind]).otherwise(out)
    return F.coalesce(out, F.lit(False)).cast("int")


@dataclass(frozen=True)
class Detector:
    """Trees and the margin from which each kind is redacted (absent: never)."""

    trees: Trees
    thresholds: dict[int, float]

    def selects(self, s: Column) -> Column:
        def by_kind(v: Column) -> Column:
            bins = [v[f"f{i}"] for i in range(len(BINS))]
            margin, out = self.trees.column(bins), F.lit(False)
            for kind, least in self.thresholds.items():
                out = F.when(bins[0] == kind, margin >= least).otherwise(out)
            return out

        return let(F.struct(*[f.alias(f"f{i}") for i, f in enumerate(features(s))]), by_kind)


def all_proposals(text: Column) -> Column:
    return F.concat(*[proposals(text, k) for k in KINDS])


def counted_bins(docs: DataFrame) -> DataFrame:
    """Numbers of positive and negative proposals per combination of feature bins, over all documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = docs.select(F.explode(all_proposals(text)).alias("s"))
    bins = spans.select(*[f.alias(f"f{i}") for i, f in enumerate(features(F.col("s")))], weak_label(F.col("s")).alias("label"))
    return bins.groupBy(*[f"f{i}" for i in range(len(BINS))]).agg(
        F.sum("label").cast("double").alias("positive"), F.sum(1 - F.col("label")).cast("double").alias("negative")
    )


def calibrated(trees: Trees, x: np.ndarray, positive: np.ndarray, negative: np.ndarray, precision: float = PRECISION) -> dict[int, float]:
    """Per kind the lowest margin above which the smoothed share of positives is at least ``precision``."""
    margin, out = trees.margin(x), {}
    for kind in range(len(KINDS)):
        own = np.flatnonzero(x[:, 0] == kind)
        order = own[np.argsort(-margin[own], kind="stable")]
        pos, neg = np.cumsum(positive[order]), np.cumsum(negative[order])
        last = np.append(np.diff(margin[order]) != 0, True) if len(order) else np.zeros(0, bool)
        good = (pos >= SUPPORT) & ((pos + 1) / (pos + neg + 2) >= precision * (pos + 1) / (pos + 2)) & (pos >= precision * (pos + neg)) & last
        if good.any():
            out[kind] = float(margin[order][np.flatnonzero(good)[-1]]) - 1e-9
    return out


def learn(docs: DataFrame) -> Detector:
    """Fit on all proposals of ``docs``. Only counts per combination of bins reach the driver, at most
    the product of ``BINS`` rows."""
    rows = counted_bins(docs).collect()
    x = np.array([r[: len(BINS)] for r in rows], np.int64).reshape(len(rows), len(BINS))
    order = np.lexsort(x.T[::-1]) if len(x) else np.zeros(0, np.int64)
    positive, negative = (np.array([r[c] for r in rows], float)[order] for c in ("positive", "negative"))
    trees = boost(x[order], positive, negative, unordered=frozenset({0, 5}))
    return Detector(trees, calibrated(trees, x[order], positive, negative))


def found_spans(text: Column, detector: Detector) -> Column:
    """Base spans that pass their checks and selected further ones, as ``kind, start, end``, by kind and start."""
    extra = [F.filter(proposals(text, k), detector.selects) for k in EXTRA if KINDS.index(k) in detector.thresholds]
    every = F.concat(base_spans(text), *extra)
    return F.transform(every, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def find(docs: DataFrame, detector: Detector) -> DataFrame:
    """``doc_id, spans``: array of ``kind, start, end`` (see ``KINDS``), one row per input row.

    NULL texts are empty and have none. Ids are carried through, NULL and repeated ones too. An empty
    table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", found_spans(text, detector).alias("spans"))


def redacted(text: Column, detector: Detector) -> Column:
    """The text with every found span, overlapping ones merged, replaced by its first kind in brackets.

    A text without spans, NULL included, is returned as it is.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def merge(acc: Column, s: Column) -> Column:
        head = F.slice(acc, F.lit(1), F.size(acc) - 1)
        top = F.element_at(acc, -1)
        joined = F.struct(top["start"].alias("start"), F.greatest(top["end"], s["end"]).alias("end"), top["kind"].alias("kind"))
        apart = F.concat(acc, F.array(s))
        return F.when(F.size(acc) == 0, F.array(s)).when(s["start"] < top["end"], F.concat(head, F.array(joined))).otherwise(apart)

    def rebuild(spans: Column) -> Column:
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")
        merged = F.aggregate(ordered, empty, merge)

        def pieces(m: Column) -> Column:
            before = F.transform(
                m,
                lambda s, i: F.concat(
                    let(F.when(i == 0, 0).otherwise(m[i - 1]["end"]), lambda at: text.substr(at + 1, s["start"] - at)),
                    names[s["kind"]],
                ),
            )
            tail = text.substr(F.element_at(m, -1)["end"] + 1, F.char_length(text))
            return F.concat(F.array_join(before, ""), tail)

        return let(merged, pieces)

    return let(found_spans(F.coalesce(text, F.lit("")), detector), lambda spans: F.when(F.size(spans) == 0, text).otherwise(rebuild(spans)))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame, detector: Detector) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))

    def count(i: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == i)).cast("bigint").alias(f"n_{KINDS[i]}")

    counts = [count(i) for i in range(len(BASE))]
    return find(docs, detector).select("doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(spans).alias("spans"))


def redact(docs: DataFrame, detector: Detector) -> DataFrame:
    """``docs`` with its texts redacted; all other columns as they are."""
    return docs.select(*[redacted(F.col("text"), detector).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])

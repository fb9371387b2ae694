"""Personal data: labelers vote on spans, their reliabilities are estimated, a classifier decides.

All work on texts is done by SQL functions; the driver sees counts of vote patterns only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import spare_name, stage

# The kinds that are found by rule, in the order of the result, and those the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("email_spelled", "phone_local")
LABELERS = ("form", "size", "gazetteer", "context")
VOTES = (-1, 0, 1)
# Code points before a span that the context labeler looks at.
WINDOW = 40
ROUNDS = 40
STEPS = 400

# The patterns of the base kinds. Loops that cannot profit from giving back take
# all they can, and a match starts where its first run starts, or where the last match ended.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_SPELLED = (
    r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{1,63}+"
    r"(?:(?: ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]{2,63}+){1,4}+"
)
_LOCAL = r"(?<![0-9+.,\x20-])(?<![0-9]\x20)(?:\x20)?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[-.])[0-9]{3,4}[-.\x20][0-9]{3,4}(?![0-9]|[-.,][0-9])"
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
_IP_HOLDS = rf"^(?:(?=[0-9]){_OCTET}(?:\.(?=[0-9])|$)){{4}}$"

# What the labelers look words and numbers up in.
_TOP_LEVELS = "com org net edu gov info biz io co de fr es uk eu us ch at it nl be ca au in jp br mx test example".split()
_CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 64 65 81 82 86 90 91".split()
_CARD_PREFIXES = "2 3 4 5 6".split()
_FOR = {
    "email": "e-?mail|mail|contact|write|reach|adresse|correo|courriel|kontakt",
    "ip": r"\bip\b|host|server|address|client|login|adresse",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|fax|mobile|cell|kontakt|contact|anruf|appel|llam",
}
_AGAINST = r"version|release|isbn|issn|order|invoice|serial|sku|price|page|section|chapter|\bid\b"


def matches(text: Column, pattern: str, kind: str) -> Column:
    """``array<struct<kind, start, end, match, before>>`` of the leftmost matches that do not overlap,
    in code points: what lies between the matches and the matches, taken in turn, are the text."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,match:string,before:string>>")
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("last"), empty.alias("out"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        before = F.concat(state["last"], pair["gap"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["match"].alias("match"),
            F.lower(F.right(before, F.lit(WINDOW))).alias("before"),
        )
        return F.struct(end.alias("at"), pair["match"].alias("last"), F.concat(state["out"], F.array(span)).alias("out"))

    pairs = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("match"))
    return F.when(F.size(found) > 0, F.aggregate(pairs, first, step, lambda s: s["out"])).otherwise(empty)


def luhn(digits: Column) -> Column:
    """Whether the digits' check sum holds: from the right, every second digit counts double,
    and 9 less if that is over 9."""

    def weighed(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def holds(span: Column) -> Column:
    """Whether a match of a base pattern is a span of its kind."""
    match, kind = span["match"], span["kind"]
    digits = digits_of(match)
    count = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", F.regexp_like(match, F.lit(_IP_HOLDS)))
        .when(kind == "card", F.when(count.between(13, 19), luhn(digits)).otherwise(F.lit(False)))
        .when(kind == "phone", count.between(9, 15))
        .otherwise(F.lit(False))
    )


def candidates(text: Column) -> Column:
    """All matches of all patterns, kind by kind. Texts without a kind's telling character are
    not searched for it."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,match:string,before:string>>")

    def where(telling: Column, pattern: str, kind: str) -> Column:
        return F.when(telling, matches(text, pattern, kind)).otherwise(none)

    digit = F.regexp_like(text, F.lit("[0-9][\\x20-]?[0-9]"))
    return F.concat(
        where(F.contains(text, F.lit("@")), _EMAIL, "email"),
        where(F.regexp_like(text, F.lit(r"[0-9]\.[0-9]")), _IP, "ip"),
        where(digit, _CARD, "card"),
        where(F.contains(text, F.lit("+")) & F.regexp_like(text, F.lit(r"\+[0-9]")), _PHONE, "phone"),
        where(F.regexp_like(text, F.lit(r"(?i)[\[(]dot[\])]| dot ")), _SPELLED, "email_spelled"),
        where(F.regexp_like(text, F.lit(r"[0-9][-.\x20][0-9]{3,4}(?![0-9])")), _LOCAL, "phone_local"),
    )


def _yes_no(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(-1)


def votes(span: Column) -> Column:
    """``struct`` of each labeler's vote on a candidate: 1 for, -1 against, 0 for none."""
    kind, match, before = span["kind"], span["match"], span["before"]
    count = F.length(digits_of(match))
    email, phone = kind.isin("email", "email_spelled"), kind.isin("phone", "phone_local")
    form = (
        F.when(kind == "email_spelled", _yes_no(F.regexp_like(match, F.lit(r"[\[(](?i:at)[\])]"))))
        .when(kind == "phone_local", _yes_no(F.regexp_like(match, F.lit(r"\("))))
        .otherwise(_yes_no(holds(span)))
    )
    size = (
        F.when(email, _yes_no(F.length(match).between(6, 120)))
        .when(kind == "ip", _yes_no(F.length(match).between(7, 15)))
        .when(kind == "card", _yes_no(count.isin(14, 15, 16)))
        .otherwise(_yes_no(count.between(9, 13)))
    )
    last = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1))
    gazetteer = (
        F.when(email, _yes_no(last.isin(_TOP_LEVELS)))
        .when(kind == "ip", _yes_no(~F.regexp_like(match, F.lit(r"^0*(?:0|127|255)\."))))
        .when(kind == "card", _yes_no(F.substring(match, 1, 1).isin(_CARD_PREFIXES)))
        .when(kind == "phone", _yes_no(F.regexp_extract(match, r"^\+([0-9]{1,2})", 1).isin(_CALLING_CODES)
                                       | F.substring(match, 2, 1).isin("1", "7")))
        .otherwise(F.lit(0))
    )
    words = F.lit(None).cast("boolean")
    for name in BASE:
        of_kind = email if name == "email" else phone if name == "phone" else kind == name
        words = F.when(of_kind, F.regexp_like(before, F.lit(_FOR[name]))).otherwise(words)
    context = F.when(words, 1).when(F.regexp_like(before, F.lit(_AGAINST)), -1).otherwise(0)
    return F.struct(
        *[v.cast("int").alias(n) for n, v in zip(LABELERS, (form, size, gazetteer, context), strict=True)]
    )


def with_candidates(docs: DataFrame, text: str, into: str) -> DataFrame:
    """``docs`` and a column of candidates with their votes, without the matched text."""

    def judged(span: Column) -> Column:
        base = span["kind"].isin(*BASE) & holds(span)
        return F.struct(span["kind"], span["start"], span["end"], base.alias("base"), votes(span).alias("votes"))

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumn(into, F.transform(candidates(body), judged))


@dataclass(frozen=True)
class SpanModel:
    """``reliability[kind][labeler][vote]``: how likely each vote is on a true and on a false span;
    ``bias`` and ``weights`` of the classifier, by kind, labeler and vote."""

    reliability: dict[str, dict[str, dict[int, tuple[float, float]]]]
    bias: dict[str, float]
    weights: dict[str, dict[str, dict[int, float]]]

    def score(self, span: Column) -> Column:
        """Log-odds of a candidate; a kind that the fit has not met is turned down."""
        out = F.lit(-1.0)
        for kind, bias in self.bias.items():
            z = F.lit(bias)
            for labeler in LABELERS:
                vote = span["votes"][labeler]
                by_vote = self.weights[kind][labeler]
                z = z + F.when(vote > 0, by_vote[1]).when(vote < 0, by_vote[-1]).otherwise(by_vote[0])
            out = F.when(span["kind"] == kind, z).otherwise(out)
        return out


def vote_patterns(judged: DataFrame, spans: str) -> dict[str, dict[tuple[int, ...], int]]:
    """How often each kind got each combination of votes: at most ``3 ** labelers`` a kind."""
    rows = (
        judged.select(F.explode(spans).alias("s"))
        .groupBy("s.kind", *[F.col("s.votes")[n].alias(n) for n in LABELERS])
        .agg(F.count("*").alias("n"))
    )
    out: dict[str, dict[tuple[int, ...], int]] = {}
    for r in rows.collect():
        out.setdefault(r["kind"], {})[tuple(r[n] for n in LABELERS)] = r["n"]
    return out


def expectation_maximisation(patterns: dict[tuple[int, ...], int]) -> tuple[dict, dict[tuple[int, ...], float]]:
    """Two classes, votes independent within each. Starts from the majority vote; counts are
    smoothed so that a labeler is better than chance before any data. Returns each labeler's
    vote probabilities and each pattern's probability of being a true span."""
    posterior = {p: 1 / (1 + math.exp(-2.0 * sum(p))) for p in patterns}
    reliability: dict = {}
    for _ in range(ROUNDS):
        true = sum(n * posterior[p] for p, n in patterns.items())
        total = sum(patterns.values())
        prior = (true + 1) / (total + 2)
        for i, labeler in enumerate(LABELERS):
            counts = {v: [1.0 + (v == 1), 1.0 + (v == -1)] for v in VOTES}
            for p, n in patterns.items():
                counts[p[i]][0] += n * posterior[p]
                counts[p[i]][1] += n * (1 - posterior[p])
            sums = [sum(c[k] for c in counts.values()) for k in (0, 1)]
            reliability[labeler] = {v: (c[0] / sums[0], c[1] / sums[1]) for v, c in counts.items()}
        for p in patterns:
            z = math.log(prior / (1 - prior))
            for i, labeler in enumerate(LABELERS):
                a, b = reliability[labeler][p[i]]
                z += math.log(a / b)
            posterior[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return reliability, posterior


def fit_classifier(patterns: dict[tuple[int, ...], int], target: dict[tuple[int, ...], float]) -> tuple[float, dict]:
    """Logistic regression on the votes, one weight for each labeler and vote, by gradient steps
    over the patterns; the targets are the estimated probabilities."""
    total = sum(patterns.values())
    bias = 0.0
    weights = {labeler: {v: float(v) for v in VOTES} for labeler in LABELERS}
    for _ in range(STEPS):
        step_bias = 0.0
        step = {labeler: dict.fromkeys(VOTES, 0.0) for labeler in LABELERS}
        for p, n in patterns.items():
            z = bias + sum(weights[labeler][v] for labeler, v in zip(LABELERS, p, strict=True))
            error = n / total * (target[p] - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            step_bias += error
            for labeler, v in zip(LABELERS, p, strict=True):
                step[labeler][v] += error
        bias += step_bias
        for labeler in LABELERS:
            for v in VOTES:
                weights[labeler][v] += step[labeler][v] - 1e-4 * weights[labeler][v]
    return bias, weights


def fit_spans(judged: DataFrame, spans: str) -> SpanModel:
    """The model of all candidates in ``judged``."""
    reliability, bias, weights = {}, {}, {}
    for kind, patterns in sorted(vote_patterns(judged, spans).items()):
        reliability[kind], target = expectation_maximisation(patterns)
        bias[kind], weights[kind] = fit_classifier(patterns, target)
    return SpanModel(reliability, bias, weights)


def decided(spans: Column, model: SpanModel) -> tuple[Column, Column]:
    """The base spans, and all spans: those, and added ones that the classifier takes and that
    overlap no base span; each by kind, then start."""
    base = F.filter(spans, lambda s: s["base"])
    # The classifier cannot turn a base span down: those are fixed by their rule.
    added = F.filter(spans, lambda s: s["kind"].isin(*ADDED) & (model.score(s) >= 0))
    apart = F.filter(
        added, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    return base, F.concat(base, apart)


def spelled(spans: Column) -> Column:
    one = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(one, ",")


def find_personal_data(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``docs``.

    Base spans are those of the four fixed patterns that pass their checks (octets up to 255;
    13 to 19 digits and Luhn; 9 to 15 digits); the counts and the digest are theirs. Spelled-out
    e-mail addresses and phone numbers without a country code are candidates: four labelers
    (form, size, gazetteer, context) vote on them and on the matches of the base patterns,
    expectation-maximisation over all of them estimates how reliable each vote is, and a
    classifier trained on its probabilities decides which candidates are added. They are kinds
    of their own, after the base kinds. Offsets are code points, the end exclusive.

    A null or empty text has no spans; a null key stays; repeated rows are repeated; no rows
    give no rows. Other columns are not looked at.
    """
    judged = stage(with_candidates(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), "t", "s").drop("t"), "pii")
    model = fit_spans(judged, "s")
    base, spans = decided(F.col("s"), model)

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return judged.select(
        F.col("k").alias(key), *counts, F.sha2(spelled(base), 256).alias("base_sha256"), spelled(spans).alias("spans")
    )


def masked(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with every span found in ``text`` replaced by its kind in angle brackets. The
    model is fitted in a pass of its own; texts without spans, and nulls, are left as they are."""
    name = spare_name(docs, "spans")
    judged = with_candidates(docs, text, name)
    _, spans = decided(F.col(name), fit_spans(judged.select(name), name))
    inside = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    body = F.col(text)
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        # Spans of two base kinds may overlap; what an earlier one has covered is not given again.
        gap = F.substring(body, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        mark = F.when(s["end"] > state["at"], F.concat(gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], mark).alias("out"))

    clean = F.aggregate(
        inside, first, step, lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body)))
    )
    return judged.withColumn(text, F.when(F.size(inside) > 0, clean).otherwise(body)).drop(name)

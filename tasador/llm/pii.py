"""Personal data in whole texts, by weak supervision, in Spark's own expressions.

Regular expressions propose spans. Labelers vote on each: the strict form of
its kind, a gazetteer of known parts (domains, country codes, issuers,
prefixes), words in the text before it, and what it borders on. Expectation
maximisation estimates how reliable each labeler is from the counts of the
vote patterns, without labels, and its posteriors train a logistic span
classifier. Spans of the four base kinds always stay; spans of the other
kinds are added where the classifier says so.

Counts of vote patterns are at most kinds x 3^4 rows however large the corpus
is, so they are the only thing that reaches the driver.

Positions are code points, end exclusive. Matches of a kind are the leftmost
non-overlapping ones; a match that fails its check is dropped. Patterns do not
backtrack over long runs. Defined results: null text is empty and has no span;
rows are independent of each other, so repeated rows and ids give repeated
results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "ssn", "iban", "local_phone")
KINDS = BASE_KINDS + ADDED_KINDS


def _run(cls: str) -> str:
    """Start of a run of ``cls``, or the end of the match before."""
    return rf"(?:\G|(?<!{cls}))"


_LOCAL = "[A-Za-z0-9._%+-]"
_TOKEN = "[A-Za-z0-9_/+-]"
#: Possessive forms of the patterns; they match what the plain ones match.
PATTERNS = {
    "email": rf"{_run(_LOCAL)}{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": rf"{_run(_TOKEN)}(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z]){_TOKEN}{{16,}}+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+().-])(?<!\+[0-9][\x20])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
}
#: Strict forms, for the first labeler.
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}$",
    "ip": r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$",
    "card": r"^(?:[0-9]{14,19}|(?:[0-9]{4}[ -]){3}[0-9]{2,7})$",
    "phone": r"^\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}$",
    "secret": r"^(?:[A-Z]{4}[A-Z0-9]{16}|[0-9a-f]{16,64}|[a-z]{2,4}[_-][A-Za-z0-9_-]{16,})$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$",
    "local_phone": r"^(?:\([2-9][0-9]{2}\) |[2-9][0-9]{2}[-.])[0-9]{3}[-.][0-9]{4}$",
}
#: Known parts of a span, for the second labeler.
GAZETTEERS = {
    "email": r"\.(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ca)$",
    "ip": r"^(?!0|10\.|127\.|169\.254\.|192\.168\.|22[4-9]|2[345][0-9])",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "secret": r"^(?:AKIA|ASIA|AIza|gh[pous]_|xox[bp]-|sk[_-]|pk[_-])",
    "ssn": r"^(?:00[1-9]|0[1-9]|[1-6])",
    "iban": r"^(?:DE|FR|ES|IT|GB|NL|BE|AT|CH|PT|IE|LU|PL|SE|DK|NO|FI)",
    "local_phone": r"^\(?(?:[2-9][0-8][0-9])",
}
#: Words shortly before a span, for the third labeler.
CONTEXTS = {
    "email": r"(?i)mail|contact|write|correo|courriel|schreib",
    "ip": r"(?i)\bip\b|address|host|server|client|login",
    "card": r"(?i)card|visa|master|pay|karte|carte|tarjeta",
    "phone": r"(?i)phone|\btel|call|fax|mobil|ruf|appel|llam",
    "secret": r"(?i)pass(?:word|wd)?\s*[=:]|secret|token|api.?key|\bkey\s*[=:]",
    "ssn": r"(?i)\bssn\b|social",
    "iban": r"(?i)iban|konto|account|compte|cuenta",
    "local_phone": r"(?i)phone|\btel|call|fax|mobil",
}
LABELERS = ("strict", "known", "context", "border")


def _checked(kind: str, match: Column) -> Column:
    if kind == "ip":
        def small(part):
            digits = F.ltrim(part, F.lit("0"))
            return (F.length(digits) < 3) | ((F.length(digits) == 3) & (digits <= "255"))

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        digits = F.regexp_replace(match, "[^0-9]", "")
        n = F.length(digits)

        def add(total, i):
            digit = F.substring(digits, i, F.lit(1)).cast("int")
            twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
            return total + F.when((n - i) % 2 == 1, twice).otherwise(digit)

        luhn = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0
        return F.when(n.between(14, 19), luhn).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


_SPAN = "struct<kind:int,first:int,last:int,span:string,before:string,after:string>"
_EMPTY = f"array<{_SPAN}>"


def _matches(text: Column, kind: str) -> Column:
    """Spans of a kind that pass its check, with the text around them.

    The text is split at the matches; lengths of pieces and matches add up to
    the positions.
    """
    pattern = PATTERNS[kind]
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("span"),
    )
    code = KINDS.index(kind)

    def step(state, part):
        first = state["at"] + F.char_length(part["piece"])
        last = first + F.char_length(part["span"])
        span = F.struct(
            F.lit(code).alias("kind"), first.alias("first"), last.alias("last"),
            part["span"].alias("span"), F.right(part["piece"], F.lit(24)).alias("before"),
            F.substring(text, last + 1, F.lit(1)).alias("after"),
        ).cast(_SPAN)
        passes = part["span"].isNotNull() & _checked(kind, part["span"])
        return F.struct(
            F.coalesce(last, first).alias("at"),
            F.when(passes, F.concat(state["found"], F.array(span)))
            .otherwise(state["found"]).alias("found"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_EMPTY).alias("found"))
    found = F.aggregate(parts, start, step, lambda state: state["found"])
    sign = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}.get(kind)
    return F.when(text.contains(sign), found).otherwise(F.array().cast(_EMPTY)) if sign else found


def candidates(text: Column) -> Column:
    """Checked spans of all kinds, in the order of KINDS, as one array."""
    found = F.concat(*[_matches(text, kind) for kind in KINDS])
    # All kinds but email have digits; most texts are done with one look.
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(_EMPTY))


def _by_kind(kind: Column, values: dict[str, Column]) -> Column:
    chain = F
    for i, name in enumerate(KINDS):
        chain = chain.when(kind == i, values[name])
    return chain


def votes(span: Column) -> Column:
    """One vote of each labeler: 1 for, -1 against, 0 none."""
    def told(patterns, value, against):
        hit = _by_kind(span["kind"], {k: value.rlike(patterns[k]) for k in KINDS})
        return F.when(hit, 1).otherwise(against)

    word = "[A-Za-z0-9_]"
    inside = span["before"].rlike(f"{word}$") | span["after"].rlike(f"^{word}")
    return F.struct(
        told(STRICT, span["span"], -1).alias("strict"),
        told(GAZETTEERS, span["span"], 0).alias("known"),
        told(CONTEXTS, span["before"], 0).alias("context"),
        F.when(inside, -1).otherwise(1).alias("border"),
    )


@dataclass(frozen=True)
class Model:
    """Reliabilities by kind and labeler, and the classifier's weights."""

    reliabilities: dict[str, dict[str, tuple[float, float]]]
    bias: dict[str, float]
    weights: tuple[float, ...]

    def probability(self, span: Column) -> Column:
        vote = votes(span)
        score = _by_kind(span["kind"], {k: F.lit(self.bias[k]) for k in KINDS})
        for name, weight in zip(LABELERS, self.weights):
            score = score + F.lit(weight) * vote[name]
        return 1 / (1 + F.exp(-score))


def _em(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 30):
    """Posterior of each pattern, and P(for | real), P(for | not real) of each labeler.

    A labeler that abstains says nothing. Pseudo-counts start all labelers as
    better than chance and keep small kinds near that.
    """
    prior, hits = 0.5, [(0.8, 0.3)] * len(LABELERS)
    posteriors: list[float] = []
    for _ in range(rounds):
        posteriors = []
        for vote, _n in patterns:
            odds = math.log(prior / (1 - prior))
            for v, (real, false) in zip(vote, hits):
                if v:
                    odds += math.log(real / false if v > 0 else (1 - real) / (1 - false))
            posteriors.append(1 / (1 + math.exp(-odds)))
        weight = sum(n for _, n in patterns)
        prior = (1 + sum(p * n for p, (_, n) in zip(posteriors, patterns))) / (2 + weight)
        hits = []
        for i in range(len(LABELERS)):
            said = [(v[i], p, n) for p, (v, n) in zip(posteriors, patterns) if v[i]]
            real = (8 + sum(p * n for v, p, n in said if v > 0)) / (10 + sum(p * n for _, p, n in said))
            false = (3 + sum((1 - p) * n for v, p, n in said if v > 0)) / (
                10 + sum((1 - p) * n for _, p, n in said))
            hits.append((real, false))
    return posteriors, hits


def _logistic(rows: list[tuple[str, tuple[int, ...], float, float]], rounds: int = 300):
    """Weights of a logistic model for soft labels; rows: kind, votes, label, weight."""
    bias, weights = dict.fromkeys(KINDS, 0.0), [0.5] * len(LABELERS)
    total = sum(w for *_, w in rows) or 1.0
    share = {k: sum(w for kind, *_, w in rows if kind == k) or 1.0 for k in KINDS}
    for _ in range(rounds):
        slope_b, slope_w = dict.fromkeys(KINDS, 0.0), [-1e-3 * w for w in weights]
        for kind, vote, label, weight in rows:
            score = bias[kind] + sum(a * b for a, b in zip(weights, vote))
            error = (label - 1 / (1 + math.exp(-score))) * weight
            slope_b[kind] += error / share[kind]
            for i, v in enumerate(vote):
                slope_w[i] += error * v / total
        for k in KINDS:
            bias[k] += slope_b[k]
        weights = [w + s for w, s in zip(weights, slope_w)]
    return bias, tuple(weights)


def fit(docs: DataFrame) -> Model:
    """Reliabilities and classifier from all documents, without labels."""
    spans = docs.select(F.explode(candidates(F.coalesce("text", F.lit("")))).alias("span"))
    counted = spans.select(F.col("span.kind").alias("kind"), votes(F.col("span")).alias("vote"))
    table = counted.groupBy("kind", "vote").agg(F.count("*").alias("n")).collect()
    reliabilities, rows = {}, []
    for i, kind in enumerate(KINDS):
        own = sorted((tuple(r["vote"]), r["n"]) for r in table if r["kind"] == i)
        posteriors, hits = _em(own)
        reliabilities[kind] = dict(zip(LABELERS, hits))
        # Every kind counts alike, however often it occurs.
        weight = sum(n for _, n in own)
        rows += [(kind, v, p, n / weight) for p, (v, n) in zip(posteriors, own)]
    bias, weights = _logistic(rows)
    return Model(reliabilities, bias, weights)


def annotate(docs: DataFrame, model: Model, column: str = "pii") -> DataFrame:
    """Add an array of spans (kind code, first, last, probability), by first, then kind."""
    def scored(span):
        return F.struct(
            span["first"].alias("first"), span["kind"].alias("kind"), span["last"].alias("last"),
            F.round(model.probability(span), 6).alias("probability"),
        )

    found = F.transform(candidates(F.coalesce("text", F.lit(""))), scored)
    kept = F.filter(found, lambda s: (s["kind"] < len(BASE_KINDS)) | (s["probability"] >= 0.5))
    return docs.withColumn(column, F.array_sort(kept))


def digest(spans: Column) -> Column:
    """``kind:first:last`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["first"].cast("string"), s["last"].cast("string")
    )), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < len(BASE_KINDS))


def redact(docs: DataFrame, column: str = "pii") -> DataFrame:
    """Replace spans in ``text`` by the kind's name in capitals; overlapping ones merge
    under the first one's name. A text without spans, also null, stays as it is."""
    text = F.col("text")
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def step(state, span):
        between = F.substring(text, state["at"] + 1, F.greatest(span["first"] - state["at"], F.lit(0)))
        apart = span["first"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["last"]).alias("at"),
            F.when(apart, F.concat(state["parts"], F.array(between, F.get(names, span["kind"]))))
            .otherwise(state["parts"]).alias("parts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    rest = lambda s: F.concat(
        F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.char_length(text))
    )
    clean = F.when(F.size(column) > 0, F.aggregate(F.col(column), start, step, rest)).otherwise(text)
    return docs.withColumn("text", clean)

"""Personal data by weak supervision: labelers vote on spans, their reliabilities are estimated, a classifier decides.

1. Patterns give candidate spans with their places: the base kinds (email, ip, card, phone) and kinds
   of the method's own (``MORE``). A base span that passes its check always stays; one that
   fails it takes part in the estimation only.
2. Labelers vote for, against or not at all on each candidate: its form (regex), cue words and known
   endings (gazetteers), and its surroundings (context).
3. Expectation-maximisation over the counts of vote patterns estimates how often each labeler is
   right, and with it the probability that a pattern is personal data. The number of patterns is
   bounded by the votes (``KINDS`` times 3^labelers times 2^traits), whatever the number of documents.
4. A logistic regression on votes and traits is trained to these probabilities; compiled to one
   projection it decides which candidates are added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexframe.llm.common import checkpointed, let, named, packed_row, unpacked

# --- fixed values: the base patterns; possessive, and started only where a run starts or the last match ended, so that long runs stay linear ---
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: candidates of the method's own: a credential after its name, a phone number without country code, a number in groups of 3, 2 and 4, a spelled-out address
MORE = {
    "secret": r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)[\"']?[\x20\t]{0,3}[=:][\x20\t]{0,3}[\"']?[A-Za-z0-9_+/=-]{8,}+",
    "local": r"(?=[(0-9])(?<![0-9+().-][\x20]?)(?<![A-Za-z])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![\x20.-]?[0-9])",
    "social": r"(?=[0-9])(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "spelled": r"(?=[A-Za-z0-9])(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,64}+(?:\x20?[(\[]dot[)\]]\x20?[A-Za-z0-9-]{1,64}+)++",
}
KINDS = (*BASE, *MORE)
#: what a text must hold for a pattern to be tried
NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]", "phone": "\\+[0-9]", "secret": "[=:]", "local": "[0-9]{3}[\\x20.-][0-9]{4}", "social": "[0-9]-[0-9]", "spelled": "[(\\[]at[)\\]]"}
#: gazetteers: words before a span that speak for its kind, words that speak against any kind, endings of hosts
CUES = {
    "email": "mail|e-mail|email|contact|kontakt|correo|courriel|write|reply", "ip": "ip|host|server|address|addr|ping|client", "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta|iban",
    "phone": "phone|tel|call|mobile|fax|whatsapp|telefon", "secret": "token|secret|password|passwd|pwd|key", "local": "phone|tel|call|mobile|fax|cell", "social": "ssn|social|security|insurance", "spelled": "mail|contact|write|reach",
}
AGAINST = "version|release|page|pages|figure|table|section|chapter|isbn|issn|order|part|line|v|no|nr"
ENDINGS = "com|org|net|edu|gov|int|info|biz|io|co|eu|uk|de|fr|es|it|nl|at|ch|us|ca|au|jp|cn|in|br|ru"
#: characters of the surroundings that labelers see
AROUND = 24
VOTES = 5
TRAITS = 3
#: sums of runs of this many places, so that places in a text of many matches do not cost their square
RUN = 128
ROUNDS = 60
SPAN = "array<struct<start:int,stop:int,base:boolean,code:int>>"


def running(values: Column) -> Column:
    """Inclusive running sums of an array of ints, run by run."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def summed(both: Column) -> Column:
        v, sums = both["v"], both["sums"]
        heads = F.transform(sums, lambda _, b: total(F.slice(sums, 1, b)))
        return let(F.struct(v.alias("v"), heads.alias("heads")), lambda h: F.transform(h["v"], lambda _, i: F.get(h["heads"], F.floor(i / RUN).cast("int")) + total(F.slice(h["v"], F.floor(i / RUN).cast("int") * RUN + 1, i % RUN + 1))))

    runs = F.transform(F.sequence(F.lit(0), F.floor(F.size(values) / RUN).cast("int")), lambda b: total(F.slice(values, b * RUN + 1, RUN)))
    return let(F.struct(values.alias("v"), runs.alias("sums")), summed)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches as (start, stop, match, before, after), in code points, with what surrounds them."""

    def placed(x: Column) -> Column:
        gaps = F.transform(x["found"], lambda m, i: F.length(F.get(x["parts"], i)) + F.when(i > 0, F.length(F.get(x["found"], i - 1))).otherwise(0))
        return let(
            F.struct(x["parts"].alias("parts"), x["found"].alias("found"), running(gaps).alias("starts")),
            lambda y: F.transform(
                y["found"],
                lambda m, i: F.struct(
                    F.get(y["starts"], i).alias("start"), (F.get(y["starts"], i) + F.length(m)).alias("stop"), m.alias("match"),
                    F.substring(F.get(y["parts"], i), -AROUND, AROUND).alias("before"), F.substring(F.get(y["parts"], i + 1), 1, AROUND).alias("after"),
                ),
            ),
        )

    return let(F.struct(F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")), placed)


def digits(match: Column) -> Column:
    return F.translate(match, " ().+-", "")


def luhn(number: Column) -> Column:
    def fold(d: Column) -> Column:
        doubled = F.transform(d, lambda x, i: F.when(i % 2 == 1, F.when(x * 2 > 9, x * 2 - 9).otherwise(x * 2)).otherwise(x))
        return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0

    return let(F.transform(F.split(F.reverse(number), ""), lambda c: F.ascii(c) - 48), fold)


def passes(kind: str, match: Column) -> Column:
    """The check of a base kind."""
    if kind == "ip":
        return match.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?(?:\.|$)){4}$")
    if kind == "card":
        return F.when(F.length(digits(match)).between(13, 19), luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    return F.lit(True)


def votes(kind: str, m: Column) -> list[Column]:
    """The labelers' votes on a candidate: 0 none, 1 for, 2 against."""
    match, before, after = m["match"], m["before"], m["after"]

    def vote(good: Column, bad: Column) -> Column:
        return F.when(good, 1).when(bad, 2).otherwise(0)

    own = F.regexp_replace(match, r"^.*[=:][\x20\t]*[\"']?", "") if kind == "secret" else match
    form = {
        "secret": own.rlike("[0-9]") & own.rlike("[A-Za-z]") & (F.length(own) >= 16),
        "local": match.rlike(r"^\([0-9]{3}\)|^[0-9]{3}[.-][0-9]{3}[.-]"),
        "social": ~match.rlike("^(?:000|666|9)|-00-|-0000$"),
    }.get(kind, passes(kind, match))
    known = {
        "email": (match.rlike(rf"(?i)\.(?:{ENDINGS})$"), ~match.rlike(r"\.[A-Za-z]{2,}$")),
        "spelled": (match.rlike(rf"(?i)(?:{ENDINGS})$"), ~match.rlike("[A-Za-z]{2,}$")),
        "ip": (match.rlike(r"^(?:[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])\."), match.rlike(r"^0|^255\.255|\.0\.0$")),
        "card": (digits(match).rlike("^[3-6]"), digits(match).rlike("^0")),
        "phone": (digits(match).rlike("^[1-9]"), digits(match).rlike("^0")),
        "secret": (own.rlike("^[0-9a-fA-F]{16,}$|^[A-Za-z0-9_-]{20,}$"), own.rlike("(?i)example|xxxx|changeme|^[A-Za-z]+$")),
        "local": (digits(match).rlike("^[2-9]"), digits(match).rlike("^[01]")),
        "social": (F.lit(False), F.lit(False)),
    }[kind]
    same = digits(own).rlike(r"^(.)\1*$")
    return [
        vote(form, ~form),
        vote(*known),
        # cue words, close before the span
        vote(before.rlike(rf"(?i)(?:^|[^a-z])(?:{CUES[kind]})[^a-z]{{0,12}}$") if kind != "secret" else F.lit(True), before.rlike(rf"(?i)(?:^|[^a-z])(?:{AGAINST})[^a-z]{{0,3}}$")),
        # a span that is part of a longer run of letters, digits or dots is seldom one by itself
        vote(before.rlike(r"(?:^|[\s\"'(<\[:=,])$") & after.rlike(r"^(?:$|[^A-Za-z0-9_-])"), before.rlike(r"[A-Za-z0-9_.-]$") | after.rlike(r"^(?:[A-Za-z0-9_-]|\.[0-9])")),
        vote(F.length(own) >= 8, same | own.rlike(r"0123456789|1234567890")),
    ]


def traits(m: Column) -> list[Column]:
    """Yes-or-no features beside the votes."""
    return [m["match"].rlike("[A-Za-z]"), m["match"].rlike(r"[\x20()-]"), F.length(m["match"]) >= 20]


def candidates(kind: str, text: Column) -> Column:
    """The candidates of a kind as (start, stop, base, code); ``code`` holds votes and traits."""

    def judged(m: Column) -> Column:
        code = F.lit(0)
        for v in reversed(votes(kind, m)):
            code = code * 3 + v
        for i, t in enumerate(traits(m)):
            code = code + F.when(t, 3**VOTES << i).otherwise(0)
        # of a credential the value is the span, without its name
        start = m["start"] if kind != "secret" else m["stop"] - F.length(F.regexp_extract(m["match"], r"[=:][\x20\t]*[\"']?([^\"']*)$", 1))
        return F.struct(start.cast("int").alias("start"), m["stop"].cast("int").alias("stop"), (passes(kind, m["match"]) if kind in BASE else F.lit(False)).alias("base"), code.cast("int").alias("code"))

    tried = F.transform(matches(text, {**BASE, **MORE}[kind]), judged)
    needs = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(NEEDS[kind])
    return F.when(needs, tried).otherwise(F.array()).cast(SPAN)


@dataclass(frozen=True)
class Judge:
    """A linear score over kind, votes and traits, and the labelers' estimated reliabilities."""

    kinds: dict[str, float]
    votes: list[tuple[float, float, float]]
    traits: list[float]
    reliability: list[tuple[float, float]]

    def score(self, kind: str, code: int) -> float:
        at, bits = code % 3**VOTES, code // 3**VOTES
        return self.kinds[kind] + sum(w[at // 3**i % 3] for i, w in enumerate(self.votes)) + sum(w for i, w in enumerate(self.traits) if bits >> i & 1)

    def accepts(self, kind: str, code: Column) -> Column:
        total = F.lit(self.kinds[kind])
        for i, w in enumerate(self.votes):
            total = total + F.get(F.array(*map(F.lit, w)), (F.floor(code / 3**i) % 3).cast("int"))
        for i, w in enumerate(self.traits):
            total = total + F.when(F.floor(code / (3**VOTES << i)) % 2 == 1, w).otherwise(0.0)
        return total > 0


def reliabilities(counts: dict[tuple[str, int], int], rounds: int = ROUNDS) -> tuple[dict[tuple[str, int], float], list]:
    """Expectation-maximisation over (kind, code) counts: probabilities of the patterns, and each labeler's vote shares.

    It starts from the majority of the votes. Every share is smoothed by one vote, and a labeler's votes
    are independent given the truth.
    """
    cast = {key: [key[1] % 3**VOTES // 3**i % 3 for i in range(VOTES)] for key in counts}
    belief = {key: (sum(v == 1 for v in vs) + 1) / (sum(v > 0 for v in vs) + 2) for key, vs in cast.items()}
    shares: list = []
    for _ in range(rounds):
        prior: dict[str, list[float]] = {}
        tally = [[[1.0] * 3 for _ in range(2)] for _ in range(VOTES)]
        for key in sorted(counts):
            n, p = counts[key], belief[key]
            own = prior.setdefault(key[0], [1.0, 1.0])
            own[0] += n * (1 - p)
            own[1] += n * p
            for i, v in enumerate(cast[key]):
                tally[i][0][v] += n * (1 - p)
                tally[i][1][v] += n * p
        shares = [[[x / sum(side) for x in side] for side in labeler] for labeler in tally]
        for key, vs in cast.items():
            odds = math.log(prior[key[0]][1] / prior[key[0]][0]) + sum(math.log(shares[i][1][v] / shares[i][0][v]) for i, v in enumerate(vs))
            belief[key] = 1 / (1 + math.exp(-max(-35.0, min(35.0, odds))))
    return belief, shares


def learn(counts: dict[tuple[str, int], int], rounds: int = 400, decay: float = 1e-3) -> Judge:
    """The final classifier: logistic regression to the probabilities, by gradient steps over the pattern counts.

    Without candidates it accepts nothing.
    """
    if not counts:
        return Judge({k: -1.0 for k in KINDS}, [(0.0, 0.0, 0.0)] * VOTES, [0.0] * TRAITS, [])
    belief, shares = reliabilities(counts)
    places = {key: [KINDS.index(key[0]), *(len(KINDS) + 3 * i + key[1] % 3**VOTES // 3**i % 3 for i in range(VOTES)), *(len(KINDS) + 3 * VOTES + i for i in range(TRAITS) if key[1] // 3**VOTES >> i & 1)] for key in sorted(counts)}
    # patterns weigh by the logarithm of their count, so that a frequent kind does not decide for a rare one
    weight = {key: math.log1p(counts[key]) for key in places}
    total = sum(weight.values())
    w = [0.0] * (len(KINDS) + 3 * VOTES + TRAITS)
    for _ in range(rounds):
        slope = [decay * x for x in w]
        for key, at in places.items():
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] for i in at)))))
            for i in at:
                slope[i] += weight[key] * (p - belief[key]) / total
        w = [x - 2.0 * s for x, s in zip(w, slope, strict=True)]
    rest = w[len(KINDS) :]
    seen = {key[0] for key in counts}
    return Judge(
        {k: x if k in seen else -1e9 for k, x in zip(KINDS, w, strict=False)}, [tuple(rest[3 * i : 3 * i + 3]) for i in range(VOTES)], rest[3 * VOTES :],
        [(s[1][1], s[0][2]) for s in shares],
    )


def find(spark: SparkSession, docs: DataFrame, text: str = "text") -> tuple[DataFrame, Judge]:
    """The other columns of ``docs`` with n_email, n_ip, n_card, n_phone, base_sha256 and spans, and the judge.

    Spans are ``kind:start:end`` in code points, by kind as in KINDS, then start. Null and empty texts
    have none (their base_sha256 is that of the empty string). Repeated rows are judged alike; an empty
    table gives an empty result. Columns named like a result are replaced; the text is not returned.
    """
    results = (*(f"n_{k}" for k in BASE), "base_sha256", "spans", text.lower())
    kept = [c for c in docs.columns if c.lower() not in results]
    whole = F.coalesce(named(text), F.lit(""))
    seen = checkpointed(docs.select(packed_row(kept).alias("row"), *[candidates(kind, whole).alias(kind) for kind in KINDS]))

    def coded(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["code"].alias("code")))

    patterns = seen.select(F.explode(F.concat(*map(coded, KINDS))).alias("p"))
    # at most a row per pattern, see above
    counts = {(r.kind, r.code): r.n for r in patterns.groupBy("p.kind", "p.code").agg(F.count(F.lit(1)).alias("n")).collect()}
    judge = learn(counts)

    def listed(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string")))

    def chosen(kind: str) -> Column:
        # a candidate that fails its kind's check is evidence for the estimation, but refuted as a span
        return F.filter(kind, lambda s: s["base"] if kind in BASE else judge.accepts(kind, s["code"]))

    base = {kind: F.filter(kind, lambda s: s["base"]) for kind in BASE}
    every = {kind: chosen(kind) for kind in KINDS}
    return seen.select(
        *unpacked("row", kept),
        *[F.size(spans).cast("long").alias(f"n_{kind}") for kind, spans in base.items()],
        F.sha2(F.array_join(F.concat(*[listed(k, s) for k, s in base.items()]), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*[listed(k, s) for k, s in every.items()]), ",").alias("spans"),
    ), judge

"""Personal data by weak supervision, in DataFrame operations only.

Four base kinds are found by rule: e-mail and IP addresses, card numbers that pass the
Luhn check, phone numbers. Further candidates (secrets, national ids, bank accounts, long
numbers, person names) are cut by a broad pattern, and four labelers vote on each: 1 for,
-1 against, 0 abstains. Each looks at evidence of its own: the form of the value (check
digits, number ranges, variety of characters), gazetteers (given names, common words,
country codes, prefixes of keys), words before it, signs right before it.

Per kind, expectation-maximisation estimates from the votes alone how reliable each labeler
is and how many candidates are true, and its posteriors train the final span classifier, a
logistic regression on votes and span features drawn toward the labelers' own log-odds, so
that a kind the corpus lacks is still judged. Candidates it accepts join the base spans.
Every two neighbours of a run of capitalised words are a candidate for a name; of accepted
names that overlap, those of greatest total score stay, the first ones at a tie.

Both models fit on a table of counts by kind, votes and features, taken over all documents
and bounded by the number of patterns (``5 * 3**4 * 2**3`` in theory, some dozens in
practice), so nothing that grows with the corpus reaches the driver.

Offsets are code points from 0, end exclusive. Null texts count as empty and have no
spans. Within a kind spans do not overlap, between kinds they may.

The patterns are possessive where nothing can follow, so that they neither recurse nor
backtrack over long runs: what they match equals the plain form, as a leftmost match
starts at a run's start or where the match before ended.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import stage, unused

BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
EXTRA = ("secret", "national_id", "account", "number", "person")
KINDS = (*BASE, *EXTRA)
_WORD = r"\p{Lu}[\p{Ll}\p{M}]++(?![\p{L}\p{N}_])"
# a dashed id, a token of letters and digits, a long number, two capitalised words, of which
# only the first is consumed: the second may start the next candidate. Group 1 is the candidate.
CANDIDATE = (
    r"(?<![\p{L}\p{N}_])(?=("
    r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
    r"|(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{15,}+"
    r"|[0-9]{9,}+"
    rf"|{_WORD}\x20{_WORD}"
    rf")(?![\p{{L}}\p{{N}}_]))(?:{_WORD}|\1)"
)
# Word lists of the gazetteer and context labelers (fixed values).
SECRET_WORDS = ("token", "secret", "password", "passwd", "key", "apikey", "bearer", "credential", "credentials", "auth")
KEY_PREFIXES = ("sk_", "pk_", "rk_", "ghp_", "gho_", "github_pat_", "glpat", "xoxb", "xoxp", "AKIA", "ASIA", "AIza", "eyJ", "npm_")
ID_WORDS = ("ssn", "social", "security", "insurance", "tax", "taxpayer", "passport", "licence", "license", "id")
ACCOUNT_WORDS = ("iban", "account", "konto", "kontonummer", "compte", "cuenta", "bank", "transfer")
NUMBER_WORDS = (*ID_WORDS, *ACCOUNT_WORDS, "member", "card", "phone", "tel", "telefon", "mobile", "fax", "customer")
PERSON_WORDS = (
    "mr", "mrs", "ms", "dr", "prof", "name", "contact", "signed", "dear", "regards", "author", "born", "herr", "frau", "monsieur",
    "madame", "mme", "senor", "señor", "señora", "sir",
)
COUNTRIES = (
    "AD", "AE", "AL", "AT", "AZ", "BA", "BE", "BG", "BH", "BR", "BY", "CH", "CR", "CY", "CZ", "DE", "DK", "DO", "EE", "EG", "ES",
    "FI", "FO", "FR", "GB", "GE", "GI", "GL", "GR", "GT", "HR", "HU", "IE", "IL", "IQ", "IS", "IT", "JO", "KW", "KZ", "LB", "LI",
    "LT", "LU", "LV", "MC", "MD", "ME", "MK", "MR", "MT", "MU", "NL", "NO", "PK", "PL", "PS", "PT", "QA", "RO", "RS", "SA", "SE",
    "SI", "SK", "SM", "TN", "TR", "UA", "VA", "XK",
)
GIVEN_NAMES = (
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda", "William", "Elizabeth", "David", "Barbara",
    "Richard", "Susan", "Joseph", "Jessica", "Thomas", "Sarah", "Charles", "Karen", "Daniel", "Nancy", "Matthew", "Lisa", "Anthony",
    "Margaret", "Mark", "Sandra", "Steven", "Ashley", "Andrew", "Emily", "Kenneth", "Donna", "George", "Michelle", "Kevin", "Carol",
    "Brian", "Amanda", "Edward", "Melissa", "Ronald", "Deborah", "Timothy", "Rebecca", "Jason", "Helen", "Jeffrey", "Alice",
    "Hans", "Peter", "Klaus", "Anna", "Maria", "Sophie", "Jürgen", "Wolfgang", "Stefan", "Andreas", "Sabine", "Ursula", "Monika",
    "Petra", "Heike", "Ingrid", "Matthias", "Uwe", "Günter", "Karl", "Friedrich", "Greta", "Lena", "Felix", "Jonas",
    "Pierre", "Marie", "Jean", "Claire", "Jacques", "Michel", "Philippe", "Nicolas", "François", "Camille", "Chantal",
    "Isabelle", "Nathalie", "Antoine", "Julien", "Mathieu", "Céline", "Hélène", "Louis", "Luc", "Henri", "Monique", "Sylvie",
    "Carlos", "José", "Jose", "Luis", "Carmen", "Lucia", "Lucía", "Pedro", "Laura", "Paul", "Emma", "Julia", "Juan", "Miguel",
    "Javier", "Manuel", "Ana", "Pilar", "Teresa", "Diego", "Pablo", "Sofía", "Elena", "Raúl", "Andrés", "Alejandro", "Isabel",
)
COMMON_WORDS = (
    "The", "And", "For", "That", "This", "With", "From", "You", "Not", "But", "Are", "Was", "His", "Her", "They", "Of", "To", "In",
    "Is", "It", "On", "As", "At", "By", "Or", "An", "If", "We", "He", "She", "Here", "There", "What", "When", "Where", "Who", "How",
    "Der", "Die", "Das", "Und", "Ist", "Ein", "Eine", "Nicht", "Mit", "Auf", "Für", "Von", "Sich", "Den", "Dem", "Des", "Zu",
    "Le", "La", "Les", "Et", "Un", "Une", "Dans", "Pour", "Que", "Qui", "Pas", "Sur", "Est", "Du",
    "El", "Los", "Las", "De", "En", "Por", "Para", "Con", "Una", "Del", "Se", "No", "Su",
    "License", "Public", "General", "Copyright", "Software", "Street", "Road", "House", "University", "City", "New", "North", "South",
)
CONTEXT = 24
EM_ROUNDS = 50
FIT_ROUNDS = 100
# A labeler is right with at least 0.7 when it votes, at first with 0.8; 0.2 to 0.5 of a kind's candidates are true, at first 0.3.
ACCURACY = (0.7, 0.8, 0.98)
SHARE = (0.2, 0.3, 0.5)

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    return {
        "ip": F.rlike(value, F.lit(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")),
        "card": n.between(13, 19) & F.call_function("luhn_check", _digits(value)),
        "phone": n.between(9, 15),
    }.get(kind, F.lit(True))


def _located(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """Array of (kind, start, end, value, before) of all matches that are valid.

    The gaps between matches, from split, and the matches alternate; their lengths add up
    to the places. With ``group`` 1 that group is the value, and of values with a space the
    match is the first word.
    """
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pairs = F.zip_with(gaps, values, lambda g, v: F.struct(F.length(g).alias("gap"), F.right(g, F.lit(CONTEXT)).alias("before"), v.alias("v")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["v"]), F.lit(0))
        match = F.substring_index(x["v"], " ", 1) if group else x["v"]
        before = F.right(F.concat(acc["before"], x["before"]), F.lit(CONTEXT)) if group else x["before"]
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["v"].alias("value"), before.alias("before"))
        keep = x["v"].isNotNull() & _valid(kind, x["v"])
        return F.struct(
            (start + F.coalesce(F.length(match), F.lit(0))).alias("at"),
            F.right(F.concat(before, match), F.lit(CONTEXT)).alias("before") if group else F.lit("").alias("before"),
            F.when(keep, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    none = F.array().cast(SPANS)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), none.alias("spans"))
    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(pairs, start, step)["spans"]).otherwise(none)


SPANS = "array<struct<kind:string,start:int,end:int,value:string,before:string>>"


def candidates(text: Column) -> tuple[Column, Column]:
    """Base spans and further candidates of a text, both as arrays."""
    text = F.coalesce(text, F.lit(""))
    base = F.concat(*[_located(text, kind, pattern) for kind, pattern in BASE.items()])
    return base, _located(text, "", CANDIDATE, 1)


def apart(base: Column, extra: Column) -> Column:
    """The candidates that overlap no base span, each with the kind it would be. Both must be
    columns of the frame, not expressions, which would be evaluated anew for every candidate."""
    free = F.filter(extra, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return F.transform(free, lambda c: F.struct(_shape(c).alias("kind"), *[c[x].alias(x) for x in ("start", "end", "value", "before")]))


def _near(before: Column, listed: tuple[str, ...]) -> Column:
    return F.rlike(F.lower(before), F.lit(r"(?<!\p{L})(?:" + "|".join(listed) + r")(?!\p{L})"))


def _shape(span: Column) -> Column:
    """The kind a candidate would be."""
    v = span["value"]
    return (
        F.when(F.rlike(v, F.lit("^[0-9]{3}-")), "national_id")
        .when(F.rlike(v, F.lit("^[0-9]+$")), "number")
        .when(F.contains(v, F.lit(" ")), "person")
        .when(F.rlike(v, F.lit("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$")), "account")
        .otherwise("secret")
    )


def _iban(v: Column) -> Column:
    """Whether the check digits of an account number are right."""
    turned = F.split(F.concat(F.substring(v, 5, 30), F.substring(v, 1, 4)), "(?!^)(?!$)")

    def step(acc: Column, c: Column) -> Column:
        n = F.conv(c, 36, 10).cast("int")
        return (acc * F.when(n < 10, 10).otherwise(100) + n) % 97

    return F.aggregate(turned, F.lit(0), step) == 1


def _votes(span: Column) -> list[Column]:
    """Four labelers: by form, by gazetteer, by words before, by signs right before."""
    v, before, kind = span["value"], span["before"], span["kind"]
    first, last = F.substring_index(v, " ", 1), F.substring_index(v, " ", -1)
    variety = F.size(F.array_distinct(F.split(v, "(?!^)(?!$)")))

    def by_kind(**of: Column) -> Column:
        vote = F.lit(0)
        for k, value in of.items():
            vote = F.when(kind == k, value).otherwise(vote)
        return vote

    def sign(yes: Column, no: Column | None = None) -> Column:
        vote = F.when(yes, 1)
        return (vote if no is None else vote.when(no, -1)).otherwise(0)

    never = F.lit(False)
    form = by_kind(
        national_id=F.when(F.rlike(v, F.lit("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)")), 1).otherwise(-1),
        account=F.when(_iban(v), 1).otherwise(-1),
        secret=sign(variety >= 12, variety <= 7),
        # dates and times as numbers, one digit again and again
        number=sign(never, F.rlike(v, F.lit(r"^(?:(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:[0-2][0-9]|3[01])|1[0-9]{9}(?:[0-9]{3})?$|([0-9])\1+$)"))),
        person=sign(never, (first == last) | (F.length(first) < 3) | (F.length(last) < 3)),
    )
    listed = by_kind(
        account=F.when(F.substring(v, 1, 2).isin(*COUNTRIES), 1).otherwise(-1),
        secret=sign(F.rlike(v, F.lit("^(?:" + "|".join(KEY_PREFIXES) + ")"))),
        person=F.when(first.isin(*COMMON_WORDS) | last.isin(*COMMON_WORDS), -1).when(first.isin(*GIVEN_NAMES), 1).otherwise(0),
    )
    words = by_kind(
        national_id=sign(_near(before, ID_WORDS)),
        account=sign(_near(before, ACCOUNT_WORDS)),
        secret=sign(_near(before, SECRET_WORDS)),
        number=F.when(_near(before, NUMBER_WORDS), 1).otherwise(-1),
        person=sign(_near(before, PERSON_WORDS)),
    )
    assigned = F.rlike(before, F.lit("[=:#]\\s*+[\"']?$|[\"']$"))
    signs = by_kind(
        national_id=sign(assigned),
        account=sign(assigned),
        secret=sign(assigned),
        number=F.when(assigned, 1).otherwise(-1),
        # the start of a sentence explains a capital letter
        person=sign(never, F.rlike(before, F.lit("(?:^|[.!?]\\s*|\\n\\s*)$"))),
    )
    return [form, listed, words, signs]


LABELERS = ("form", "listed", "words", "signs")
FEATURES = (*[f"{x}{s}" for x in LABELERS for s in "+-"], "long", "digits", "upper", "intercept")


def _more(span: Column) -> list[Column]:
    """Features that no labeler looks at."""
    v = span["value"]
    return [F.length(v) >= 24, F.length(_digits(v)) * 2 >= F.length(v), F.upper(v) == v]


def _pattern(span: Column) -> Column:
    votes = F.concat_ws(",", *[v.cast("string") for v in _votes(span)])
    return F.concat(span["kind"], F.lit("|"), votes, F.lit("|"), *[F.when(x, "1").otherwise("0") for x in _more(span)])


def _features(votes: list[int], more: str) -> list[float]:
    """As ``FEATURES``, of a pattern."""
    return [*[float(v == s) for v in votes for s in (1, -1)], *map(float, more), 1.0]


def reliabilities(rows: list[tuple[list[int], float]], rounds: int = EM_ROUNDS) -> tuple[list[float], list[float]]:
    """Accuracy of each labeler and posterior of each vote pattern, given as (votes, count).

    Expectation-maximisation: labelers are independent given the truth and right with one
    accuracy each when they vote, in the bounds of ``ACCURACY``; accuracies and the share of
    true spans are re-estimated, smoothed by pseudo-counts.
    """
    width = len(rows[0][0]) if rows else 0
    accuracy, share, post = [ACCURACY[1]] * width, SHARE[1], [0.0] * len(rows)
    for _ in range(rounds):
        weight = [math.log(a / (1 - a)) for a in accuracy]
        for r, (votes, _) in enumerate(rows):
            odds = math.log(share / (1 - share)) + sum(w * v for w, v in zip(weight, votes))
            post[r] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        for k in range(width):
            voted = sum(n for v, n in rows if v[k])
            right = sum(n * (p if v[k] > 0 else 1 - p) for p, (v, n) in zip(post, rows) if v[k])
            accuracy[k] = min(ACCURACY[2], max(ACCURACY[0], (10 * ACCURACY[1] + right) / (10 + voted)))
        share = min(SHARE[2], max(SHARE[0], _share(post, rows)))
    return accuracy, post


def _share(post: list[float], rows: list[tuple[list[int], float]]) -> float:
    return (10 * SHARE[1] + sum(p * n for p, (_, n) in zip(post, rows))) / (10 + sum(n for _, n in rows))


def classifier(rows: list[tuple[list[float], float, float]], toward: list[float], rounds: int = FIT_ROUNDS) -> list[float]:
    """Weights of a logistic regression on (features, soft label, count), by Newton's method.

    The penalty draws them to ``toward``, which without rows they equal.
    """
    goal = np.array(toward)
    if not rows:
        return goal.tolist()
    x, y, n = (np.array(c, float) for c in zip(*rows))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(n @ (np.logaddexp(0, z) - y * z) + (w - goal) @ (w - goal) / 2)

    weights = goal
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        slope = x.T @ (n * (p - y)) + weights - goal
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + np.eye(len(goal)), slope)
        size = 1.0
        while size > 1e-6 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return weights.tolist()


@dataclass(frozen=True)
class Model:
    """Weights by kind, as ``FEATURES``; of a kind without any nothing is accepted."""

    weights: Mapping[str, tuple[float, ...]] = field(default_factory=dict)

    def score(self, span: Column) -> Column:
        """Above 0: accepted. The span's fields must be columns or lambda variables."""
        votes, kind = _votes(span), span["kind"]
        found = F.array(*[F.when(v == s, 1.0).otherwise(0.0) for v in votes for s in (1, -1)], *[F.when(m, 1.0).otherwise(0.0) for m in _more(span)], F.lit(1.0))
        none = F.array(*[F.lit(0.0)] * len(FEATURES))
        weights = none
        for k, w in self.weights.items():
            weights = F.when(kind == k, F.array(*[F.lit(float(x)) for x in w])).otherwise(weights)
        return F.aggregate(F.zip_with(found, weights, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def fitted(counts: Mapping[str, float]) -> Model:
    """From the number of candidates by pattern."""
    weights = {}
    for kind in EXTRA:
        rows = [(p.split("|"), n) for p, n in sorted(counts.items()) if p.startswith(kind + "|")]
        votes = [([int(v) for v in p[1].split(",")], n) for p, n in rows]
        accuracy, post = reliabilities(votes)
        odds = [math.log(a / (1 - a)) for a in accuracy or [ACCURACY[1]] * len(LABELERS)]
        share = min(SHARE[2], max(SHARE[0], _share(post, votes)))
        toward = [*[s * w for w in odds for s in (1, -1)], *[0.0] * 3, math.log(share / (1 - share))]
        data = [(_features(v, p[2]), y, n) for (p, n), (v, _), y in zip(rows, votes, post)]
        weights[kind] = tuple(classifier(data, toward))
    return Model(weights)


def fit(found: DataFrame) -> Model:
    """From a frame with the candidates of all documents in column ``extra``."""
    counted = found.select(F.explode("extra").alias("s")).groupBy(_pattern(F.col("s")).alias("p")).count().collect()
    return fitted({r.p: float(r["count"]) for r in counted})


def located(docs: DataFrame) -> DataFrame:
    """Columns doc_id, base, extra: the base spans and the other candidates of each row, staged."""
    base, extra = candidates(F.col("text"))
    found = docs.select("doc_id", base.alias("base"), extra.alias("extra"))
    return stage(found.withColumn("extra", apart(F.col("base"), F.col("extra"))), "pii-candidates")


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def resolved(spans: Column) -> Column:
    """Of scored spans in order of start, each overlapping at most its neighbours, those
    without overlap of greatest total score."""
    empty = F.struct(F.lit(0.0).alias("score"), F.array().cast(SCORED).alias("spans"))

    def best(acc: Column) -> Column:
        return F.when(acc["skip"]["score"] >= acc["take"]["score"], acc["skip"]).otherwise(acc["take"])

    def step(acc: Column, x: Column) -> Column:
        free = F.when(x["start"] >= acc["end"], best(acc)).otherwise(acc["skip"])
        take = F.struct((free["score"] + x["score"]).alias("score"), F.array_append(free["spans"], x).alias("spans"))
        return F.struct(x["end"].alias("end"), take.alias("take"), best(acc).alias("skip"))

    start = F.struct(F.lit(0).alias("end"), empty.alias("take"), empty.alias("skip"))
    return F.aggregate(spans, start, step, lambda acc: best(acc)["spans"])


SCORED = "array<struct<kind:string,start:int,end:int,score:double>>"


def accepted(base: Column, extra: Column, model: Model) -> Column:
    """All spans as an array of (kind, start, end), by kind as listed, then start."""

    def plain(s: Column) -> Column:
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    scored = F.transform(
        extra,
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), model.score(s).alias("score")),
    )
    more = F.filter(scored, lambda s: s["score"] > 0)
    others = [of_kind(more, k) for k in EXTRA if k != "person"]
    found = F.transform(F.concat(*others, resolved(of_kind(more, "person"))), plain)
    return F.concat(F.transform(base, plain), found)


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """Columns doc_id, base, spans: base spans, and all spans as (kind, start, end), one row per document."""
    found = located(docs)
    model = fit(found)
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", plain.alias("base"), accepted(F.col("base"), F.col("extra"), model).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """Text with each span replaced by its kind in brackets; overlapping spans merge under the first one's kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        piece = F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        apart = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(apart, F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.lit(2147483647) - acc["at"] - 1))

    return F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, finish)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all found spans masked in text and n_chars, where present, counted anew; other columns and all rows stay."""
    model = fit(located(docs))
    base, extra, spans = unused(docs, "_base", "_extra", "_spans")
    found = docs.withColumns(dict(zip((base, extra), candidates(docs["text"]))))
    found = found.withColumn(extra, apart(F.col(base), F.col(extra)))
    found = found.withColumn(spans, accepted(F.col(base), F.col(extra), model))
    found = found.withColumn("text", masked(docs["text"], F.col(spans)))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)

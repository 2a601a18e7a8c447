import random
import re

from pyspark.sql import functions as F

from orderlake.llm import pii
from tests.llm.cases import HARD, empty, hard

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]


def nasty():
    rng = random.Random(11)
    bits = ["a", "B9", "@", ".", "-", "_", "x@y.zz", "1", "23", "255", "256", "007", " ", "+1", "(", ")", "🙂", "é", "4111 1111 1111 1111",
            "+49 30 1234567", "10.0.0.1", "1.2.3", "..", "4111111111111111", "\n", "\u00a0"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    return [*texts, "9" * 60_000, "a" * 60_000, "a" * 60_000 + "@b.c", "+1" + "(2" * 20_000, "1." * 20_000, "a@b." * 9_000, None, ""]


def test_base_spans_equal_the_plain_form(spark):
    texts = nasty()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [tuple(s) for s in r.base] for r in pii.detect(df).collect()}
    for i, text in enumerate(texts):
        assert found[i] == plain(text), text


def tokens(n):
    rng = random.Random(2)
    return ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(n)]


def planted():
    secrets = tokens(40)
    rows = [(i, f'the of that token = "{s}" onder the') for i, s in enumerate(secrets)]
    rows += [(100 + i, f"plain words and a long number {10**15 + i * 7:d} in it, nothing else Here There") for i in range(60)]
    return rows


def test_labelers_find_secrets_and_leave_numbers(spark):
    df = spark.createDataFrame(planted(), "doc_id long, text string")
    for r in pii.detect(df).collect():
        more = [s for s in r.spans if s.kind not in PATTERNS]
        assert [s.kind for s in more] == (["secret"] if r.doc_id < 100 else [])
        assert not more or more[0].end - more[0].start == 40


NAMED = [
    "written to Mr John Smith today", "Dear Anna Miller, thanks", "Contact John Smith now", "Dr Maria Müller came", "contact Kunde Peter Schmidt rief an",
    "signed Yesterday John Smith", "Regards Laura Özil Jones", "author Émile Paul Sartre Then",
]
NAMES = ["John Smith", "Anna Miller", "John Smith", "Maria Müller", "Peter Schmidt", "John Smith", "Laura Özil", "Paul Sartre"]


def test_every_pair_of_capitalised_words_is_offered(spark):
    texts = [*NAMED, "One Two Abc1 Three Four five Six Ab12345678901234 Seven Éight 123456789 Nine Ten", "Aa " * 3000, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    word = r"(?<![\w])[A-ZÖÉ][a-zöüé]+(?!\w)"
    for r in pii.located(df).collect():
        text = texts[r.doc_id] or ""
        plain = [(m.start(1), m.end(1)) for m in re.finditer(f"(?=({word} {word}))", text)]
        assert [(c.start, c.end) for c in r.extra if " " in c.value] == plain, text
        for c in r.extra:
            assert c.value == text[c.start : c.end] and c.before == text[max(0, c.start - pii.CONTEXT) : c.start]


def test_names_behind_a_capitalised_word_are_found(spark):
    weights = {"intercept": -1.0, "listed+": 2.0, "words+": 0.5}
    model = pii.Model({"person": tuple(weights.get(f, 0.0) for f in pii.FEATURES)})
    texts = [*NAMED, "the Big House of Red Brick Street"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.located(df).select("doc_id", pii.accepted(F.col("base"), F.col("extra"), model).alias("spans"))
    for r in found.collect():
        names = [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "person"]
        assert names == [*([n] for n in NAMES), []][r.doc_id]


def test_overlapping_names_are_resolved_by_score(spark):
    cases = [([2.0, 3.0], [1]), ([3.0, 2.0], [0]), ([1.0, 2.0, 3.0], [0, 2]), ([1.0, 3.0, 1.0], [1]), ([1.0, 1.0], [0]), ([], [])]
    rows = [(n, [("person", 5 * i, 5 * i + 9, x) for i, x in enumerate(scores)]) for n, (scores, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, f"n int, spans {pii.SCORED}")
    for r in df.select("n", pii.resolved(F.col("spans")).alias("spans")).collect():
        assert [s.start // 5 for s in r.spans] == cases[r.n][1]


def test_reliabilities_prefer_labelers_that_agree():
    good, bad = [1, 1, 1], [-1, -1, 1]
    accuracy, post = pii.reliabilities([(good, 500.0), (bad, 2000.0), ([1, 1, -1], 100.0)])
    assert post[0] > 0.5 > post[1]
    assert accuracy[0] > accuracy[2]
    assert pii.reliabilities([]) == ([], [])
    assert pii.classifier([], [1.0, -2.0]) == [1.0, -2.0]


def iban(country, digits):
    check = 98 - int("".join(str(int(c, 36)) for c in f"{digits}{country}00")) % 97
    return f"{country}{check:02d}{digits}"


def mixed(rng):
    return "".join(rng.choice("abcdefghijkm") + rng.choice("0123456789") for _ in range(20))


REAL = [
    ("national_id", "his ssn is 123-45-6789 now"), ("account", f"iban: {iban('DE', '370400440532013000')} and"), ("person", "met Mr John Smith there"),
    ("secret", "password = zQ81kfHs02LmXw7Ptr5"), ("number", "member number: 4839201745 is"),
]


def test_each_kind_is_fitted_and_found(spark):
    """True ones among as many and more that only look alike."""
    rng = random.Random(3)
    texts, kinds = [], []
    for i in range(400):
        n, d = rng.randint(1000, 9999), "".join(rng.choice("0123456789") for _ in range(18))
        name = f"{rng.choice(pii.GIVEN_NAMES)} {rng.choice(['Miller', 'Ortega', 'Durand'])}"
        real = [
            ("national_id", f"with ssn {rng.randint(100, 600)}-{rng.randint(10, 99)}-{n} there"), ("account", f"to iban {iban('FR', d)} soon"),
            ("person", f"we met Mrs {name} again"), ("secret", f'secret key = "{mixed(rng)}" end'), ("number", f"tax member: {n}{d[:5]} end"),
        ]
        other = [
            f"part 000-{rng.randint(10, 99)}-{n} of", f"code QQ00{d} of", "so it is. The House of", f"aaaa11{n % 2}1aaaa11aaaa in",
            f"counted {n}{d[:8]} of",
        ]
        texts += [t for _, t in real] * (i % 2) + other
        kinds += [k for k, _ in real] * (i % 2) + [None] * len(other)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.spans if s.kind not in PATTERNS] for r in pii.detect(df).collect()}
    assert [found[i] for i in range(len(texts))] == [[k] if k else [] for k in kinds]
    # the model of this corpus, and that of one without any candidate
    seen = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(REAL)], "doc_id long, text string")
    for model in (pii.fit(pii.located(df)), pii.fitted({})):
        spans = pii.located(seen).select("doc_id", pii.accepted(F.col("base"), F.col("extra"), model).alias("spans")).collect()
        assert {r.doc_id: [s.kind for s in r.spans if s.kind not in PATTERNS] for r in spans} == {i: [k] for i, (k, _) in enumerate(REAL)}


def test_account_check_digits(spark):
    values = [iban("DE", "370400440532013000"), "GB82WEST12345698765432", "GB82WEST12345698765423", "DE00370400440532013000"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(pii._iban(F.col("v"))).collect()] == [True, True, False, False]


def masked(text, spans):
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_redact(spark):
    rows = [(1, "mail a.b@c.de or 10.1.2.3, 🙂 card 4111 1111 1111 1111!"), (2, None), (2, ""), (None, "nothing"), (3, "+1 415 555 0100 4111111111111111")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [r.text for r in pii.redact(df).collect()]
    assert found == [t if not plain(t) else masked(t, plain(t)) for _, t in rows]


def test_hard_rows(spark):
    found = pii.detect(hard(spark)).collect()
    assert len(found) == len(HARD)
    done = pii.redact(hard(spark))
    assert done.columns == hard(spark).columns and done.schema["n_chars"].dataType.typeName() == "long"
    for before, after in zip(HARD, done.collect()):
        assert after.n_chars == (None if before[1] is None else len(after.text))
    assert pii.detect(empty(spark)).collect() == [] and pii.redact(empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = pii.detect(hard(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

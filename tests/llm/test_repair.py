import hashlib
import heapq
import random
import re
import zlib

from pyspark.sql import functions as F

from orderlake.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
VALID = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        body = text.strip(WHITE)
        found.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows):
    """Least (cost, audit, turns left) by trying edits in order of cost, then of the letters so far."""
    found = faults(rows)
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, roles, left = heapq.heappop(heap)
        if at == len(rows) and VALID.fullmatch(roles):
            return cost, audit, left
        # what may follow depends on the last initial, and on whether there was one
        state = (at, roles[-1:])
        if state in done or not re.fullmatch(r"s?(ua)*u?", roles):
            continue
        done.add(state)
        for name in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", at, roles + name[0], (*left, (name, ""))))
        if at < len(rows):
            role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles, left))
            if found[at] in ("", "truncated"):
                extra = found[at] == "truncated"
                initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
                heapq.heappush(heap, (cost + extra, audit + "K", at + 1, roles + initial, (*left, rows[at])))
                for name in ("user", "assistant"):
                    if role != name:
                        heapq.heappush(heap, (cost + 2 + extra, audit + "R", at + 1, roles + name[0], (*left, (name, text))))


def damaged(data):
    found = {}
    for conv, turn, role, text in data:
        rows = found.setdefault(conv, [])
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        rows += [(turn, "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    for rows in found.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return found


def brute(data):
    expected = {}
    for conv, rows in damaged(data).items():
        plain = [(role, text) for _, role, text in rows]
        numbers = {t for t, *_ in rows if t is not None}
        found = faults(plain)
        cost, audit, left = cheapest(plain)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(plain, plain[1:])]
        expected[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
        )
    return expected


def conversations():
    rng = random.Random(12)
    texts = ["Yes.", "No!", "cut", "", " \n", None, "Why? ", "a\nb.", "Ünï 🙂?", "Yes."]
    data = []
    for conv in range(400):
        turn = rng.choice([0, -3, None])
        for _ in range(rng.randint(1, 9)):
            data.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u"]), rng.choice(texts)))
            turn = rng.choice([turn, 0 if turn is None else turn + 1, 0 if turn is None else turn + 1, 5 if turn is None else turn + 3])
    data += [(None, 1, "user", "no id."), (None, None, "assistant", "no turn.")]
    # one conversation much longer than the others, half of it in order
    data += [(5000, t, "system" if t % 7 == 0 and t > 500 else "user" if t % 2 else "assistant", f"turn {t % 400}.") for t in range(1000)]
    return data


def audited(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_equals_search_by_cost(spark):
    data = conversations()
    df = spark.createDataFrame(data, SCHEMA).withColumn("present", F.lit("x")).withColumn("audit", F.lit(1)).repartition(6)
    assert audited(repair.audits(repair.damage(df), "present")) == brute(data)


def test_turns_left_are_in_order_and_hash_to_the_digest(spark, monkeypatch):
    monkeypatch.setattr(repair, "HELD_BYTES", 50)
    rows = repair.damage(spark.createDataFrame(conversations(), SCHEMA))
    lines, initials = {}, {}
    for r in sorted(repair.repaired(rows, "present").collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        initials[r.conv_id] = initials.get(r.conv_id, "") + r.role[:1]
    assert all(VALID.fullmatch(i) for i in initials.values())
    for r in repair.audits(rows, "present").collect():
        assert r.repaired_sha256 == hashlib.sha256("\n".join(lines.get(r.conv_id, [])).encode()).hexdigest()


def test_texts_beyond_the_held_bytes_read_back(monkeypatch):
    monkeypatch.setattr(repair, "HELD_BYTES", 20)
    texts, given = repair.Texts(), [("user", "x" * n + "é\n") for n in range(30)]
    for pair in given:
        texts.add(*pair)
    assert texts.file and list(texts) == given


def test_estimates_never_exceed_the_cost():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c", ""])) for _ in range(rng.randint(0, 7))]
        turns = [repair.Turn(r[0], f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(rows, faults(rows))]
        cost, audit, _ = cheapest(rows)
        assert repair.estimates(turns)[0][repair.START] <= cost
        found, edits = repair.search(turns)
        assert (found, "".join(e for e, _ in edits)) == (cost, audit)


def test_many_turns_take_linear_time():
    turns = [repair.Turn("sua?"[i * 7919 % 4], i % 11 == 0, i % 5 == 0) for i in range(50_000)]
    cost, edits = repair.search(turns)
    assert sum(e != "I" for e, _ in edits) == 50_000 and cost >= 3 * (50_000 // 11)


def test_empty(spark):
    empty = repair.damage(spark.createDataFrame([], SCHEMA))
    assert repair.audits(empty, "present").collect() == []
    assert repair.repaired(empty, "present").collect() == []

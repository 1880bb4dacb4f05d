"""Structure repair, periodic runs and personal data against plain versions of their contracts."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from foretell.llm import common, pii, repair, runs

# --- structure repair


def _plain_repair(roles, texts, longest):
    """Cheapest edits by trying all edit strings of at most ``longest`` letters, shortest paths first."""
    faults, seen = [], []
    for role, text in zip(roles, texts):
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(
            "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        )
        seen.append((role, text))
    best = None
    todo = [(0, "", 0, ())]
    while todo:
        cost, audit, row, said = todo.pop()
        if best and cost > best[0]:
            continue
        shape = "".join(role[:1] or "-" for role, _ in said)
        if not re.fullmatch("(s?(ua)*u?)?", shape):
            continue
        if row == len(roles) and re.fullmatch("(s?(ua)+)?", shape):
            best = min(best or (cost, audit, said), (cost, audit, said))
        if len(audit) == longest:
            continue
        for role in ("user", "assistant"):
            todo.append((cost + 5, audit + "I", row, (*said, (role, ""))))
        if row < len(roles):
            todo.append((cost + 2, audit + "D", row + 1, said))
            if faults[row] not in ("blank", "duplicate"):
                late = 5 if faults[row] else 0
                todo.append((cost + late, audit + "K", row + 1, (*said, (roles[row], texts[row]))))
                for role in ("user", "assistant"):
                    todo.append((cost + late + 1, audit + "R", row + 1, (*said, (role, texts[row]))))
    return faults, best


def test_repair_equals_a_search_over_all_edits():
    pick = random.Random(4)
    for _ in range(200):
        n = pick.randint(0, 5)
        roles = pick.choices(["user", "assistant", "system", "tool", ""], [5, 5, 2, 1, 1], k=n)
        texts = pick.choices(["Yes.", "No!", "cut", " ", "Why?", "Yes.\n"], k=n)
        faults, (cost, audit, said) = _plain_repair(roles, texts, n + 3)
        found = repair.repair([None] * n, roles, texts)
        assert repair.faults_of(roles, texts) == faults
        assert (found.cost, found.audit) == (cost, audit)
        assert tuple((role, text) for _, role, text in found.rows) == said


def test_pointers_read_long_paths():
    n = 3001
    found = repair.repair(list(range(n)), ["user", "assistant"] * (n // 2) + ["user"], [f"{i}." for i in range(n)])
    # the row too many is deleted where that comes first among the cheapest
    assert found.cost == 2 and found.audit == "K" * (n - 1) + "D" and len(found.rows) == n - 1
    found = repair.repair([0, 9], ["user", "user"], ["a.", "b."])
    assert (found.gaps, found.illegal, found.cost, found.audit) == (8, 1, 1, "KR")


def test_conversations_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE", 64)
    rows = [
        (1, 0, "user", "Hi.", "x"),
        (1, 1, "assistant", "Hello.", "x"),
        (2, None, None, "Odd.", "x"),  # a role of one space becomes user, and is answered or goes
        (2, 5, "assistant", None, "x"),
        (None, 0, "user", "a.", "x"),
        (None, 1, "assistant", "b.", "x"),
        (3, 0, "user", "gone", "x"),
        (4, 0, "system", "s.", "x"),
        (4, 1, "user", "long " * 5000 + ".", "x"),
        (4, 1, "user", "long " * 5000 + ".", "x"),
        (4, 2, "assistant", "cut", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, audit string")
    got = {r.conv_id: r for r in repair.summaries(df, present=~F.col("text").eqNullSafe("gone")).collect()}
    assert set(got) == {1, 2, 3, 4, None} and len(repair.summaries(df).columns) == 9
    empty = hashlib.sha256(b"").hexdigest()
    assert got[3][1:] == (0, 0, 0, 0, 0, 0, "", empty)
    assert (got[1].audit, got[1].repaired_sha256) == ("KK", hashlib.sha256(b"user:Hi.\nassistant:Hello.").hexdigest())
    assert (got[2].audit, got[2].cost, got[2].blank) == ("DD", 4, 1)
    assert (got[None].audit, got[4].duplicate, got[4].truncated) == ("KK", 1, 1)
    # two new roles and a deletion cost less than the truncated answer
    assert (got[4].audit, got[4].cost, got[4].gaps) == ("RRDD", 6, 0) and got[4].illegal == 1
    out = repair.repaired_rows(df).where("conv_id = 4").orderBy("place").collect()
    assert [(r.place, r.edit, r.role) for r in out] == [(0, "R", "user"), (1, "R", "assistant")]
    none = df.limit(0)
    assert repair.summaries(none).count() == 0 and repair.repaired_rows(none).count() == 0


def test_damage_is_dealt_by_conversation_and_turn(spark):
    df = spark.range(200).selectExpr("id % 7 as conv_id", "id as turn", "'assistant' as role", "'A. b!' as text")
    got = {}
    for r in repair.damaged(df).collect():
        got.setdefault((r.conv_id, r.turn), []).append(r)
    for (conv, turn), rows in got.items():
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        assert len(rows) == (2 if kind == 3 else 1) and rows[0].present == (kind != 0)
        assert rows[0].text == {1: "", 2: "A b"}.get(kind, "A. b!") and rows[0].role == ("user" if kind == 4 else "assistant")
    nothing = spark.createDataFrame([(None,) * 4], "conv_id bigint, turn bigint, role string, text string")
    lone = repair.damaged(nothing).first()
    assert zlib.crc32(b" : ") % 20 >= 5 and (lone.role, lone.text, lone.present) == (" ", " ", True)


# --- periodic runs


def _plain_runs(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        at = q
        while at < len(words):
            if words[at] != words[at - q]:
                at += 1
                continue
            stop = at
            while stop < len(words) and words[stop] == words[stop - q]:
                stop += 1
            if stop - at + q >= max(least, 2 * q):
                found.setdefault((at - q, stop), q)
            at = stop
    return sorted((start, stop - start, q) for (start, stop), q in found.items())


def test_runs_equal_a_comparison_at_all_distances():
    pick = random.Random(6)
    for _ in range(4000):
        words = [str(pick.randint(0, pick.choice([1, 2, 3]))) for _ in range(pick.randint(0, 40))]
        if words and pick.random() < 0.5:
            words = (words[: pick.randint(1, len(words))] * 40)[: pick.randint(1, 70)]
            words[pick.randrange(len(words))] = "9"
        least = pick.choice([2, 12])
        got = runs.find_runs(words, least)
        assert got == _plain_runs(words, least)
        # texts with more different words than letters are spelled with two
        assert runs.find_runs(words, least, letters=6) == got
        covered = set(itertools.chain.from_iterable(range(s + q, s + n) for s, n, q in got))
        assert runs.kept_words(words, got) == [w for i, w in enumerate(words) if i not in covered]


def _fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("n", [50, 144, 300])
def test_texts_rich_in_squares(n):
    stretches = ["a"] * n + ["b"] + ["a"] * (n // 2) + ["c"] + ["a"] * n
    for words in (_fibonacci(n), stretches, (["a"] * 9 + ["b"]) * (n // 10)):
        assert runs.find_runs(words, 2) == _plain_runs(words, 2)
    # comparisons grow with the text, not with its square
    assert len(runs.find_runs(_fibonacci(40_000))) > 1000


@pytest.mark.parametrize("period", [1, 2, 3, 77, 4096])
def test_long_texts_of_one_period(period):
    words = ([str(i) for i in range(period)] * 60_000)[:60_000]
    assert runs.find_runs(["x", *words, "y"]) == [(1, 60_000, period)]


def test_run_digests_of_cases(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE", 100)
    texts = [None, "", " \t\n", "one", "a b " * 8, "no-break space " * 12, "x" * 300_000, "la " * 5000]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(None, "a b " * 8, 5), (4, "a b " * 8, 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_runs bigint")
    got = runs.run_digests(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    for i in (0, 1, 2):
        assert by_id[i][1:] == (0, None, None, None, None, empty, empty)
    for r in (by_id[4], by_id[None]):
        assert tuple(r)[1:6] == (1, 0, 16, 2, 8000)
        assert r.runs_sha256 == hashlib.sha256(b"0,16,2\n").hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b"a b").hexdigest()
    assert tuple(by_id[5])[1:6] == (1, 0, 12, 1, 12000) and by_id[7].length == 5000
    whole = {r.doc_id: r for r in runs.collapse(df).collect()}
    assert whole[4].text == "a b" and whole[2].text == " \t\n" and whole[0].text == "" and len(whole[7].runs) == 1
    assert runs.run_digests(df.limit(0)).count() == 0


def test_repeated_texts_follow_their_rule(spark):
    words = [f"w{i}" for i in range(50)]
    df = spark.range(300).withColumn("text", F.lit(" ".join(words)))
    got = {r.doc_id: r for r in runs.run_digests(df, repeat=True, id_col="id").collect()}
    hit = 0
    for i in range(300):
        h = zlib.crc32(str(i).encode())
        want = list(words)
        if h % 10 == 0:
            a, hit = h // 10 % 50, hit + 1
            p = 1 + (50 - a) // (3 + h // 10 % 8)
            want = [words[j] if j < a else words[a + (j - a) % p] for j in range(50)]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in _plain_runs(want, 12))
        assert got[i].runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
    assert hit > 10


# --- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            valid = {
                "email": True,
                "ip": all(int(p) <= 255 for p in match.group().split(".")) if kind == "ip" else None,
                "card": 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if valid:
                found.append((kind, *match.span()))
    return found


def test_base_spans_equal_the_plain_patterns():
    pick = random.Random(8)
    alphabets = [("ab@.-1 ", 40), ("0123456789. -", 60), ("+12() .-a", 50), ("@a.%1é😀", 30), (".0123", 40)]
    for alphabet, length in alphabets * 1500:
        text = "".join(pick.choices(alphabet, k=pick.randint(0, length)))
        assert [tuple(s)[:3] for s in pii.find(text) if s.kind in pii.BASE] == _plain_spans(text)


def test_checksums_context_and_overlaps():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")

    def kinds(text):
        return [(s.kind, text[s.start : s.end]) for s in pii.find(text)]

    assert kinds("to GB82 WEST 1234 5698 7654 32 NOW") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("GB83 WEST 1234 5698 7654 32") == []
    assert kinds("my ssn: 123-45-6789") == [("national_id", "123-45-6789")] and kinds("123-45-6789") == []
    assert kinds("ssn 000-45-6789") == [] and kinds("part ssn 123-45-6789") == []
    assert kinds("call (555) 123-4567.") == [("local_phone", "(555) 123-4567")]
    assert kinds("phone +1 (555) 123-4567") == [("phone", "+1 (555) 123-4567")]
    assert kinds("from 2001:db8::8a2e:370:7334") == [("ipv6", "2001:db8::8a2e:370:7334")] and kinds("at 12:30:45") == []
    scores = [pii.find(t)[0].score for t in ("my card 4111111111111111", "4111111111111111", "order 4111111111111111")]
    assert scores[0] > scores[1] > scores[2] > 0
    text = "mail a.b@c.de or a.b@c.de"
    assert pii.redact(text, pii.find(text)) == "mail <email> or <email>"


@pytest.mark.parametrize("part", ["a", "1", "1.", "@", "a@", "+", "A1", "AA11 ", ":", "1:", "a.", "123-", "555-123-4567 "])
def test_long_texts_take_linear_time(part):
    text = part * (400_000 // len(part))
    assert [tuple(s)[:3] for s in pii.find(text + " x@y.zz")][0][0] == "email"


def test_pii_of_cases(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE", 50)
    texts = [None, "", "none", "😀 é me@x.org, 10.0.0.1", "4111 1111 1111 1111 +1 (555) 010-9999", "7" * 100_000]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, "me@x.org", "z"), (3, texts[3], "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = pii.pii_digests(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    nothing = hashlib.sha256(b"").hexdigest()
    for i in (0, 1, 2, 5):
        assert tuple(by_id[i])[1:] == (0, 0, 0, 0, nothing, "")
    assert by_id[3].spans == "email:4:12,ip:14:22" and by_id[None].n_email == 1
    assert by_id[4].spans == "card:0:19,phone:20:37"
    assert by_id[4].base_sha256 == hashlib.sha256(b"card:0:19,phone:20:37").hexdigest()
    clean = {r.doc_id: r.text for r in pii.redacted(df).collect()}
    assert clean[3] == "😀 é <email>, <ip>" and clean[0] == ""
    listed = {r.doc_id: r.spans for r in pii.pii_spans(df).collect()}
    assert [s.kind for s in listed[4]] == ["card", "phone"] and 0 < listed[4][0].score <= 1
    assert pii.pii_digests(df.limit(0)).count() == 0 and pii.pii_spans(df.limit(0)).count() == 0

"""Conversation repair against a shortest-path search over whole edit strings, written from the rules."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from kempt.llm import conversations

RULE = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        own = out.setdefault(conv, [])
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            own += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def repair(rows):
    """Least (cost, audit) by search over prefixes of edit strings; roles so far must be able to begin a rightful list."""
    state_of = {"": 0, "s": 1, "u": 2, "a": 3}
    follows = {(0, "s"), (0, "u"), (1, "u"), (2, "a"), (3, "u")}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, made = heapq.heappop(heap)
        state = state_of[roles[-1:]]
        if i == len(rows) and RULE.fullmatch(roles):
            return cost, audit, made
        if (i, state) in done:
            continue
        done.add((i, state))
        options = [(5, "I", i, r, "") for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            more = 5 * (fault == "truncated")
            options.append((2, "D", i + 1, None, ""))
            if fault not in ("blank", "duplicate"):
                options += [(more + 1, "R", i + 1, r, text) for r in ("user", "assistant")]
                if role[:1] in ("s", "u", "a"):
                    options.append((more, "K", i + 1, role, text))
        for paid, edit, k, role, text in options:
            if role is None:
                heapq.heappush(heap, (cost + paid, audit + edit, k, roles, made))
            elif (state, role[0]) in follows:
                heapq.heappush(heap, (cost + paid, audit + edit, k, roles + role[0], (*made, f"{role}:{text}")))


def brute(rows):
    out = []
    for conv, own in damaged(rows).items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        faults = [f for _, _, f in judged]
        cost, audit, made = repair(judged)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:])), cost, audit,
                    hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=str)


def ours(spark, rows, parts=4, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", audit string").repartition(parts)
    pieces = conversations.repair(conversations.damage(df), gone_col="gone", times_col="times", **options)
    return sorted([tuple(r) for r in conversations.report(pieces).collect()], key=str)


def made(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["A full line.", "Is it?", "Cut off", "", " \t", "Yes!", None, "No. \n", "x" * 50 + ".", "Ünï ö."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "uncle"]
    rows = []
    for conv in [*range(conversations), None]:
        turn = rng.randint(-2, 3)
        for _ in range(rng.randint(1, longest)):
            text = rng.choice(texts)
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(roles), f"{turn} {text}" if text and rng.random() < 0.7 else text))
            turn += rng.choice([1, 1, 1, 2, 0])
    return rows


def test_equals_search(spark):
    rows = made(1, 150, 12)
    assert ours(spark, rows) == brute(rows)


@pytest.mark.parametrize("options", [{"most_rows": 3, "segment_rows": 2}, {"most_bytes": 40, "segment_bytes": 30},
                                     {"most_rows": 0, "segment_rows": 1}])
def test_segments_equal_search(spark, options):
    rows = made(2, 40, 14)
    assert ours(spark, rows, **options) == brute(rows)


def test_one_conversation_is_most_of_the_table(spark):
    rows = made(3, 15, 5) + [(77, t, r, x) for _, t, r, x in made(4, 0, 1)] + [
        (77, t, random.Random(t).choice(["user", "assistant", "system"]), random.Random(t + 1).choice(["ok.", f"Line {t}.", f"cut {t}"]))
        for t in range(300)]
    assert ours(spark, rows, parts=8, most_rows=16, segment_rows=5, fan_in=4) == brute(rows)  # a tree of several levels


def test_copies_of_one_row_and_very_long_texts(spark):
    rows = [(1, 5, "user", "Same.")] * 200 + [(1, 6, "assistant", "y" * 300_000 + "."), (2, None, None, None)]
    assert ours(spark, rows, most_rows=50, segment_rows=16) == brute(rows)


def test_empty_table(spark):
    assert ours(spark, []) == []


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    assert ours(spark, [(9, turn, "user", "Hi.")]) == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_real_messages_follow_the_pattern(spark):
    df = spark.createDataFrame(made(5, 60, 9), SCHEMA)
    for piece in conversations.repair(df).where("whole").collect():
        assert RULE.fullmatch("".join(m.role[0] for m in piece.messages))

"""Conversation structure repair: the cheapest edits that make the roles read ``(s?(ua)+)?``.

Every row is kept (0), re-roled to user or assistant (1) or deleted (2, the
only way for blank rows and repeats); an empty row of either role may be
inserted anywhere (5); a truncated row that stays costs 5 more.  The role
pattern is an automaton of four states: start, after the system row, after a
user row, after an assistant row.  Of all cheapest edit lists the one whose
initials (D, I, K, R) are ASCII-least is taken.

The list is found by Hirschberg's divide and conquer.  A forward vector holds
the cheapest cost of reaching each state from a known one, a backward vector
the cheapest cost from each state to a known one; they meet in the middle of
the rows, the cheapest crossing is taken and both halves are solved alike, in
linear space.  Where crossings cost the same, the one whose left half has the
least initials wins: the forward vector also ranks its four states by them.
(Two edit lists that handle the same rows and end with a row are never prefixes
of each other, so ranks are decided within the left half.)

On the cluster the rows are dealt by a range of (conversation, turn), so every
partition is a run of whole conversations but for its first and last one.
Inner conversations are solved where they are.  Those at an edge, and those
over ``most_rows`` or ``most_bytes``, are cut into segments of bounded size.
A segment is summed up by its 4 x 4 costs and ranks; these are composed in a
tree of bounded fan-in, the crossings are chosen from the root down, and every
segment is then solved by itself.  No task holds a whole long conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm.common import materialise

WHITE = " \t\n\x0b\x0c\r"
INF = 1 << 40

#: Kind of a row: 3 * role class (s, u, a, other) + 0 sound, 1 truncated; DELETE: blank or repeated; GONE: no row at all.
DELETE, GONE = 12, 13
_CLASS = {"s": 0, "u": 3, "a": 6}
_INSERTED = (2, 2, 3, 2)  # the state after an insertion
_KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by role class: the state after keeping the row
#: Cost and edits that end a conversation in each state.
END = (0, 10, 5, 0)
END_EDITS = ("", "II", "I", "")


def _moves(kind: int) -> list[list[tuple[int, int, str]]]:
    """By state before a row: (state after it, cost, edits), the best for each state after it."""
    out = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}

        def offer(after: int, cost: int, edits: str):
            best[after] = min(best.get(after, (INF, "")), (cost, edits))

        if kind == GONE:
            offer(state, 0, "")
        else:
            at, paid, inserted = state, 0, ""
            for _ in range(3):
                offer(at, paid + 2, inserted + "D")
                if kind != DELETE:
                    stays = paid + 5 * (kind % 3)
                    offer(_INSERTED[at], stays + 1, inserted + "R")
                    if at in _KEPT[kind // 3]:
                        offer(_KEPT[kind // 3][at], stays, inserted + "K")
                at, paid, inserted = _INSERTED[at], paid + 5, inserted + "I"
        out.append([(after, cost, edits) for after, (cost, edits) in sorted(best.items())])
    return out


_MOVES = [_moves(kind) for kind in range(14)]
_EDITS = [[{after: edits for after, _, edits in moves} for moves in by_state] for by_state in _MOVES]


class _Steps:
    """Steps of forward and backward vectors over one row, remembered by the vector relative to its least cost."""

    def __init__(self, most: int = 200_000):
        self.most, self.forward_of, self.backward_of = most, {}, {}

    def forward(self, costs: tuple, ranks: tuple, kind: int) -> tuple[tuple, tuple, int]:
        key = (costs, ranks, kind)
        found = self.forward_of.get(key)
        if found is None:
            best: list = [None] * 4
            for state in range(4):
                if costs[state] < INF:
                    for after, cost, edits in _MOVES[kind][state]:
                        offer = (costs[state] + cost, ranks[state], edits)
                        if best[after] is None or offer < best[after]:
                            best[after] = offer
            order = sorted((b[1:], j) for j, b in enumerate(best) if b)
            new_ranks = [0] * 4
            for r, (_, j) in enumerate(order):
                new_ranks[j] = r
            least = min(b[0] for b in best if b)
            if len(self.forward_of) > self.most:
                self.forward_of.clear()
            found = self.forward_of[key] = (tuple(b[0] - least if b else INF for b in best), tuple(new_ranks), least)
        return found

    def backward(self, costs: tuple, kind: int) -> tuple[tuple, int]:
        key = (costs, kind)
        found = self.backward_of.get(key)
        if found is None:
            new = [min((cost + costs[after] for after, cost, _ in moves), default=INF) for moves in _MOVES[kind]]
            least = min(new)
            if len(self.backward_of) > self.most:
                self.backward_of.clear()
            found = self.backward_of[key] = (tuple(c - least if c < INF else INF for c in new), least)
        return found


_steps = _Steps()


def _single(state: int) -> tuple:
    return tuple(0 if i == state else INF for i in range(4))


def summary(kinds: bytes) -> tuple[list[int], list[int]]:
    """Costs and ranks of all (state before, state after), row by row: 16 each."""
    costs, ranks = [], []
    for state in range(4):
        vector, order, paid = _single(state), (0, 0, 0, 0), 0
        for kind in kinds:
            vector, order, more = _steps.forward(vector, order, kind)
            paid += more
        costs += [c + paid if c < INF else INF for c in vector]
        ranks += order
    return costs, ranks


def crossing(left: list[int], ranks: list[int], right) -> int:
    """The state between two halves: the cheapest, of equal ones that with the least edits on the left."""
    return min((left[j] + right[j], ranks[j], j) for j in range(4))[2]


def edits_between(kinds: bytes, entry: int, leave: int) -> str:
    """Hirschberg: the least edits over all rows from state ``entry`` to state ``leave``."""
    out = [""] * len(kinds)
    stack = [(0, len(kinds), entry, leave)]
    while stack:
        low, high, a, b = stack.pop()
        if high - low == 1:
            out[low] = _EDITS[kinds[low]][a][b]
        elif high > low:
            middle = (low + high) // 2
            vector, order = _single(a), (0, 0, 0, 0)
            for kind in kinds[low:middle]:
                vector, order, _ = _steps.forward(vector, order, kind)
            back = _single(b)
            for kind in reversed(kinds[middle:high]):
                back, _ = _steps.backward(back, kind)
            state = crossing(vector, order, back)
            stack += [(low, middle, a, state), (middle, high, state, b)]
    return "".join(out)


def cheapest(kinds: bytes) -> str:
    """The least edits of a whole conversation."""
    vector, order = _single(0), (0, 0, 0, 0)
    for kind in kinds:
        vector, order, _ = _steps.forward(vector, order, kind)
    leave = crossing(vector, order, END)
    return edits_between(kinds, 0, leave) + END_EDITS[leave]


def cost_of(edits: str, kinds: bytes) -> int:
    """What the edits cost."""
    paid, rows = 0, (k for k in kinds if k != GONE)
    for edit in edits:
        kind = DELETE if edit == "I" else next(rows)
        paid += {"K": 0, "R": 1, "D": 2, "I": 5}[edit] + (5 * (kind % 3) if edit in "KR" else 0)
    return paid


def repaired(edits: str, state: int, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The (role, text) rows that the edits make of ``rows``, which do not hold those that are gone."""
    out, following = [], iter(rows)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(following)
        if edit == "D":
            continue
        if edit in "IR":
            state = _INSERTED[state]
            role = "assistant" if state == 3 else "user"
        else:
            state = _KEPT[_CLASS.get(role[:1], 9) // 3][state]
        out.append((role, text))
    return out


def row_kind(role: str, text: str, repeat: bool) -> tuple[int, int]:
    """(kind, fault) of a row; faults: 0 none, 1 blank, 2 duplicate, 3 truncated."""
    bare = text.strip(WHITE)
    if not bare or repeat:
        return DELETE, 2 if bare else 1
    truncated = bare[-1] not in ".!?"
    return _CLASS.get(role[:1], 9) + truncated, 3 * truncated


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(errors="surrogatepass"), digest_size=16).digest()


_STATS = ("blank", "duplicate", "truncated", "illegal")
_PIECE = [("conv_id", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
          ("n_turns", pa.int64()), *[(c, pa.int64()) for c in _STATS], ("first_initial", pa.string()), ("last_initial", pa.string()),
          ("cost", pa.int64()), ("audit", pa.string()), ("messages", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]
_RAW = [("part", pa.int32()), ("seg", pa.int64()), ("pos", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
        ("gone", pa.bool_()), ("plain", pa.int32()), ("blank_row", pa.bool_()), ("digest", pa.binary())]
_BOTH = pa.schema([("kind", pa.int32()), *_PIECE, *_RAW])
_PIECE_DDL = ("conv_id long, piece long, whole boolean, first_turn long, last_turn long, n_turns long, blank long, duplicate long, "
              "truncated long, illegal long, first_initial string, last_initial string, cost long, audit string, "
              "messages array<struct<role: string, text: string>>")
_BOTH_DDL = ("kind int, " + _PIECE_DDL + ", part int, seg long, pos int, turn long, role string, text string, gone boolean, "
             "plain int, blank_row boolean, digest binary")


def _piece(conv_id, number: int, whole: bool, turns: list, faults: list[int], roles: list[str], kinds: bytes, edits: str,
           messages: list[tuple[str, str]]) -> tuple:
    known = [t for t in turns if t is not None]
    return (conv_id, number, whole, min(known, default=None), max(known, default=None), len(set(known)),
            faults.count(1), faults.count(2), faults.count(3), _illegal([r[:1] for r in roles]),
            roles[0][:1] if roles else None, roles[-1][:1] if roles else None, cost_of(edits, kinds), edits,
            [{"role": r, "text": t} for r, t in messages])


def _solve_inner(most_rows: int, most_bytes: int, segment_rows: int, segment_bytes: int):
    """Rows sorted by conversation: pieces of the conversations that lie inside the partition, rows of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        weight = 0
        held: list[tuple] = []  # rows (turn, role, text, gone) of the conversation at hand, until it is known to be long
        held_bytes = 0
        current, started, first, passed_on = None, False, True, False
        seg, seg_count, seg_weight = 0, 0, 0

        def raw(conv_id, rows: list[tuple]) -> Iterator[tuple]:
            nonlocal seg, seg_count, seg_weight
            for turn, role, text, gone in rows:
                size = len(text or "")
                if seg_count and (seg_count >= segment_rows or seg_weight + size > segment_bytes):
                    seg, seg_count, seg_weight = seg + 1, 0, 0
                kind, fault = (GONE, 0) if gone else row_kind(role, text, False)
                yield (1, conv_id, *[None] * (len(_PIECE) - 1), part, seg, seg_count, turn, role, text, gone, kind, fault == 1,
                       None if gone else _digest(role, text))
                seg_count, seg_weight = seg_count + 1, seg_weight + size

        def close(edge: bool) -> None:
            nonlocal held, held_bytes, seg, seg_count, seg_weight, weight, passed_on
            if edge or passed_on:
                out.extend(raw(current, held))
                seg, seg_count, seg_weight = seg + 1, 0, 0
            else:
                rows = [r for r in held if not r[3]]
                seen, kinds, faults = set(), [], []
                for _, role, text, _ in rows:
                    kind, fault = row_kind(role, text, (role, text) in seen)
                    seen.add((role, text))
                    kinds.append(kind)
                    faults.append(fault)
                edits = cheapest(bytes(kinds))
                pairs = [(r[1], r[2]) for r in rows]
                out.append((0, *_piece(current, 0, True, [r[0] for r in rows], faults, [r[1] for r in rows], bytes(kinds), edits,
                                       repaired(edits, 0, pairs)), *[None] * len(_RAW)))
            weight += held_bytes + 200
            held, held_bytes, passed_on = [], 0, False

        def flush() -> pa.RecordBatch:
            nonlocal weight
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _BOTH.types)], schema=_BOTH)
            out.clear()
            weight = 0
            return batch

        for batch in batches:
            for conv_id, turn, role, text, gone, times in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if not started or conv_id != current:
                    if started:
                        close(first)
                        first = False
                    current, started = conv_id, True
                held.extend([(turn, role, text, gone)] * times)
                held_bytes += times * (len(text or "") + 16)
                if len(held) > most_rows or held_bytes > most_bytes:
                    passed_on = True
                    out.extend(raw(current, held))
                    weight += held_bytes
                    held, held_bytes = [], 0
                if weight > 1 << 21:
                    yield flush()
        if started:
            close(True)
        if out:
            yield flush()

    return run


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, part, seg, kinds) to (key, part, seg, costs, ranks)."""
    for batch in batches:
        found = [summary(bytes(k)) for k in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([c for c, _ in found], pa.list_(pa.int64())),
                                          pa.array([r for _, r in found], pa.list_(pa.int64()))],
                                         names=["key", "part", "seg", "costs", "ranks"])


def compose(a: tuple[list[int], list[int]], b: tuple[list[int], list[int]]) -> tuple[list[int], list[int]]:
    """The summary of two runs of rows, one after the other."""
    costs, ranks = [], []
    for i in range(4):
        best = [min((min(a[0][4 * i + k] + b[0][4 * k + j], INF), a[1][4 * i + k], b[1][4 * k + j]) for k in range(4)) for j in range(4)]
        costs += [x[0] for x in best]
        order = sorted(range(4), key=lambda j: best[j][1:] if best[j][0] < INF else (9, 9))
        ranks += [order.index(j) for j in range(4)]
    return costs, ranks


def _compose_group(rows: pd.DataFrame, fan_in: int) -> pd.DataFrame:
    rows = rows.sort_values("idx")
    total = None
    for costs, ranks in zip(rows["costs"], rows["ranks"]):
        own = (list(costs), list(ranks))
        total = own if total is None else compose(total, own)
    return pd.DataFrame({"key": [rows["key"].iloc[0]], "idx": [int(rows["idx"].iloc[0]) // fan_in], "costs": [total[0]], "ranks": [total[1]]})


def _choose(rows: pd.DataFrame) -> pd.DataFrame:
    """The states before and after each of a parent's children, whose own states are known: left to right, least edits first."""
    rows = rows.sort_values("idx")
    costs, ranks = [list(c) for c in rows["costs"]], [list(r) for r in rows["ranks"]]
    back = [list(_single(int(rows["leave"].iloc[0])))]
    for c in reversed(costs[1:]):
        back.append([min(min(c[4 * i + j] + back[-1][j] for j in range(4)), INF) for i in range(4)])
    back.reverse()
    state, entry, leave = int(rows["entry"].iloc[0]), [], []
    for c, r, b in zip(costs, ranks, back):
        entry.append(state)
        state = crossing(c[4 * state:4 * state + 4], r[4 * state:4 * state + 4], b)
        leave.append(state)
    return pd.DataFrame({"key": rows["key"], "idx": rows["idx"], "entry": entry, "leave": leave})


def _segment_states(segments: DataFrame, fan_in: int) -> DataFrame:
    """(key, idx, entry, leave) of all segments (key, idx, costs, ranks): a tree of bounded fan-in, up and down again."""
    summed = "key string, idx long, costs array<long>, ranks array<long>"
    levels = [segments]
    while (levels[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        up = levels[-1].withColumn("parent", F.floor(F.col("idx") / fan_in)).groupBy("key", "parent")
        levels.append(materialise(up.applyInPandas(lambda rows: _compose_group(rows, fan_in), summed), "summaries"))

    def root(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"key": f["key"], "idx": f["idx"], "entry": 0,
                                "leave": [crossing(list(c[:4]), list(r[:4]), END) for c, r in zip(f["costs"], f["ranks"])]})

    states = levels[-1].mapInPandas(root, "key string, idx long, entry int, leave int")
    for level in reversed(levels[:-1]):
        above = states.select("key", F.col("idx").alias("parent"), "entry", "leave")
        joined = level.withColumn("parent", F.floor(F.col("idx") / fan_in)).join(above, ["key", "parent"])
        states = materialise(joined.groupBy("key", "parent").applyInPandas(
            lambda rows: _choose(rows), "key string, idx long, entry int, leave int"), "states")
    return states


def _solve_segment(rows: pa.Table, states: pa.Table) -> pa.Table:
    """The piece of one segment: at most segment_rows rows, with the states around it."""
    rows = rows.sort_by("pos")
    state = states.to_pylist()[0]
    kept = rows.filter(pc.invert(rows["gone"]))
    kinds, repeat, blank = (kept[c].to_pylist() for c in ("plain", "repeat", "blank_row"))
    kinds = bytes(DELETE if r or b else k for k, r, b in zip(kinds, repeat, blank))
    faults = [1 if b else 2 if r else 3 * (k % 3 == 1) for k, r, b in zip(kinds, repeat, blank)]
    edits = edits_between(kinds, state["entry"], state["leave"])
    roles = kept["role"].to_pylist()
    messages = repaired(edits, state["entry"], list(zip(roles, kept["text"].to_pylist())))
    if state["last"]:
        edits += END_EDITS[state["leave"]]
        role = {0: [], 1: ["user", "assistant"], 2: ["assistant"], 3: []}[state["leave"]]
        messages += [(r, "") for r in role]
    piece = _piece(state["conv_id"], state["idx"], False, kept["turn"].to_pylist(), faults, roles, kinds, edits, messages)
    return pa.Table.from_arrays([pa.array([v], t) for v, (_, t) in zip(piece, _PIECE)], schema=pa.schema(_PIECE))


def repair(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           gone_col: str | None = None, times_col: str | None = None, most_rows: int = 4096, most_bytes: int = 1 << 22,
           segment_rows: int = 1024, segment_bytes: int = 1 << 17,
           fan_in: int = 1024) -> DataFrame:
    """Repaired conversations in pieces: (conv_id, piece, whole, statistics of its rows, cost, audit, messages).

    A conversation is one piece that is ``whole``, or pieces numbered from 0
    whose audits and messages follow each other.  ``gone_col`` marks rows that
    only say that the conversation exists, ``times_col`` how often a row
    stands there.

    Rows are taken by turn (NULL first); rows of equal turn by role, the
    text's first 64 characters, then its hash.  A NULL role or text is one
    space, a NULL conversation is one of its own.  A role whose first
    character is not s, u or a (also an empty one) cannot be kept.  An empty
    table gives no rows; further columns are not read.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.coalesce(F.col(gone_col), F.lit(False)) if gone_col else F.lit(False)).alias("gone"),
        (F.col(times_col).cast("int") if times_col else F.lit(1)).alias("times"))
    plain = plain.withColumns({"role": F.expr("if(gone, null, role)"), "text": F.expr("if(gone, null, text)")})
    # copies of one row are dealt apart by the row number, so that no key is one partition's
    keys = ["conv_id", "turn", "_role", "_head", "_hash", "_row"]
    sorted_rows = (plain.withColumns({"_role": F.substring("role", 1, 32), "_head": F.substring("text", 1, 64),
                                      "_hash": F.xxhash64("role", "text"), "_row": F.monotonically_increasing_id()})
                   .repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                   .select("conv_id", "turn", "role", "text", "gone", "times"))
    both = materialise(sorted_rows.mapInArrow(_solve_inner(most_rows, most_bytes, segment_rows, segment_bytes), _BOTH_DDL), "conversations")
    piece_columns = [c for c, _ in _PIECE]
    inner = both.where("kind = 0").select(*piece_columns)

    raw = both.where("kind = 1").select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "conv_id", *[c for c, _ in _RAW])
    place = ["part", "seg", "pos"]
    first = (raw.where("not gone").groupBy("key", "digest").agg(F.min(F.struct(*place)).alias("_at"))
             .select(*[F.col(f"_at.{c}").alias(c) for c in place], F.lit(False).alias("repeat")))
    marked = raw.join(first, place, "left").withColumn("repeat", F.coalesce("repeat", ~F.col("gone")))
    kind = F.when(F.col("repeat") | F.col("blank_row"), F.lit(DELETE)).otherwise(F.col("plain"))
    order = F.array_sort(F.collect_list(F.struct("pos", kind.alias("k"))))  # a segment's rows: segment_rows at most
    kinds = marked.groupBy("key", "conv_id", "part", "seg").agg(order.alias("_k")).select(
        "key", "conv_id", "part", "seg", F.unhex(F.array_join(F.transform("_k", lambda x: F.lpad(F.hex(x["k"]), 2, "0")), "")).alias("kinds"))
    kinds = materialise(kinds, "segments")
    in_conversation = Window.partitionBy("key").orderBy("part", "seg")
    # one narrow row a segment
    numbered = kinds.select("key", "conv_id", "part", "seg").withColumns({
        "idx": (F.row_number().over(in_conversation) - 1).cast("long"),
        "last": F.lead("seg").over(in_conversation).isNull()})
    numbered = materialise(numbered, "numbered")
    sums = kinds.select("key", "part", "seg", "kinds").mapInArrow(
        _summaries, "key string, part int, seg long, costs array<long>, ranks array<long>")
    sums = materialise(sums.join(numbered.drop("key"), ["part", "seg"]).select("key", "idx", "costs", "ranks"), "segment-sums")
    states = _segment_states(sums, fan_in)
    placed = numbered.join(states, ["key", "idx"]).select("part", "seg", "conv_id", "idx", "entry", "leave", "last")
    solved = (marked.select(*place, "turn", "role", "text", "gone", "plain", "blank_row", "repeat").groupBy("part", "seg")
              .cogroup(placed.groupBy("part", "seg")).applyInArrow(lambda a, b: _solve_segment(a, b), _PIECE_DDL))
    return inner.unionByName(solved)


_REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and number: one report a conversation, its messages hashed as they pass."""
    schema = pa.schema([(c, pa.string() if t == "string" else pa.int64()) for c, t in (x.split() for x in _REPORT.split(", "))])
    report, initial, turn, audit, sha, any_text = None, None, None, [], None, False

    def finish() -> pa.RecordBatch:
        low, high, n = report.pop("low"), report.pop("high"), report.pop("n")
        report.update(gaps=0 if low is None else high - low + 1 - n, audit="".join(audit), repaired_sha256=sha.hexdigest())
        return pa.RecordBatch.from_pylist([report], schema=schema)

    for batch in batches:
        for p in batch.to_pylist():
            if report is None or report["conv_id"] != p["conv_id"]:
                if report is not None:
                    yield finish()
                report = {"conv_id": p["conv_id"], "cost": 0, "low": None, "high": None, "n": 0, **dict.fromkeys(_STATS, 0)}
                initial, turn, audit, sha, any_text = None, None, [], hashlib.sha256(), False
            for c in (*_STATS, "cost"):
                report[c] += p[c]
            if p["first_initial"] is not None:
                if initial is not None:
                    report["illegal"] += _illegal([initial, p["first_initial"]])
                initial = p["last_initial"]
            if p["n_turns"]:
                report["n"] += p["n_turns"] - (turn == p["first_turn"])
                report["low"] = p["first_turn"] if report["low"] is None else report["low"]
                report["high"] = turn = p["last_turn"]
            audit.append(p["audit"])
            for m in p["messages"]:
                sha.update((("\n" if any_text else "") + m["role"] + ":" + m["text"]).encode())
                any_text = True
    if report is not None:
        yield finish()


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation from its pieces: faults, cost, audit and the SHA-256 of its repaired ``role:text`` lines.

    A conversation in several pieces is read by one task, piece by piece in
    bounded memory: a SHA-256 is a chain over the whole text.
    """
    names = _REPORT.replace(" long", "").replace(" string", "").split(", ")
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    whole = pieces.where("whole").select(
        "conv_id", F.expr("if(n_turns = 0, 0, last_turn - first_turn + 1 - n_turns)").cast("long").alias("gaps"),
        *_STATS, "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256")).select(*names)
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = (pieces.where("not whole").repartition(n, "conv_id").sortWithinPartitions("conv_id", "piece")
           .mapInArrow(_join_pieces, _REPORT))
    return whole.unionByName(cut)


def damage(conversations: DataFrame) -> DataFrame:
    """The stated damage: by crc32 of ``conv_id:turn`` modulo 20, rows go, lose text or end marks, repeat or change role."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    code = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    text = F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(filled["text"], "[.!?]", "")).otherwise(filled["text"])
    return conversations.select(
        "conv_id", "turn", F.when(code == 4, F.lit("user")).otherwise(filled["role"]).alias("role"), text.alias("text"),
        (code == 0).alias("gone"), F.when(code == 3, 2).otherwise(1).alias("times"))

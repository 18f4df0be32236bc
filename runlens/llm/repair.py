"""Repair of the turn structure of conversations at least cost, decided once per shared suffix.

Every row of a conversation becomes one letter: what its role begins with and its first fault. Equal signatures are one
word, and words that end alike share that end: the signatures form an automaton whose nodes are their different suffixes.
Sorted by their reversed letters, the next word keeps the nodes of the suffix it shares with the word before and adds the others, so
a task holds one path of the automaton and works on each node once. A node knows, for every state of the grammar, the
cheapest cost from there to the end and the first letter of the edits that reach it (with the node and state that follow).

Edits: Keep 0, Rerole to user or assistant 2, Delete 3, Insert an empty user or assistant turn 2; a truncated row that is not
deleted costs 1 more; blank and duplicate rows must be deleted. The roles that stay must read `(s?(ua)+)?`. In a state
of that grammar only one of user and assistant can come next, so an audit (initials of the edits in order) says everything, and
since each initial is one way to go on, the least audit among the cheapest is found by its first letter alone.

Memory: a conversation is one row; a task of the automaton holds the longest signature. Frequent signatures are answered by a broadcast of
at most `HOT_SHARE` rows of bounded length, the others by a join on their digest.

Nulls and ties: a null role or text counts as one space, a null turn sorts first and counts in no gap; rows of equal turn are ordered by role, then text;
repeated rows are duplicates; an empty table gives an empty result, a conversation without rows zeros, an empty audit and no turns.
Other columns are never read; rows with a null conversation id form one conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import small_batches
from runlens.operators.skew import lookup_join
from runlens.session import written

BLANKS = " \t\n\v\f\r"
LAWFUL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
# states of the grammar (s?(ua)+)?: nothing yet, after the system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
# in every state: the role that may be written there, and the state after it
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
ENDS = (START, ASSISTANT)
FAR = 1 << 60
# signatures with more than this share of all conversations, and no longer than this, are broadcast
HOT_SHARE, HOT_LENGTH = 256, 1 << 16

# letters of a signature: a row that must go; roles by initial, in capitals if the text is truncated; `o` is any other role
GONE = "x"
Node = list[tuple[int, str]]  # per state: cost to the end, and the edit that comes next


def faults(turns: list[dict]) -> tuple[str, dict[str, int]]:
    """The signature of a conversation, and how many rows have each fault."""
    seen: set[tuple[str, str]] = set()
    found = {"blank": 0, "duplicate": 0, "truncated": 0}
    letters = []
    for turn in turns:
        role, text = turn["role"], turn["text"]
        shown = text.rstrip(BLANKS)
        fault = ("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            found[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        letters.append(GONE if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
    return "".join(letters), found


def structure(turns: list[dict]) -> tuple[int, int]:
    """(gaps, illegal): turn numbers missing between the first and the last, and neighbours whose roles may not follow each other."""
    numbers = {t["turn"] for t in turns if t["turn"] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    initials = [t["role"][:1] for t in turns]
    return gaps, sum(a + b not in LAWFUL for a, b in zip(initials, initials[1:], strict=False))


def _with_inserts(direct: Node) -> Node:
    """An insert leads to the state after it; after two of them the states repeat, so one round over the lawful pairs is all."""
    best = list(direct)
    for state in (USER, ASSISTANT):
        best[state] = min(best[state], (direct[NEXT[state][1]][0] + COST[INSERT], INSERT))
    for state in (START, SYSTEM):
        best[state] = min(best[state], (best[USER][0] + COST[INSERT], INSERT))
    return best


LAST: Node = _with_inserts([(0 if state in ENDS else FAR, "") for state in range(4)])


def kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row of that initial, if the grammar allows it."""
    if initial == "s":
        return SYSTEM if state == START else None
    role, after = NEXT[state]
    return after if role[0] == initial else None


def node(letter: str, then: Node) -> Node:
    """The node of a suffix from its first letter and the node of the rest."""
    more = TRUNCATED if letter.isupper() else 0
    direct: Node = []
    for state in range(4):
        ways = [(then[state][0] + COST[DELETE], DELETE)]
        if letter != GONE:
            after = kept_state(state, letter.lower())
            if after is not None:
                ways.append((then[after][0] + COST[KEEP] + more, KEEP))
            ways.append((then[NEXT[state][1]][0] + COST[REROLE] + more, REROLE))
        direct.append(min(ways))
    return _with_inserts(direct)


def audit(path: list[Node], signature: str) -> str:
    """The edits from the first row on; `path[k]` is the node of the last k letters."""
    state, left, edits = START, len(signature), []
    while edit := path[left][state][1]:
        edits.append(edit)
        if edit == KEEP:
            state = kept_state(state, signature[-left].lower())
        elif edit != DELETE:
            state = NEXT[state][1]
        left -= edit != INSERT
    return "".join(edits)


def apply_edits(turns: list[dict], edits: str) -> list[dict]:
    """The turns that an audit leaves, with their roles."""
    rows, state, out = iter(turns), START, []
    for edit in edits:
        row = {"text": ""} if edit == INSERT else next(rows)
        if edit == KEEP:
            state = kept_state(state, row["role"][:1])
            out.append({"role": row["role"], "text": row["text"]})
        elif edit != DELETE:
            role, state = NEXT[state]
            out.append({"role": role, "text": row["text"]})
    return out


def conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                  copies: Column | None = None) -> DataFrame:
    """`_conv` and its `_turns` in order. `copies` says how often a row occurs; 0 leaves it out, but not its conversation."""
    one = F.struct(F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
                   F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"))
    some = F.array_repeat(one, F.lit(1) if copies is None else copies)
    return rows.select(F.col(f"`{conv_col}`").alias("_conv"), some.alias("_some")).groupBy("_conv").agg(
        F.sort_array(F.flatten(F.collect_list("_some"))).alias("_turns"))


def signed(chats: DataFrame) -> DataFrame:
    """Add `_signature`, its digest and the counts of faults to conversations."""
    small_batches(chats.sparkSession)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            signatures, counts = [], []
            for turns in batch.column(1).to_pylist():
                signature, found = faults(turns)
                gaps, illegal = structure(turns)
                signatures.append(signature)
                counts.append({"gaps": gaps, "illegal": illegal, **found})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(signatures, pa.string()), *(pa.array([c[n] for c in counts], pa.int64()) for n in names)],
                names=["_conv", "_turns", "_signature", *names])

    kinds = dict(chats.dtypes)
    out = chats.select("_conv", "_turns").mapInArrow(
        batches, f"_conv {kinds['_conv']}, _turns {kinds['_turns']}, _signature string, " + ", ".join(f"{n} long" for n in names))
    return out.withColumn("_digest", F.sha2("_signature", 256))


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of different signatures, one path of the automaton at a time."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, before = [LAST], ""
        for batch in source:
            costs, edits, words = [], [], batch.column(0).to_pylist()
            for word in words:
                backward = word[::-1]
                shared = 0
                while shared < min(len(before), len(backward)) and before[shared] == backward[shared]:
                    shared += 1
                del path[shared + 1:]
                for letter in backward[shared:]:
                    path.append(node(letter, path[-1]))
                before = backward
                costs.append(path[-1][START][0])
                edits.append(audit(path, word))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(costs, pa.int64()), pa.array(edits, pa.string())],
                                             names=["signature", "cost", "audit"])

    kept = signatures.select("signature", F.reverse("signature").alias("_back"))
    ordered = kept.repartitionByRange("_back").sortWithinPartitions("_back").select("signature")
    return ordered.mapInArrow(batches, "signature string, cost long, audit string")


def decided(chats: DataFrame) -> DataFrame:
    """Add `cost` and `audit` to conversations. `chats` must be a written table of `signed`."""
    different = written(chats.groupBy("_digest").agg(F.first("_signature").alias("signature"), F.count("*").alias("n")), "signatures")
    decisions = different.join(audits(different), "signature")
    share = max(chats.count() // HOT_SHARE, 1)
    hot = F.when(F.length("signature") <= HOT_LENGTH, F.col("n")).otherwise(F.lit(0))
    return lookup_join(chats, decisions.select("_digest", "cost", "audit", hot.alias("n")), "_digest", ["cost", "audit"], "n", hot_rows=share)


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             copies: Column | None = None) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit, `repaired` (role, text)."""
    chats = written(signed(conversations(rows, conv_col, turn_col, role_col, text_col, copies)), "signed-conversations")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    found = decided(chats).select("_conv", "_turns", *names)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in source:
            turns = [apply_edits(t, a) for t, a in zip(batch.column(1).to_pylist(), batch.column(8).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(turns, kind)], names=["_conv", *names, "repaired"])

    counts = ", ".join(f"{n} long" for n in names[:-1])
    out = found.mapInArrow(batches, f"_conv {dict(chats.dtypes)['_conv']}, {counts}, audit string, repaired array<struct<role:string,text:string>>")
    return out.withColumnRenamed("_conv", conv_col)


def digests(chats: DataFrame) -> DataFrame:
    """`repaired` as the SHA-256 of its lines `role:text`."""
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return chats.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).drop("repaired")


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations as a careless export leaves them, by the checksum of conversation and turn; rows, and how often each occurs."""
    filled = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                         (F.crc32(F.concat(*[p for c in ("conv_id", "turn") for p in (F.coalesce(F.col(c).cast("string"), F.lit(" ")), F.lit(":"))][:-1])
                                  .cast("binary")) % 20).alias("_h"))
    h = F.col("_h")
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    changed = filled.select("conv_id", "turn", F.when(h == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "_h")
    return changed, F.when(h == 0, 0).when(h == 3, 2).otherwise(1)

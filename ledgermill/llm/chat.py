"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system message, then user and assistant
messages in turns, the assistant last. A dynamic programme over the automaton of
the last message's role chooses for every turn whether it is kept, merged into the
message before it, given another role, and how many empty messages are inserted
before it, at the lowest total cost. The repaired turns are then rendered.

Turns are sorted by conversation and place with a range partitioning, so a
conversation of any length is dealt over several partitions and read in blocks of
bounded length. A block's effect on the cost is a small matrix (entry state by
exit state) and blocks combine by (min, +) products. Conversations inside one block
are repaired at once; for the others the chain of block matrices fixes the states
at the block borders, and every block is then repaired on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import stored, with_row_id

BLOCK_TURNS = 2048

# Costs of a repair; keeping a turn as it is costs nothing.
MERGE, RELABEL, INSERT = 1, 2, 3

# Roles, and other names they are known by.
ROLES = ("system", "user", "assistant")
ALIASES = {
    "human": "user",
    "prompter": "user",
    "gpt": "assistant",
    "bot": "assistant",
    "model": "assistant",
}
JOINER = "\n\n"

# States are the role of the last message; START is before the first.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FAR = 10**15

# A choice: cost, inserted states, state after it, whether it is merged, whether relabelled.
Choice = tuple[int, tuple[int, ...], int, bool, bool]


def normal_role(role: str | None) -> str:
    """The role in lower case, aliases resolved; anything else is '' and must be relabelled."""
    name = role.strip().lower() if isinstance(role, str) else ""
    name = ALIASES.get(name, name)
    return name if name in ROLES else ""


def _insertions(state: int) -> list[tuple[int, tuple[int, ...]]]:
    """States reachable by up to two empty messages, with the messages inserted."""
    out: list[tuple[int, tuple[int, ...]]] = [(state, ())]
    for first in _NEXT[state]:
        if first == SYSTEM:
            continue
        out.append((first, (first,)))
        out += [(second, (first, second)) for second in _NEXT[first]]
    return out


def _choices(state: int, role: str) -> list[Choice]:
    """All ways to take a turn of ``role`` in ``state``, cheapest first, in a fixed order."""
    own = ROLES.index(role) + 1 if role else 0
    found = []
    for between, inserted in _insertions(state):
        for target in (SYSTEM, USER, ASSISTANT):
            cost = INSERT * len(inserted) + (RELABEL if target != own else 0)
            if target in _NEXT[between]:
                found.append((cost, inserted, target, False, target != own))
            # A merge goes into a message of the text's own, not into an inserted one.
            if target == between and not inserted and state != START:
                found.append((cost + MERGE, inserted, target, True, target != own))
    return sorted(found, key=lambda c: (c[0], c[3], c[4], c[1], c[2]))


CHOICES = {(s, r): _choices(s, r) for s in range(4) for r in ("", *ROLES)}
MATRICES = {
    r: np.array(
        [
            [min((c[0] for c in CHOICES[s, r] if c[2] == t), default=FAR) for t in range(4)]
            for s in range(4)
        ],
        dtype=np.int64,
    )
    for r in ("", *ROLES)
}
# Empty messages that end a conversation with the assistant; none where there is no turn.
ENDINGS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
END_COST = np.array([INSERT * len(ENDINGS[s]) for s in range(4)], dtype=np.int64)


def product(roles: list[str]) -> np.ndarray:
    """Least cost of a run of turns for every entry and exit state."""
    total = np.where(np.eye(4, dtype=bool), 0, FAR)
    for role in roles:
        total = np.minimum((total[:, :, None] + MATRICES[role][None]).min(axis=1), FAR)
    return total


def repair(roles: list[str], entry: int = START, leave: int | None = None) -> list[Choice]:
    """The cheapest choice of every turn from ``entry`` to ``leave`` (None: the end)."""
    best = np.full((len(roles) + 1, 4), FAR, dtype=np.int64)
    if leave is None:
        best[-1] = END_COST
    else:
        best[-1, leave] = 0
    for i in range(len(roles) - 1, -1, -1):
        best[i] = np.minimum((MATRICES[roles[i]] + best[i + 1][None]).min(axis=1), FAR)
    out, state = [], entry
    for i, role in enumerate(roles):
        choice = min(CHOICES[state, role], key=lambda c: c[0] + best[i + 1][c[2]])
        out.append(choice)
        state = choice[2]
    return out


def opening(state: int) -> str:
    return f"<|im_start|>{ROLES[state - 1]}\n"


CLOSING = "<|im_end|>\n"

# What could be read as a marker in a text, escaped or not.
_MARKER = re.compile(r"<(\\*)\|(?=im_(?:start|end)\|>)")
_ESCAPED = re.compile(r"<\\(\\*)\|(?=im_(?:start|end)\|>)")


def escaped(text: str) -> str:
    """``text`` with a backslash more inside every marker, so that it closes and opens nothing."""
    return _MARKER.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    """The text that :func:`escaped` was given."""
    return _ESCAPED.sub(r"<\1|", text)


def empty_message(state: int) -> str:
    return opening(state) + CLOSING


def rendered(
    texts: list[str], choices: list[Choice], first: bool, last: bool
) -> list[tuple[str, str, int, int, str]]:
    """Per turn: action, role, inserted before it, cost, rendered part.

    A message is closed by the part that follows it, or by the conversation's last
    part, so that parts of a block need nothing of the next block.
    """
    out = []
    for i, (text, choice) in enumerate(zip(texts, choices, strict=True)):
        cost, inserted, state, merged, relabelled = choice
        part = "" if (first and i == 0) or merged else CLOSING
        part += "".join(empty_message(s) for s in inserted)
        part += (JOINER if merged else opening(state)) + escaped(text)
        if last and i == len(texts) - 1:
            cost += int(END_COST[state])
            part += CLOSING + "".join(empty_message(s) for s in ENDINGS[state])
        names = ["relabel"] * relabelled + ["merge"] * merged
        action = "+".join(names) or "keep"
        out.append((action, ROLES[state - 1], len(inserted), cost, part))
    return out


TURNS = "conv_id long, turn long, role string, text string, row_no long"
SORTED = (
    f"{TURNS}, block long, place long, action string, new_role string, inserted long, "
    "cost long, rendered string, matrix array<long>, size long"
)
_OUT = ["action", "new_role", "inserted", "cost", "rendered"]


def _same(a: object, b: object) -> bool:
    return (pd.isna(a) and pd.isna(b)) or (not pd.isna(a) and not pd.isna(b) and a == b)


def _blocker(block_turns: int):
    """Sorted turns to repaired turns; turns of cut conversations stay open, in blocks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId() << 33
        columns = [c.split()[0] for c in SORTED.split(", ")]
        number = 0
        held: list[tuple] = []
        cut_before = True  # the partition's first conversation may have begun before it

        def frame_of(rows: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=columns, dtype=object)
            for name in ("conv_id", "turn", "row_no", "block", "place", "inserted", "cost", "size"):
                out[name] = pd.array(out[name], dtype="Int64")
            return out

        def emit(open_block: bool) -> list[tuple]:
            nonlocal number
            roles = [normal_role(r[2]) for r in held]
            texts = [r[3] if isinstance(r[3], str) else "" for r in held]
            block = part + number
            number += 1
            if open_block:
                rows = [
                    (*r, block, i, None, None, None, None, None, None, None)
                    for i, r in enumerate(held)
                ]
                matrix = product(roles).reshape(-1).tolist()
                rows.append((held[0][0], *[None] * 4, block, *[None] * 6, matrix, len(held)))
                return rows
            made = rendered(texts, repair(roles), True, True)
            return [
                (*r, block, i, *m, None, None) for i, (r, m) in enumerate(zip(held, made, strict=True))
            ]

        for frame in frames:
            ready: list[tuple] = []
            for row in frame.itertuples(index=False, name=None):
                if held and not _same(row[0], held[-1][0]):
                    ready += emit(cut_before)
                    held, cut_before = [], False
                elif len(held) >= block_turns:
                    ready += emit(True)
                    held, cut_before = [], True
                held.append(row)
            if ready:
                yield frame_of(ready)
        if held:
            # The last conversation may go on in the next partition.
            yield frame_of(emit(True))

    return run


def _border_states(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit state of every block of one conversation, one small row per block."""
    blocks = blocks.sort_values("block", kind="stable")
    matrices = [np.array(list(m), dtype=np.int64).reshape(4, 4) for m in blocks["matrix"]]
    best = [END_COST]
    for matrix in reversed(matrices):
        best.append(np.minimum((matrix + best[-1][None]).min(axis=1), FAR))
    best.reverse()
    rows, state, before = [], START, 0
    for i, (block, size) in enumerate(zip(blocks["block"], blocks["size"], strict=True)):
        after = int(np.argmin(matrices[i][state] + best[i + 1]))
        rows.append((block, state, after, before, i == 0, i == len(matrices) - 1))
        state, before = after, before + int(size)
    return pd.DataFrame(
        rows, columns=["block_no", "entry", "leave", "before", "is_first", "is_last"]
    )


BORDERS = "block_no long, entry int, leave int, before long, is_first boolean, is_last boolean"
RESULT = (
    "conv_id long, place long, turn long, role string, new_role string, action string, "
    "inserted long, cost long, rendered string"
)


def _repair_block(key: tuple, turns: pd.DataFrame) -> pd.DataFrame:
    turns = turns.sort_values("place", kind="stable").reset_index(drop=True)
    known = turns.iloc[0]
    roles = [normal_role(r) for r in turns["role"]]
    texts = [t if isinstance(t, str) else "" for t in turns["text"]]
    last = bool(known["is_last"])
    choices = repair(roles, int(known["entry"]), None if last else int(known["leave"]))
    made = pd.DataFrame(rendered(texts, choices, bool(known["is_first"]), last), columns=_OUT)
    out = pd.concat([turns[["conv_id", "turn", "role"]], made], axis=1)
    out["place"] = turns["place"].astype("int64") + int(known["before"])
    for name in ("conv_id", "turn"):
        out[name] = pd.array(out[name], dtype="Int64")
    return out[[c.split()[0] for c in RESULT.split(", ")]]


def formatted(
    turns: DataFrame,
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """One row per turn: conv_id, place, turn, role, new_role, action, inserted, cost, rendered.

    The rendered parts of a conversation in order of ``place`` (from 0) are its
    rendered text; the costs sum to the least cost of its repair. Turns are ordered
    by number, then role, text and row; a null number comes first. Roles are read
    without case; null and unknown roles are relabelled. Null texts are empty, empty
    texts stay messages. A marker of the rendered form inside a text is escaped
    (:func:`escaped`), so no text can forge a turn. Rows with a null conversation form one conversation.
    Repeated rows are turns of their own. An empty table gives no rows; other
    columns are ignored.
    """
    slim = with_row_id(turns, "row__no").select(
        F.col(conversation_column).cast("long").alias("conv_id"),
        F.col(turn_column).cast("long").alias("turn"),
        F.col(role_column).alias("role"),
        F.col(text_column).alias("text"),
        F.col("row__no").alias("row_no"),
    )
    # The text is compared by its digest in the deal, as range samples go to the driver.
    digest = F.sha2("text", 256)
    order = ["conv_id", "turn", "role", "text_digest", "row_no"]
    ranged = (
        slim.withColumn("text_digest", digest)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", "row_no")
    )
    blocks = stored(ranged.mapInPandas(_blocker(block_turns), SORTED), "turn-blocks")
    columns = [c.split()[0] for c in RESULT.split(", ")]
    done = blocks.where("action IS NOT NULL").select(*columns)
    borders = stored(
        blocks.where("matrix IS NOT NULL")
        .groupBy("conv_id")
        .applyInPandas(_border_states, BORDERS),
        "block-borders",
    )
    cut = blocks.where("action IS NULL AND matrix IS NULL").join(
        borders, F.col("block") == F.col("block_no")
    )
    return done.unionByName(cut.groupBy("block").applyInPandas(_repair_block, RESULT))

"""Repair of conversations whose turns are blank, repeated, cut off or out of order.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turn, or nothing at all.  Edits
are letters of an audit: Keep, Rerole (to user or assistant), Delete, Insert (an
empty user or assistant turn).  The cheapest edits are taken, and of these the
ones whose audit comes first in ASCII order.

Rows get their global place by one range sort; faults follow from neighbours in
that order and from first occurrences, both distributed.  Of each row one letter
goes on: a conversation is a string of codes, gathered in pages.  Over the nodes
(row, state of the pattern) a dynamic program finds the least cost to the end.
Arcs that lie on cheapest paths remain.  Their letters rank the nodes by audits of
one letter; pairs of ranks at a node and at the node its pointer leads to rank
them by audits of twice the length, and pointers double.  A letter and a state
determine the next state, so the least rank names one arc of a node, and the
doubled pointers from a start give its least path.

Blank: without a sign other than white space.  Duplicate: role and text were seen
before in the conversation.  Truncated: the last sign that is no white space is not
one of ``.!?``.  A row has its first fault only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitweave.operators.rows import neighbours, number_as_is
from fitweave.shared import pinned

WHITE = " \t\n\x0b\f\r"
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: Code of a row that must go; other codes are s, u, a or o (any other initial), upper case if truncated.
GONE = "x"
#: Letters by rank: the end of an audit comes before all of them.
LETTERS = "\0DIKR"
END, D, I, K, R = range(5)
#: State after a user or assistant turn from: start, system, user, assistant.
AFTER = np.array([2, 2, 3, 2])
_FAR = 1 << 29
#: Nodes that are ranked together, but for a longer single conversation.
GROUP_NODES = 1 << 21
PAGE_ROWS = 4096


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with known faults, for measuring a repair.

    The crc32 of ``conv_id:turn``, by 20: 0 drops the row, 1 empties its text, 2
    takes ``.!?`` out of it, 3 repeats the row, 4 makes its role user.  Nulls count
    as one space in that key, in roles and in texts.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    drawn = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("_kind"))
    return drawn.filter("_kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def placed(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` and ``row_no``, the row's place in the order of conversations and turns.

    A missing conv_id or turn stands first.  Rows of one turn stand by role, then
    by the first signs of the text, then by its digest, so equal rows meet.  Null
    roles and texts are one space.
    """
    space = F.lit(" ")
    known = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    # Whole texts would reach the driver in the sample of the range sort.
    keys = [F.col("conv_id"), F.col("turn"), F.col("role"), F.left("text", F.lit(32)), F.md5("text")]
    return number_as_is(known.orderBy(*[k.asc_nulls_first() for k in keys]))


def faults(numbered: DataFrame) -> DataFrame:
    """Per row: ``conv_id, row_no, blank, duplicate, truncated, illegal, new_turn, turn, code``.

    ``illegal`` marks a row whose role's initial may not follow that of the row
    above it, ``new_turn`` one whose turn differs from that.  Equal texts are told
    by their SHA-256.
    """
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    compact = numbered.select(
        "conv_id", "turn", "row_no", F.left("role", F.lit(1)).alias("initial"), (shown == "").alias("_blank"),
        (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("_open"),
    )
    above = neighbours(compact, {"_above": (F.struct("initial", "turn"), -1)}, within=["conv_id"])
    digest = F.sha2("text", 256)
    firsts = numbered.groupBy("conv_id", "role", digest.alias("_text")).agg(F.min("row_no").alias("row_no"))
    known = above.join(firsts.select("row_no", F.lit(True).alias("_first")), "row_no", "left")
    blank, seen = F.col("_blank"), F.col("_first").isNull()
    duplicate = ~blank & seen
    truncated = ~blank & ~seen & F.col("_open")
    pair = F.concat("_above.initial", "initial")
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    code = F.when(blank | duplicate, GONE).when(truncated, F.upper(letter)).otherwise(letter)
    return known.select(
        "conv_id", "row_no", "turn", blank.alias("blank"), duplicate.alias("duplicate"), truncated.alias("truncated"),
        (F.col("_above").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"),
        (F.col("turn").isNotNull() & ~(F.col("_above").isNotNull() & F.col("_above.turn").eqNullSafe(F.col("turn")))).alias("new_turn"),
        code.alias("code"),
    )


def _joined(items: Column, field: str) -> Column:
    return F.array_join(F.transform(F.sort_array(items), lambda x: x[field]), "")


def coded(found: DataFrame) -> DataFrame:
    """One row per conversation: numbers of faults, ``gaps``, ``first_no``, and the ``codes`` of its rows in order.

    Rows are gathered in pages of the global order first, so that a long
    conversation costs a byte per row where it comes together.
    """
    one = lambda name: F.sum(F.col(name).cast("long"))
    counted = ["blank", "duplicate", "truncated", "illegal", "new_turn"]
    page = F.floor(F.col("row_no") / PAGE_ROWS).cast("long").alias("page")
    pages = found.groupBy("conv_id", page).agg(
        F.min("row_no").alias("first_no"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        *[one(c).alias(c) for c in counted],
        _joined(F.collect_list(F.struct("row_no", "code")), "code").alias("codes"),
    )
    # A span beyond 64 bits has no number of gaps: null.
    gaps = F.try_subtract(F.try_add(F.try_subtract(F.max("high"), F.min("low")), F.lit(1)), F.sum("new_turn"))
    return pages.groupBy("conv_id").agg(
        F.min("first_no").alias("first_no"),
        F.when(F.max("high").isNull(), F.lit(0)).otherwise(gaps).alias("gaps"),
        *[F.sum(c).alias(c) for c in counted[:-1]],
        _joined(F.collect_list(F.struct("page", "codes")), "codes").alias("codes"),
    )


def _grid(codes: list[str]) -> np.ndarray:
    """Codes by rows left (0: none) and conversation; above its own rows a conversation has rows that go."""
    grid = np.full((max(map(len, codes)) + 1, len(codes)), ord(GONE), np.uint8)
    for c, own in enumerate(codes):
        grid[1 : len(own) + 1, c] = np.frombuffer(own.encode(), np.uint8)[::-1]
    return grid


def _costs(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Least cost to the end of each node (rows left, conversation, state), and of keeping and reroling its row.

    The third result is the state that keeping leads to.
    """
    gone = grid == ord(GONE)
    low = grid | 0x20
    open_ = (grid != low).astype(np.int32) * TRUNCATED
    target = np.select([low == ord("s"), low == ord("u"), low == ord("a")], [1, 2, 3], 0)
    fits = np.zeros((*grid.shape, 4), bool)
    fits[..., 0] = (target == 1) | (target == 2)
    fits[..., 1] = fits[..., 3] = target == 2
    fits[..., 2] = target == 3
    keep = np.where(fits & ~gone[..., None], open_[..., None], _FAR).astype(np.int32)
    rerole = np.where(gone, _FAR, open_ + REROLE).astype(np.int32)
    cost = np.empty((*grid.shape, 4), np.int32)
    each = np.arange(grid.shape[1])
    base = np.tile(np.array([0, _FAR, _FAR, 0], np.int32), (grid.shape[1], 1))
    for t in range(len(grid)):
        if t:
            past = cost[t - 1]
            kept = keep[t] + past[each, target[t]][:, None]
            base = np.minimum(np.minimum(past + DELETE, kept), rerole[t][:, None] + past[:, AFTER])
        # Two inserts lead from user back to user, so one at most stands before another edit there.
        cost[t, :, 2] = np.minimum(base[:, 2], base[:, 3] + INSERT)
        cost[t, :, 3] = np.minimum(base[:, 3], base[:, 2] + INSERT)
        cost[t, :, :2] = np.minimum(base[:, :2], cost[t, :, 2:3] + INSERT)
        np.minimum(cost[t], _FAR, out=cost[t])
    return cost, keep, target, rerole


def _arcs(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least cost, and per node the least letter of its cheapest arcs (0 at an end) and the node that it leads to."""
    cost, keep, target, rerole = _costs(grid)
    n, count = grid.shape
    far = np.full((1, count, 4), 2 * _FAR, np.int32)
    past = np.concatenate([far, cost[:-1]])
    kept_past = np.take_along_axis(past, np.broadcast_to(target[..., None], (n, count, 4)), 2)
    ways = np.stack([past + DELETE, cost[..., AFTER] + INSERT, keep + kept_past, rerole[..., None] + past[..., AFTER]])
    # The letters of a node's arcs differ: the least one on a cheapest path is the node's first rank.
    cheapest = (ways == cost) & (cost < _FAR)
    letter = np.where(cheapest.any(0), cheapest.argmax(0) + 1, END).astype(np.int8)
    node = np.arange(n * count * 4).reshape(n, count, 4)
    state = np.arange(4)
    row = node - state  # the node of state 0
    back = row - 4 * count
    to = np.select(
        [letter == D, letter == I, letter == K, letter == R],
        [back + state, row + AFTER, back + target[..., None], back + AFTER], node,
    )
    return cost, letter.ravel(), to.ravel()


def least_paths(codes: list[str]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per conversation the least cost, and the letters and next states of its least cheapest path."""
    grid = _grid(codes)
    cost, letter, to = _arcs(grid)
    count = len(codes)
    lengths = np.array([len(x) for x in codes])
    start = (lengths * count + np.arange(count)) * 4
    rank, pointer, path = letter.astype(np.int64), to, start[:, None]
    while (letter[path[:, -1]] != END).any():
        # Ranks and pointers of a length, and the first nodes of each path up to it: all double.
        path = np.concatenate([path, pointer[path]], axis=1)
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
    letters = letter[path]
    found = []
    for c in range(count):
        own = path[c, : int((letters[c] != END).sum()) + 1]
        found.append((int(cost[lengths[c], c, 0]), letter[own[:-1]], own[1:] % 4))
    return found


def _groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Conversations of like length, together within ``GROUP_NODES`` nodes; a longer one alone."""
    order, at = np.argsort(lengths, kind="stable"), 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * 4 * (int(lengths[order[end]]) + 1) <= GROUP_NODES:
            end += 1
        yield order[at:end]
        at = end


EDITS = "conv_id long, cost long, audit string, steps array<struct<place:int,row_no:long,edit:string,role:string>>"
_STEP_ARROW = pa.struct([("place", pa.int32()), ("row_no", pa.int64()), ("edit", pa.string()), ("role", pa.string())])
_EDITS_ARROW = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("steps", pa.list_(_STEP_ARROW))])


def edits(conversations: DataFrame) -> DataFrame:
    """``cost``, ``audit`` and the ``steps`` that leave a turn, from ``conv_id``, ``first_no`` and ``codes``.

    A step names the row that it keeps or reroles; ``role`` is null where the row's own stays.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.array(list(LETTERS))
        for batch in batches:
            codes = batch.column("codes").to_pylist()
            for own in _groups(np.array([len(x) for x in codes])):
                costs, audits, steps = [], [], []
                for c, (cost, letter, state) in zip(own, least_paths([codes[c] for c in own])):
                    row = np.cumsum(letter != I) - 1 + batch.column("first_no")[int(c)].as_py()
                    stays = np.flatnonzero(letter != D)
                    costs.append(cost)
                    audits.append("".join(letters[letter]))
                    steps.append([
                        {"place": k, "row_no": None if letter[j] == I else int(row[j]), "edit": LETTERS[letter[j]],
                         "role": None if letter[j] == K else ROLES["u" if state[j] == 2 else "a"]}
                        for k, j in enumerate(stays)
                    ])
                yield pa.RecordBatch.from_pydict(
                    {"conv_id": batch.column("conv_id").take(pa.array(own)), "cost": costs, "audit": audits, "steps": steps}, schema=_EDITS_ARROW
                )

    return conversations.select(F.col("conv_id").cast("long"), "first_no", "codes").mapInArrow(scan, EDITS)


def repaired_turns(numbered: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the repaired conversations: ``conv_id, place, edit, role, text``."""
    steps = found.select("conv_id", F.inline("steps"))
    added = steps.filter("edit = 'I'").select("conv_id", "place", "edit", "role", F.lit("").alias("text"))
    stays = steps.filter("edit <> 'I'").select("conv_id", "place", "edit", F.col("role").alias("_role"), "row_no")
    own = numbered.select("row_no", "role", "text")
    known = stays.join(own, "row_no").select("conv_id", "place", "edit", F.coalesce("_role", "role").alias("role"), "text")
    return known.unionByName(added)


def repaired(conversations: DataFrame) -> DataFrame:
    """Repaired conversations, a row per turn: ``conv_id, place, edit, role, text``.

    Null roles and texts are one space, hence faulty; rows without conv_id are one
    conversation; conversations of which nothing stays have no row.
    """
    numbered = placed(conversations)
    found = pinned(edits(coded(faults(numbered))), "edits")
    return repaired_turns(numbered, found)


def report(rows: DataFrame, original: DataFrame) -> DataFrame:
    """Faults, cost, audit and a digest of the repaired turns for every conversation of ``original``.

    ``rows`` are its rows as found.  A conversation without rows has zeros, an empty
    audit and the digest of empty text; one whose turns span more than 64 bits has
    0 gaps.  The digest is of one string, so the texts
    of one repaired conversation must fit a row.
    """
    numbered = placed(rows)
    counted = pinned(coded(faults(numbered)), "codes")
    found = pinned(edits(counted), "edits")
    line = F.struct("place", F.concat("role", F.lit(":"), "text").alias("line"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["line"]), "\n")
    digests = repaired_turns(numbered, found).groupBy("conv_id").agg(F.sha2(whole, 256).alias("repaired_sha256"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [
        original.select("conv_id").distinct(),
        counted.select("conv_id", *numbers[:-1]),
        found.select("conv_id", "cost", "audit"),
        digests,
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part, allowMissingColumns=True)
    return joined.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

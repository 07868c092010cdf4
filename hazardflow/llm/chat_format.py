"""Chat formatting by minimum-cost role repair.

A conversation is legal if it is an optional system message, then user and assistant in turn, the
user first and the assistant last. Turns that break this are repaired at least cost by three edits:
merge a turn into the message before it, give a turn another role, insert an empty message. The
legal orders form an automaton of four states (what the last message was), and each turn is a matrix
of least costs between states. Matrices combine by the min-plus product, so a conversation is worked
out in blocks: products of blocks, products of those, and so on; then the best states are handed
down to the blocks, which choose the edits of their own turns. Blocks go by the place of a turn in its
conversation, found by a sort over all tasks, not by its number: no step holds more than a block of a
conversation, however long it is and however many of its turns have one number or none.

Each turn gives one fragment of the rendered text; the fragments of a conversation in order are the
whole repaired conversation.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hazardflow.llm.store import map_arrow, stored

#: Costs of the edits.
MERGE, RELABEL, INSERT = 1, 3, 2
ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Turns of a block, and blocks of a block of blocks.
BLOCK = 256
NEVER = 1 << 40
#: States that may follow a state as the next message.
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


@functools.cache
def edits(role: str | None) -> dict[tuple[int, int], tuple[int, str, int | None]]:
    """(state before, state after) -> (cost, edit, inserted state or None) for a turn of this role."""
    out = {}
    for before in range(STATES):
        for after in (SYSTEM, USER, ASSISTANT):
            label = 0 if role == ROLES[after - 1] else RELABEL
            name = "keep" if not label else "relabel"
            options = []
            if after in _NEXT[before]:
                options.append((label, name, None))
            if before == after:
                options.append((label + MERGE, "merge" if not label else "relabel+merge", None))
            for middle in _NEXT[before]:
                if middle != SYSTEM and after in _NEXT[middle]:
                    options.append((label + INSERT, f"insert+{name}", middle))
            if options:
                out[before, after] = min(options, key=lambda o: (o[0], o[2] is not None))
    return out


#: Cost of ending in a state, and the messages to insert for it.
ENDING = {START: (0, ()), SYSTEM: (2 * INSERT, (USER, ASSISTANT)), USER: (INSERT, (ASSISTANT,)), ASSISTANT: (0, ())}


def product(a: list[int], b: list[int]) -> list[int]:
    """Min-plus product of two matrices given row by row."""
    return [min(a[i * STATES + k] + b[k * STATES + j] for k in range(STATES)) for i in range(STATES) for j in range(STATES)]


def unit() -> list[int]:
    return [0 if i == j else NEVER for i in range(STATES) for j in range(STATES)]


@functools.cache
def turn_matrix(role: str | None) -> tuple[int, ...]:
    cells = edits(role)
    return tuple(cells[i, j][0] if (i, j) in cells else NEVER for i in range(STATES) for j in range(STATES))


def path(matrices: list, entry: int, exit_: int) -> list[int]:
    """States after each matrix on the cheapest way; of equal ways the one with the least states, last first."""
    costs, back = [NEVER] * STATES, []
    costs[entry] = 0
    for m in matrices:
        step = [min((costs[i] + m[i * STATES + j], i) for i in range(STATES)) for j in range(STATES)]
        costs, choice = [s[0] for s in step], [s[1] for s in step]
        back.append(choice)
    state, states = exit_, []
    for choice in reversed(back):
        states.append(state)
        state = choice[state]
    return states[::-1]


def _message(state: int, text: str) -> str:
    return f"<|{ROLES[state - 1]}|>\n{text}"


CLOSE = "<|end|>\n"


def render(turns: list, entry: int, states: list[int], last: bool):
    """(edit, role, fragment) of each turn of a block that starts in state ``entry``."""
    before, out = entry, []
    for (role, text), after in zip(turns, states):
        _, edit, inserted = edits(role)[before, after]
        if "merge" in edit:
            fragment = "\n\n" + text
        else:
            fragment = CLOSE if before != START else ""
            if inserted is not None:
                fragment += _message(inserted, "") + CLOSE
            fragment += _message(after, text)
        out.append([edit, ROLES[after - 1], fragment])
        before = after
    if last and out:
        out[-1][2] += CLOSE + "".join(_message(s, "") + CLOSE for s in ENDING[before][1])
        if ENDING[before][1]:
            out[-1][0] += "+end"
    return out


_MATRIX = pa.list_(pa.int64())
#: Leading characters of a text by which a conversation is cut for the sort; equal ones stay in a task.
_CUT = 64


def _numbered(rows: DataFrame) -> DataFrame:
    """(conv, place, turn, position, role, text): the place of a turn in its conversation, and among those of
    its number, from rows (conv, turn, role, text) that are distinct.

    A range sort deals the rows out; each task numbers its own, and a group that goes on from the task
    before starts where that left off. To know this the driver reads two small rows a task.
    """
    dealt = rows.repartitionByRange("conv", "turn", F.col("role").asc_nulls_first(), F.substring("text", 1, _CUT))
    dealt = dealt.sortWithinPartitions("conv", "turn", F.col("role").asc_nulls_first(), "text")
    fields = [("conv", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    schema = pa.schema([*fields, ("task", pa.int32()), ("in_conv", pa.int64()), ("in_turn", pa.int64())])

    def run(batches):
        task, last, in_conv, in_turn = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            of_conv, of_turn = [], []
            for key in zip(batch.column("conv").to_pylist(), batch.column("turn").to_pylist()):
                in_conv = in_conv + 1 if last is not None and last[0] == key[0] else 0
                in_turn = in_turn + 1 if last == key else 0
                last = key
                of_conv.append(in_conv)
                of_turn.append(in_turn)
            yield [*(batch.column(name) for name, _ in fields), [task] * batch.num_rows, of_conv, of_turn]

    local = stored(map_arrow(dealt, run, schema), "sorted")
    ends = local.groupBy("task").agg(
        F.min(F.struct("conv", "turn")).alias("first"), F.max(F.struct("conv", "turn", "in_conv", "in_turn")).alias("last"))
    starts, before = [], None  # (task, conv, turn, turns of conv before the task, turns of that number before it)
    for row in sorted(ends.collect(), key=lambda r: r["task"]):  # one row a task
        first, last = row["first"], row["last"]
        goes_on = before is not None and before[0] == first["conv"]
        same = goes_on and before[1] == first["turn"]
        starts.append((row["task"], first["conv"], first["turn"], before[2] if goes_on else 0, before[3] if same else 0))
        whole = goes_on and last["conv"] == first["conv"]
        one = same and whole and last["turn"] == first["turn"]
        before = (last["conv"], last["turn"], last["in_conv"] + 1 + (before[2] if whole else 0), last["in_turn"] + 1 + (before[3] if one else 0))
    starts = rows.sparkSession.createDataFrame(starts, "task int, first_conv long, first_turn long, conv_before long, turn_before long")
    on = F.col("conv") == F.col("first_conv")
    return local.join(F.broadcast(starts), "task").select(
        "conv", (F.col("in_conv") + F.when(on, F.col("conv_before")).otherwise(0)).alias("place"), "turn",
        (F.col("in_turn") + F.when(on & (F.col("turn") == F.col("first_turn")), F.col("turn_before")).otherwise(0)).cast("int").alias("position"),
        "role", "text")


def _level(children: DataFrame) -> DataFrame:
    """(conv, parent, parts, matrix): blocks of (conv, child, matrix) rows in order, and their products."""
    grouped = children.groupBy("conv", F.floor(F.col("child") / BLOCK).alias("parent")).agg(
        F.array_sort(F.collect_list(F.struct("child", "matrix"))).alias("parts"))
    schema = pa.schema([("conv", pa.int64()), ("parent", pa.int64()), ("parts", pa.list_(pa.struct([("child", pa.int64()), ("matrix", _MATRIX)]))), ("matrix", _MATRIX)])

    def run(batches):
        for batch in batches:
            totals = [functools.reduce(product, (p["matrix"] for p in parts), unit()) for parts in batch.column("parts").to_pylist()]
            yield [batch.column("conv"), batch.column("parent"), batch.column("parts").cast(schema.field("parts").type), totals]

    return map_arrow(grouped, run, schema)


def _handed_down(level: DataFrame, above: DataFrame) -> DataFrame:
    """(conv, child, entry, exit, last) of the parts, from (conv, parent, entry, exit, last) of the blocks."""
    schema = pa.schema([("conv", pa.int64()), ("child", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("last", pa.bool_())])
    joined = level.select("conv", "parent", "parts").join(above, ["conv", "parent"])

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                states = path([p["matrix"] for p in row["parts"]], row["entry"], row["exit"])
                entries = [row["entry"], *states[:-1]]
                for i, part in enumerate(row["parts"]):
                    rows.append((row["conv"], part["child"], entries[i], states[i], row["last"] and i == len(states) - 1))
            yield list(zip(*rows)) if rows else [[]] * 5

    return map_arrow(joined, run, schema)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, position, role, edit, new_role, fragment, cost) of every turn.

    Reads conv_id, turn, role, text. Turns are in order of ``turn`` (null as 0), then role, then
    text, nulls first; ``position`` numbers the turns of equal ``turn``. Equal rows count once. A
    role that is not one of ``ROLES``, or null, is relabelled; a null text is empty. ``cost`` is the
    whole conversation's. Rows with a null conv_id belong to no conversation and give no output. Of
    repairs of equal cost the one that merges or inserts least comes first, then the one that ends in
    the least state. Texts of any length are passed on whole; an empty table gives no rows, and other
    columns are not read.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv IS NOT NULL").distinct()
    blocks = _numbered(rows).groupBy("conv", F.floor(F.col("place") / BLOCK).alias("child")).agg(
        F.array_sort(F.collect_list(F.struct("place", "turn", "position", "role", "text"))).alias("turns"))
    blocks = stored(blocks, "turns")
    schema = pa.schema([("conv", pa.int64()), ("child", pa.int64()), ("matrix", _MATRIX)])

    def block_matrix(batches):
        for batch in batches:
            roles = batch.column("roles").to_pylist()
            yield [batch.column("conv"), batch.column("child"),
                   [functools.reduce(product, (turn_matrix(r) for r in block), unit()) for block in roles]]

    children = map_arrow(blocks.select("conv", "child", F.col("turns.role").alias("roles")), block_matrix, schema)
    levels = []
    while True:
        level = stored(_level(children), "level")
        levels.append(level)
        if not level.filter("parent != 0").limit(1).count():
            break
        children = level.select("conv", F.col("parent").alias("child"), "matrix")
    top = levels[-1].groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("parent", "matrix"))).alias("parts"))
    top_schema = pa.schema([("conv", pa.int64()), ("parent", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("last", pa.bool_()), ("cost", pa.int64())])

    def best(batches):
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                matrices = [p["matrix"] for p in row["parts"]]
                total = functools.reduce(product, matrices, unit())
                cost, end = min((total[START * STATES + s] + ENDING[s][0], s) for s in range(STATES))
                states = path(matrices, START, end)
                for i, part in enumerate(row["parts"]):
                    found.append((row["conv"], part["parent"], [START, *states][i], states[i], i == len(states) - 1, cost))
            yield list(zip(*found)) if found else [[]] * 6

    above = stored(map_arrow(top, best, top_schema), "best")
    costs = above.filter("last").select("conv", "cost")
    above = above.drop("cost")
    for level in reversed(levels):
        above = _handed_down(level, above).withColumnRenamed("child", "parent")
    known = blocks.join(above.withColumnRenamed("parent", "child"), ["conv", "child"]).join(costs, "conv")
    out = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("position", pa.int32()), ("role", pa.string()),
                     ("edit", pa.string()), ("new_role", pa.string()), ("fragment", pa.string()), ("cost", pa.int64())])

    def fragments(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                turns = [(t["role"], t["text"]) for t in row["turns"]]
                states = path([turn_matrix(r) for r, _ in turns], row["entry"], row["exit"])
                made = render(turns, row["entry"], states, row["last"])
                numbers, position = ([t[name] for t in row["turns"]] for name in ("turn", "position"))
                n = len(turns)
                yield [[row["conv"]] * n, numbers, position, [r for r, _ in turns], *([m[k] for m in made] for k in range(3)), [row["cost"]] * n]

    return map_arrow(known, fragments, out)

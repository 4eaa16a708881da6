"""Chat formatting: the cheapest repair of a conversation's roles, then rendering.

A legal conversation has at most one system turn, at its start, and then user and assistant turns in turn,
user first, assistant last. Each turn of a conversation is given a role; the automaton's states say what
the last rendered turn was. A turn may keep its role (free), be relabelled, be merged into the turn before
it when that has the role it takes, or be preceded by an empty turn that makes it legal. Dynamic
programming over the states finds the repair of least total cost. The best costs between all pairs of
states of a run of turns form a small matrix; matrices multiply in (min, +), so a conversation of any
length is repaired in blocks by separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from reviewlake.llm.batches import column, cut

#: States: nothing yet, then the role of the last rendered turn.
STATES = ["start", "system", "user", "assistant"]
ROLES = STATES[1:]
#: Costs of the repairs; a role that is none of ROLES costs a relabel whatever it becomes.
RELABEL, MERGE, INSERT = 3.0, 1.0, 2.0
#: Turns of a conversation that one block holds.
BLOCK_TURNS = 512
#: Role spellings that count as a role (fixed values).
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
HEADER, FOOTER = "<|{role}|>\n", "<|end|>\n"
_INF = np.float64(1e18)


#: What may follow what in a legal conversation.
LEGAL = {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}


def _moves() -> dict[tuple[int, str], tuple[float, tuple[str, ...], bool]]:
    """(state, role taken) -> (cost without relabelling, empty turns before it, merged): the cheapest way."""
    out = {}
    for (i, state), role in product(enumerate(STATES), ROLES):
        ways = [(0.0, (), False)] if (state, role) in LEGAL else []
        ways += [(MERGE, (), True)] if state == role else []
        for empties in [(e,) for e in ROLES] + list(product(ROLES, repeat=2)):
            line = [state, *empties, role]
            if all(step in LEGAL for step in zip(line, line[1:], strict=False)):
                ways.append((INSERT * len(empties), empties, False))
        if ways:
            out[i, role] = min(ways)
    return out


_MOVES = _moves()


def _choices(given: str) -> list[list[tuple[float, int, str] | None]]:
    """Matrix of (cost, role order, role) from state to state for a turn of the given role."""
    table: list[list] = [[None] * len(STATES) for _ in STATES]
    for (i, role), (cost, _, _) in _MOVES.items():
        j = STATES.index(role)
        total = cost + (0.0 if given == role else RELABEL)
        if table[i][j] is None or total < table[i][j][0]:
            table[i][j] = (total, role)
    return table


_TABLES = {r: _choices(r) for r in [*ROLES, "other"]}
_COSTS = {r: np.array([[_INF if c is None else c[0] for c in row] for row in t]) for r, t in _TABLES.items()}
#: A conversation must not end on a system or user turn: an empty assistant turn (with a user turn before it) closes it.
_CLOSING = np.array([0.0, 2 * INSERT, INSERT, 0.0])


def canonical_role(role: str | None) -> str:
    r = (role or "").strip().lower()
    r = ALIASES.get(r, r)
    return r if r in ROLES else "other"


def block_matrix(roles: list[str]) -> np.ndarray:
    """Least cost from each state before the turns to each state behind them."""
    m = np.where(np.eye(len(STATES), dtype=bool), 0.0, _INF)
    for r in roles:
        m = np.minimum((m[:, :, None] + _COSTS[r][None]).min(axis=1), _INF)
    return m


def best_states(roles: list[str], begin: int, end: int) -> list[int]:
    """State behind each turn on the cheapest way from ``begin`` to ``end``; of equal ways the lowest states win."""
    cost = [np.full(len(STATES), _INF)]
    cost[0][begin] = 0.0
    back = []
    for r in roles:
        through = cost[-1][:, None] + _COSTS[r]
        back.append(through.argmin(axis=0))
        cost.append(np.minimum(through.min(axis=0), _INF))
    states = [end]
    for b in reversed(back[1:]):
        states.append(int(b[states[-1]]))
    return states[::-1]


def repair(roles: list[str]) -> tuple[float, list[int]]:
    """Cost and state behind each turn of a whole conversation."""
    if not roles:
        return 0.0, []
    total = block_matrix(roles)[0] + _CLOSING
    end = int(total.argmin())
    return float(total[end]), best_states(roles, 0, end)


def _render(before: int, state: int, given: str, text: str, last: bool) -> tuple[str, str]:
    """(action, rendered piece) of a turn; the pieces of a conversation in order are its rendering."""
    role = STATES[state]
    _, empties, merged = _MOVES[before, role]
    actions = (["merge"] if merged else []) + (["insert"] if empties else []) + (["relabel"] if given != role else [])
    piece = "\n" if merged else (FOOTER if before else "")
    piece += "".join(HEADER.format(role=e) + FOOTER for e in empties)
    piece += ("" if merged else HEADER.format(role=role)) + text
    if last:
        piece += FOOTER
        for e in {"system": ("user", "assistant"), "user": ("assistant",)}.get(role, ()):
            piece += HEADER.format(role=e) + FOOTER
            actions.append("close")
    return "+".join(dict.fromkeys(actions)) or "keep", piece


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, place, role_given, role_fixed, action, rendered.

    ``place`` numbers the turns of a conversation from 0 by turn (nulls first), then role, then text; joined
    in that order the ``rendered`` pieces are the conversation's text. Actions: keep, relabel, merge, insert (an
    empty turn before), close (empty turns at the end), joined by ``+``. A null role or text counts as empty;
    roles are compared without case and surrounding space, unknown ones must be relabelled. Rows with a null
    conv_id form one conversation. Repeated rows are repeated turns. Other columns are ignored.

    Turns are numbered and cut into blocks of ``BLOCK_TURNS`` along a global sort, so a conversation that
    holds a third of all rows is spread over tasks; what meets per conversation is one 4 x 4 matrix a block.
    """
    conv = column(conv_col)
    rows = turns.select(conv.alias("conv_id"), column(turn_col).cast("long").alias("turn"), column(role_col).cast("string").alias("role_given"),
                        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role_given", "text"]
    numbered = StructType([*rows.schema, StructField("part", IntegerType()), StructField("block", LongType()), StructField("idx", IntegerType())])
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    rows = cut(rows.mapInArrow(_number, numbered))
    key = ["conv_id", "part", "block"]
    conv_type = rows.schema["conv_id"].dataType
    matrix_type = StructType([StructField("conv_id", conv_type), StructField("part", IntegerType()), StructField("block", LongType()),
                              StructField("n", IntegerType()), StructField("m", ArrayType(DoubleType()))])
    matrices = rows.select("conv_id", "role_given", "part", "block").mapInArrow(_matrices(matrix_type), matrix_type)
    link_type = StructType([*matrix_type.fields[:3], StructField("before", IntegerType()), StructField("after", IntegerType()),
                            StructField("offset", LongType()), StructField("ends", BooleanType())])
    links = matrices.repartition("conv_id").sortWithinPartitions(*key).mapInArrow(_links(link_type), link_type).select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("block").alias("b"), "before", "after", "offset", "ends")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))
    joined = rows.join(links, same).select(*key, "idx", "turn", "role_given", "text", "before", "after", "offset", "ends")
    done = StructType([StructField("conv_id", conv_type), StructField("turn", LongType()), StructField("place", LongType()),
                       *[StructField(n, StringType()) for n in ("role_given", "role_fixed", "action", "rendered")]])
    return joined.repartition(*key).sortWithinPartitions(*key, "idx").mapInArrow(_rendered(done), done)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(part, schema=schema)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds block and idx along sorted rows: a block is up to BLOCK_TURNS turns of one conversation."""
    conv, n = object(), 0
    for b in batches:
        blocks, idx = [], []
        for c in b.column(0).to_pylist():
            n = n + 1 if c == conv else 0
            conv = c
            blocks.append(n // BLOCK_TURNS)
            idx.append(n % BLOCK_TURNS)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(blocks, pa.int64()), pa.array(idx, pa.int32())],
                                         names=[*b.schema.names, "block", "idx"])


def _matrices(out: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[dict]:
            for (c, p, k), turns in groupby(_rows(batches), key=lambda r: (r["conv_id"], r["part"], r["block"])):
                roles = [canonical_role(t["role_given"]) for t in turns]
                yield {"conv_id": c, "part": p, "block": k, "n": len(roles), "m": block_matrix(roles).reshape(-1).tolist()}

        yield from _batches(blocks(), to_arrow_schema(out))

    return run


def _links(out: StructType):
    """State before and behind each block on the cheapest way: a forward pass over a conversation's matrices, and back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked() -> Iterator[dict]:
            for c, group in groupby(_rows(batches), key=lambda r: r["conv_id"]):
                blocks = [(r["part"], r["block"], r["n"], np.array(r["m"]).reshape(len(STATES), -1)) for r in group]
                reach = [np.array([0.0] + [_INF] * (len(STATES) - 1))]
                for *_, m in blocks:
                    reach.append(np.minimum((reach[-1][:, None] + m).min(axis=0), _INF))
                after = int((reach[-1] + _CLOSING).argmin())
                offset = sum(b[2] for b in blocks)
                for i in range(len(blocks) - 1, -1, -1):
                    part, block, n, m = blocks[i]
                    before = int((reach[i] + m[:, after]).argmin())
                    offset -= n
                    yield {"conv_id": c, "part": part, "block": block, "before": before, "after": after, "offset": offset, "ends": i == len(blocks) - 1}
                    after = before

        yield from _batches(linked(), to_arrow_schema(out))

    return run


def _rendered(out: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[dict]:
            for _, group in groupby(_rows(batches), key=lambda r: (r["conv_id"], r["part"], r["block"])):
                held = list(group)
                roles = [canonical_role(t["role_given"]) for t in held]
                state = held[0]["before"]
                for i, (t, role, now) in enumerate(zip(held, roles, best_states(roles, state, held[0]["after"]), strict=True)):
                    action, piece = _render(state, now, role, t["text"], t["ends"] and i == len(held) - 1)
                    state = now
                    yield {"conv_id": t["conv_id"], "turn": t["turn"], "place": t["offset"] + i, "role_given": t["role_given"],
                           "role_fixed": STATES[now], "action": action, "rendered": piece}

        yield from _batches(turns(), to_arrow_schema(out))

    return run

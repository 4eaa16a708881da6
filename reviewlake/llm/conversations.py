"""Conversation structure repair: the cheapest edits that make a conversation legal, proved by branch and bound.

A legal conversation has role initials ``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turn, or no turn
at all. A turn may be kept (K, 0), given the role user or assistant (R, 1) or deleted (D, 2), and an empty user or
assistant turn may be inserted anywhere (I, 5). A blank turn and the repeat of an earlier turn must be
deleted, a truncated turn costs 5 if it stays. Of the cheapest edits those whose initials come first in ASCII are taken.

The search goes depth first with an explicit stack over (turns read, automaton state). A prefix is dropped when its
cost and the suffix's lower bound exceed every incumbent, or when the dominance table of its node
holds a prefix with a smaller (cost, audit). When the stack is empty, the incumbents are proved. Conversations are cut
into blocks of turns that are searched from each state to each state; the blocks meet as 4 x 4 matrices of costs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, IntegerType, LongType, StringType, StructField, StructType

from reviewlake.llm.batches import column, cut

#: Costs of the edits.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns of a conversation that one search handles.
BLOCK_TURNS = 128
START, SYSTEM, USER, ASSISTANT = range(4)
#: (state, role initial) -> next state.
_LEGAL = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: State after a user or assistant turn where the state asks for it.
_NEXT = [USER, USER, ASSISTANT, USER]
#: Insertions that end a conversation in a state.
_CLOSE = ["", "II", "I", ""]
_NEVER = 1 << 60
_BLANKS = " \t\n\x0b\x0c\r"


def _least(initial: str, fault: str) -> int:
    """Least cost of one turn, whatever stands beside it."""
    return DELETE if fault else 0 if initial in ("s", "u", "a") else RELABEL


def suffix_bounds(turns: list[tuple[str, str]]) -> list[int]:
    """Lower bound of the cost from each place on: every turn's least cost, and one edit per disjoint pair of
    neighbours that could both stay for nothing but not beside each other."""
    out = [0] * (len(turns) + 2)
    least = [_least(*t) for t in turns]
    for i in range(len(turns) - 1, -1, -1):
        out[i] = least[i] + out[i + 1]
        if i + 1 < len(turns) and least[i] == least[i + 1] == 0 and turns[i][0] + turns[i + 1][0] not in ("su", "ua", "au"):
            out[i] = max(out[i], RELABEL + out[i + 2])
    return out[:-1]


def search(turns: list[tuple[str, str]], entry: int) -> list[tuple[int, str] | None]:
    """Cheapest (cost, audit) from state ``entry`` to each state over ``turns`` of (role initial, fault); None where no edits lead.

    No insertion stands behind the last turn. Audits that reach the same node at the same cost are never one the
    start of the other, so the least prefix stays least whatever follows.
    """
    n, bound = len(turns), suffix_bounds(turns)
    ends = {USER, ASSISTANT} | ({entry} if entry in (START, SYSTEM) else set())
    if entry == START and any(t == ("s", "") or t == ("s", "truncated") for t in turns):
        ends.add(SYSTEM)
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(n + 1)]
    incumbents = table[n]
    worst, open_ends = _NEVER, len(ends)
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if cost + bound[i] > worst:
            continue
        held = table[i][state]
        if held is not None and held <= (cost, audit):
            continue
        table[i][state] = (cost, audit)
        if i == n:
            open_ends -= held is None
            if not open_ends:
                worst = max(incumbents[e][0] for e in ends)
            continue
        initial, fault = turns[i]
        after = _NEXT[state]
        stack.append((i, after, cost + INSERT, audit + "I"))  # popped last
        stack.append((i + 1, state, cost + DELETE, audit + "D"))
        if fault in ("", "truncated"):
            extra = TRUNCATED if fault else 0
            stack.append((i + 1, after, cost + RELABEL + extra, audit + "R"))
            kept = _LEGAL.get((state, initial))
            if kept is not None:
                stack.append((i + 1, kept, cost + extra, audit + "K"))
    return incumbents


def damage_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, chosen by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops the turn, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 gives it the role user. A null
    counts as one space in the crc32, in role and in text; conv_id and turn keep their nulls.
    """
    spaced = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced(conv_col), spaced(turn_col))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = turns.select(column(conv_col).alias("conv_id"), column(turn_col).cast("long").alias("turn"), spaced(role_col).alias("role"),
                        spaced(text_col).alias("text"), kind.alias("kind")).where("kind <> 0")
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("i"))
    return rows.drop("i")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


def _mapped(df: DataFrame, fn, out: StructType, size: int = 4096) -> DataFrame:
    """``df`` through ``fn`` from an iterator of rows to an iterator of rows, in Arrow batches."""
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = fn(_rows(batches))
        while part := list(islice(rows, size)):
            yield pa.RecordBatch.from_pylist(part, schema=schema)

    return df.mapInArrow(run, out)


def _fields(**types: DataType) -> StructType:
    return StructType([StructField(k, v) for k, v in types.items()])


_INT, _LONG, _TEXT = IntegerType(), LongType(), StringType()


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows in order with (part, block, idx): blocks of up to BLOCK_TURNS turns of one conversation, counted per partition; ``fresh``
    says that the conversation surely begins with the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, block, n, fresh, first = None, -1, 0, False, True
        for b in batches:
            blocks, idx, begins = [], [], []
            for c in b.column(0).to_pylist():
                new = first or c != conv
                if new or n == BLOCK_TURNS:
                    fresh, block, n = new and not first, block + 1, 0
                first, conv = False, c
                blocks.append(block)
                idx.append(n)
                begins.append(fresh)
                n += 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(blocks, pa.int64()), pa.array(idx, pa.int32()), pa.array(begins)],
                                             names=[*b.schema.names, "block", "idx", "fresh"])

    schema = StructType([*rows.schema, StructField("block", _LONG), StructField("idx", _INT), StructField("fresh", BooleanType())])
    return rows.mapInArrow(run, schema)


def _searched(rows: Iterator[dict]) -> Iterator[dict]:
    """One row a block: costs and audits from each state to each state, the rank of an audit among those of its entry, pairs out of order."""
    for _, block in groupby(rows, key=lambda r: (r["part"], r["block"])):
        block = list(block)
        initials = "".join(r["initial"] or " " for r in block)
        turns = [(r["initial"], r["fault"]) for r in block]
        found = [search(turns, e) if e == START or not block[0]["fresh"] else [None] * 4 for e in range(4)]
        ranks = []
        for row in found:
            order = sorted(x[1] for x in row if x)
            ranks += [order.index(x[1]) if x else -1 for x in row]
        yield {"conv_id": block[0]["conv_id"], "part": block[0]["part"], "block": block[0]["block"], "costs": [x[0] if x else _NEVER for row in found for x in row],
               "ranks": ranks, "audits": [x[1] if x else "" for row in found for x in row], "head": initials[0], "tail": initials[-1],
               "illegal": sum(p not in ("su", "ua", "au") for p in map("".join, zip(initials, initials[1:], strict=False)))}


def _linked(rows: Iterator[dict]) -> Iterator[dict]:
    """State before and behind each block on the cheapest way, by costs to go from the last block back; cost and illegal pairs on the last."""
    for conv, blocks in groupby(rows, key=lambda r: r["conv_id"]):
        blocks = list(blocks)
        close = [INSERT * len(c) for c in _CLOSE]
        togo = [close]
        for b in reversed(blocks):
            togo.append([min(b["costs"][4 * e + x] + togo[-1][x] for x in range(4)) for e in range(4)])
        togo.reverse()
        state, illegal = START, 0
        for k, b in enumerate(blocks):
            ways = [(b["costs"][4 * state + x] + togo[k + 1][x], b["ranks"][4 * state + x], x) for x in range(4) if b["costs"][4 * state + x] < _NEVER]
            after = min(ways)[2]
            illegal += b["illegal"] + (k > 0 and blocks[k - 1]["tail"] + b["head"] not in ("su", "ua", "au"))
            last = k == len(blocks) - 1
            yield {"conv_id": conv, "part": b["part"], "block": b["block"], "before": state, "after": after, "last": last,
                   "cost": togo[0][START] if last else None, "illegal": illegal if last else None}
            state = after


def _edited(rows: Iterator[dict]) -> Iterator[dict]:
    """The turns of the repaired conversation and the deleted ones, from turns with their block's audit and entry state."""
    names = {USER: "user", ASSISTANT: "assistant"}
    for _, block in groupby(rows, key=lambda r: (r["part"], r["block"])):
        edits, state, seq, row = None, START, 0, None
        block = iter(block)
        for row in block:
            if edits is None:
                edits, state = iter(row["edits"]), row["before"]
            for edit in edits:
                seq += 1
                base = {k: row[k] for k in ("conv_id", "part", "block")} | {"seq": seq, "edit": edit}
                if edit == "I":
                    state = _NEXT[state]
                    yield base | {"turn": None, "role": names[state], "text": ""}
                    continue
                role = row["role"]
                if edit == "R":
                    state = _NEXT[state]
                    role = names[state]
                elif edit == "K":
                    state = _LEGAL[state, role[:1]]
                yield base | {"turn": row["turn"], "role": role, "text": row["text"]}
                break
        for edit in edits or ():  # closing turns
            seq += 1
            state = _NEXT[state]
            yield {k: row[k] for k in ("conv_id", "part", "block")} | {"seq": seq, "edit": edit, "turn": None, "role": names[state], "text": ""}


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations, edits) of a table of turns.

    conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``gaps`` are the missing turn numbers
    between the least and the largest; of a turn only its first fault counts: blank (nothing but spaces and tab to carriage return),
    duplicate (role and text of an earlier turn), truncated (last visible character not one of ``.!?``); ``illegal`` are neighbours whose
    role initials are not su, ua or au. edits: conv_id, (part, block, seq) that sort a conversation's edits, edit (K, R, D, I), turn, role and
    text as repaired (of a deleted turn: as it was).

    Turns are ordered by number (nulls first), then role, then a hash of the text. Null roles and texts count as one
    space, rows without a conv_id form one conversation, repeated rows are repeated turns, other columns are ignored, an empty
    table gives empty tables. A conversation of any length is searched in blocks by separate tasks; per conversation only
    the blocks' 4 x 4 matrices meet.
    """
    spaced = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    rows = turns.select(column(conv_col).alias("conv_id"), column(turn_col).cast("long").alias("turn"), spaced(role_col).alias("role"), spaced(text_col).alias("text"))
    digest = F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row")
    rows = rows.select("*", *digest)
    order = ["conv_id", "turn", "role", "h", "text", "row"]
    rows = rows.repartitionByRange(*[c for c in order if c != "text"]).sortWithinPartitions(*order).drop("h", "row").withColumn("part", F.spark_partition_id())
    rows = cut(_numbered(rows))
    place = ["part", "block", "idx"]
    seen = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("seen")
    last = F.right(F.rtrim(F.col("text"), F.lit(_BLANKS)), F.lit(1))
    flags = rows.select("conv_id", "turn", *place, "fresh", F.substring("role", 1, 1).alias("initial"), last.alias("last"), seen)
    firsts = flags.groupBy("conv_id", "seen").agg(F.min(F.struct(*place)).alias("p")).select("p.*", F.lit(True).alias("first"))
    fault = F.when(F.col("last") == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated").otherwise("")
    marked = cut(flags.join(firsts, place, "left").select("conv_id", "turn", *place, "fresh", "initial", fault.alias("fault")))

    conv = marked.schema["conv_id"].dataType
    matrix = _fields(conv_id=conv, part=_INT, block=_LONG, costs=ArrayType(_LONG), ranks=ArrayType(_INT), audits=ArrayType(_TEXT), head=_TEXT, tail=_TEXT, illegal=_LONG)
    blocks = cut(_mapped(marked.drop("turn").repartition("part", "block").sortWithinPartitions(*place), _searched, matrix))
    link = _fields(conv_id=conv, part=_INT, block=_LONG, before=_INT, after=_INT, last=BooleanType(), cost=_LONG, illegal=_LONG)
    links = _mapped(blocks.drop("audits").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block"), _linked, link)
    chosen = F.element_at("audits", F.col("before") * 4 + F.col("after") + 1)
    closing = F.when(F.col("last"), F.element_at(F.array(*[F.lit(c) for c in _CLOSE]), F.col("after") + 1)).otherwise("")
    links = cut(blocks.select("part", "block", "audits").join(links, ["part", "block"]).select(
        "conv_id", "part", "block", "before", "cost", "illegal", F.concat(chosen, closing).alias("edits")))

    edit = _fields(conv_id=conv, part=_INT, block=_LONG, seq=_INT, edit=_TEXT, turn=_LONG, role=_TEXT, text=_TEXT)
    joined = rows.select("conv_id", "turn", "role", "text", *place).join(links.select("part", "block", "before", "edits"), ["part", "block"])
    edits = _mapped(joined.repartition("part", "block").sortWithinPartitions(*place), _edited, edit)

    count = lambda kind: F.count_if(F.col("fault") == kind).alias(kind)
    found = marked.groupBy("conv_id").agg(*[count(k) for k in ("blank", "duplicate", "truncated")])
    numbers = marked.where("turn is not null").groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"))
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "block", "edits"))), lambda p: p["edits"]), "")
    audits = links.groupBy("conv_id").agg(F.max("illegal").alias("illegal"), F.max("cost").alias("cost"), audit.alias("audit"))
    parts = [found, numbers, audits]
    return merge_facts(parts, {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": ""}), edits


def merge_facts(parts: list[DataFrame], columns: dict) -> DataFrame:
    """One row per conv_id (null is one, too) with ``columns`` from whichever of ``parts`` has them, else the given default."""
    all_rows = parts[0]
    for p in parts[1:]:
        all_rows = all_rows.unionByName(p, allowMissingColumns=True)
    value = lambda c, d: F.coalesce(F.max(c), F.lit(d).cast("long") if isinstance(d, int) else F.lit(d)).alias(c)
    return all_rows.groupBy("conv_id").agg(*[value(c, d) for c, d in columns.items()])


def _hashed(rows: Iterator[dict]) -> Iterator[dict]:
    for conv, edits in groupby(rows, key=lambda r: r["conv_id"]):
        h, first = hashlib.sha256(), True
        for r in edits:
            h.update(b"" if first else b"\n")
            h.update(r["line"])
            first = False
        yield {"conv_id": conv, "repaired_sha256": h.hexdigest()}


def repaired_digests(edits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of each conversation's remaining ``role:text`` lines, joined by line feeds.

    The digest of one text cannot be split, so a conversation's lines pass through one task, as a stream that holds none of them.
    """
    line: Column = F.concat_ws(":", "role", "text").cast(BinaryType())
    rows = edits.where("edit <> 'D'").select("conv_id", "part", "block", "seq", line.alias("line"))
    conv = rows.schema["conv_id"].dataType
    return _mapped(rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "seq"), _hashed, _fields(conv_id=conv, repaired_sha256=_TEXT))

"""Repair of conversations to (system)? (user assistant)+ at least cost, decided by one integer minimum.

A way to repair a conversation is a path through a graph without cycles: its nodes are (rows consumed, turns inserted,
last role), its edges keep, give a role to, delete or insert a turn.  The weight of a path is one integer: the high digits
are its cost, the low digits, one octal digit per edit from the left, spell its audit (D, I, K, R as 1 to 4, 0 after
the end).  Every edge adds a number, so the least integer is the cheapest repair and, of equally cheap ones, the one whose
audit is least in ASCII.

Conversations are cut into chunks of a sorted table.  A chunk becomes the least weights between any two last roles;
such tables, a few numbers each, are put together per conversation, and no task holds the turns of a long one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .store import stored

START, SYSTEM, USER, ASSISTANT = range(4)  # last role of what was written so far
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WRITTEN = {"u": "user", "a": "assistant"}
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = str.maketrans("1234", "DIKR")
DIGIT = 3  # bits of a letter
FOLLOWS = {"su", "ua", "au"}
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # of a truncated turn that stays

    def most_inserts(self, n_rows: int) -> int:
        """Turns that the cheapest path may insert while it consumes ``n_rows`` rows.

        An inserted turn stands in a pair (user, assistant).  Without the pair, and without the system turn where no other
        pair follows it, at most two rows more are deleted; so inserting never pays if it costs more than two deletions.
        Else deleting all rows, and inserting three turns to end in any role, is as much as the path may cost.
        """
        return 0 if self.insert > 2 * self.delete else self.delete * n_rows // self.insert + 3


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by crc32 of ``conv:turn`` modulo 20 (NULL is one space): 0 drops the row (``present`` is false), 1 empties
    its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it the user's."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in (conv, turn)]).cast("binary")) % 20
    said = F.coalesce(F.col(text), blank)
    marked = df.select(
        F.col(conv), F.col(turn),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), blank)).alias(role),
        F.when(kind == 1, "").when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias(text),
        (kind != 0).alias("present"), F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return marked.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def transfer(rows: list[tuple[str, bool, bool]], costs: Costs) -> dict[tuple[int, int, int], int]:
    """(last role before, turns inserted, last role after) -> least weight of the paths that consume ``rows``.

    A row is (initial of its role, must go, is truncated).  Weights have a digit for every row and possible insertion.
    """
    most = costs.most_inserts(len(rows))
    length = len(rows) + most
    unit = 1 << DIGIT * length
    found = {}
    for before in NEXT:
        nodes = {(0, before): 0}
        for i, (initial, must_go, truncated) in enumerate(rows):
            _insert(nodes, most, costs.insert * unit, length - 1 - i)
            new: dict[tuple[int, int], int] = {}
            stays = costs.truncated if truncated else 0
            for (k, last), w in nodes.items():
                place = DIGIT * (length - 1 - i - k)
                _least(new, (k, last), w + costs.delete * unit + (DELETE << place))
                if not must_go:
                    for to, after in NEXT[last].items():
                        if to == initial:
                            _least(new, (k, after), w + (costs.keep + stays) * unit + (KEEP << place))
                        if to in WRITTEN:
                            _least(new, (k, after), w + (costs.rerole + stays) * unit + (REROLE << place))
            nodes = new
        found.update({(before, k, last): w for (k, last), w in nodes.items()})
    return found


def _least(nodes: dict, key, weight: int) -> bool:
    if key in nodes and nodes[key] <= weight:
        return False
    nodes[key] = weight
    return True


def _insert(nodes: dict[tuple[int, int], int], most: int, cost: int, place: int) -> None:
    """Paths that insert turns here; the letter of the first stands at digit ``place`` from the right."""
    for k in range(most):
        for last in NEXT:
            if (k, last) in nodes:
                for to, after in NEXT[last].items():
                    if to in WRITTEN:
                        _least(nodes, (k + 1, after), nodes[k, last] + cost + (INSERT << DIGIT * (place - k)))


def joined(parts: list[tuple[int, dict[tuple[int, int, int], int]]], costs: Costs) -> tuple[int, str, list[int]]:
    """Cost, audit and the last role before each part of the cheapest path through parts (rows, weights) in order."""
    nodes, length, n_rows, back = {(0, START): 0}, 0, 0, []
    for n, table in parts:
        more, mask = n + costs.most_inserts(n), (1 << DIGIT * length) - 1
        new, came = {}, {}
        for (before, k2, after), t in table.items():
            for (k, last), w in nodes.items():
                if last == before:
                    cost = (w >> DIGIT * length) + (t >> DIGIT * more)
                    low = ((w & mask) << DIGIT * more) + ((t & ((1 << DIGIT * more) - 1)) << DIGIT * (length - n_rows - k))
                    if _least(new, (k + k2, after), (cost << DIGIT * (length + more)) + low):
                        came[k + k2, after] = (k, last)
        nodes, length, n_rows = new, length + more, n_rows + n
        back.append(came)
    ends, room = dict(nodes), min(2, costs.most_inserts(n_rows))
    came = {key: key for key in ends}
    for _ in range(room):  # turns inserted at the end; two digits more
        length, ends = length + 1, {key: (w >> DIGIT * length << DIGIT * (length + 1)) + ((w & ((1 << DIGIT * length) - 1)) << DIGIT) for key, w in ends.items()}
        for (k, last), w in list(ends.items()):
            for to, after in NEXT[last].items():
                if to in WRITTEN and _least(ends, (k + 1, after), w + (costs.insert << DIGIT * length) + (INSERT << DIGIT * (length - 1 - n_rows - k))):
                    came[k + 1, after] = came[k, last]
    best = min((w, key) for key, w in ends.items() if key[1] in (START, ASSISTANT))
    low = best[0] & ((1 << DIGIT * length) - 1)
    audit = f"{low:0{length}o}".rstrip("0").translate(LETTERS) if length else ""
    starts, key = [], came[best[1]]
    for step in reversed(back):
        key = step[key]
        starts.append(key[1])
    return best[0] >> DIGIT * length, audit, starts[::-1]


def deal(audit: str, sizes: list[int]) -> list[str]:
    """The audit cut into the letters of each part; turns inserted after the last row go to the last part."""
    out, at = [], 0
    for n in sizes:
        start = at
        while n:
            n -= audit[at] != "I"
            at += 1
        out.append(audit[start:at])
    if out:
        out[-1] += audit[at:]
    return out


def rewritten(letters: str, last: int, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) that edits of rows leave, when ``last`` is the last role before them."""
    at = 0
    for letter in letters:
        role, text = ("", "") if letter == "I" else rows[at]
        at += letter != "I"
        if letter != "D":
            to = role[:1] if letter == "K" else next(t for t in NEXT[last] if t in WRITTEN)
            last = NEXT[last][to]
            yield (role if letter == "K" else WRITTEN[to]), text


class Chunk:
    """Consecutive rows of one conversation and what is counted over them."""

    def __init__(self, conv):
        self.conv, self.rows, self.faults, self.turns, self.size = conv, [], [], [], 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        end = text.rstrip(SPACES)[-1:]
        fault = "blank" if not end else "duplicate" if repeated else "truncated" if end not in ".!?" else ""
        self.rows.append((role, text))
        self.faults.append(fault)
        self.turns.append(turn)
        self.size += len(role) + len(text)

    def record(self, key: int, costs: Costs) -> dict:
        initials = [r[:1] for r, _ in self.rows]
        known = [t for t in self.turns if t is not None]
        table = transfer([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, self.faults)], costs) if self.rows else {}
        return {
            "key": key, "conv": self.conv, "n": len(self.rows), **{f: self.faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in FOLLOWS for a, b in zip(initials, initials[1:])), "ends": [initials[0], initials[-1]] if initials else None,
            "turns": [known[0], known[-1]] if known else None, "n_turns": len(set(known)),
            "paths": [f"{b},{k},{a},{w:x}" for (b, k, a), w in table.items()], "rows": [{"role": r, "text": t} for r, t in self.rows],
        }


def sorted_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (conv, turn, role, text, present, repeated) in the order of conversations, cut anywhere into partitions.

    Rows of one turn go by role, the text's first 64 characters and its hash.  A row is a repetition unless it is
    the first of its role and text; the first ones are found by an aggregate and marked by row number, so neither
    a long conversation nor a frequent text meets in one task.
    """
    present = F.col("present") if "present" in df.columns else F.lit(True)
    own = df.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), present.alias("present"), F.monotonically_increasing_id().alias("number"),
    )
    rows = stored(own)
    place = F.struct("turn", "number")
    first = rows.where("present").groupBy("conv", "role", F.sha2("text", 256)).agg(F.min(place).alias("place")).select(F.col("place.number").alias("number"), F.lit(False).alias("repeated"))
    marked = rows.join(first, "number", "left").withColumn("repeated", F.coalesce("repeated", F.lit(True)))
    order = ["conv", "turn", "role", "__head", "__hash", "number"]
    keyed = marked.withColumns({"__head": F.substring("text", 1, 64), "__hash": F.xxhash64("text")})
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "present", "repeated")


FIELDS = (
    "n long, blank long, duplicate long, truncated long, illegal long, ends array<string>, turns array<long>, n_turns long, "
    "paths array<string>, rows array<struct<role:string,text:string>>"
)


def chunks(ordered: DataFrame, costs: Costs, most_rows: int, most_chars: int) -> DataFrame:
    """One record per chunk; their keys follow the order of the rows.  A conversation without present rows has an empty one."""
    kind = ordered.schema["conv"].dataType.simpleString()
    schema = f"key long, conv {kind}, {FIELDS}"
    arrow = to_arrow_type(ordered.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunk, out, size = TaskContext.get().partitionId() << 40, None, [], 0

        def batch_of(records: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_struct_array(pa.array(records, arrow))

        for batch in batches:
            for conv, turn, role, text, present, repeated in zip(*(c.to_pylist() for c in batch.columns)):
                if chunk is None or conv != chunk.conv or len(chunk.rows) >= most_rows or chunk.size >= most_chars:
                    if chunk is not None:
                        out.append(chunk.record(key, costs))
                        key, size = key + 1, size + chunk.size
                        if len(out) >= 1000 or size >= most_chars:
                            yield batch_of(out)
                            out, size = [], 0
                    chunk = Chunk(conv)
                if present:
                    chunk.add(turn, role, text, repeated)
        if chunk is not None:
            yield batch_of([*out, chunk.record(key, costs)])

    return ordered.mapInArrow(run, schema)


def by_conversation(df: DataFrame, order: list[str]) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", *order)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """Runs of records with one ``conv``, as iterators that must be read in turn."""
    return groupby((r for b in batches for part in range(0, b.num_rows, 512) for r in b.slice(part, 512).to_pylist()), key=lambda r: r["conv"])


def verdicts(pieces: DataFrame, costs: Costs) -> DataFrame:
    """One record per conversation: counts, cost, audit, and the letters of each of its chunks."""
    kind = pieces.schema["conv"].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = f"conv {kind}, {', '.join(f'{c} long' for c in counts)}, audit string, parts array<struct<key:long,last:int,letters:string>>"
    arrow = to_arrow_type(pieces.sparkSession.createDataFrame([], schema).schema)

    def judge(conv, records: list[dict]) -> dict:
        held = [r for r in records if r["n"]]
        out = {"conv": conv, **{f: sum(r[f] for r in records) for f in ("blank", "duplicate", "truncated", "illegal")}}
        out["illegal"] += sum(a["ends"][1] + b["ends"][0] not in FOLLOWS for a, b in zip(held, held[1:]))
        timed = [r for r in held if r["turns"]]
        different = sum(r["n_turns"] for r in timed) - sum(a["turns"][1] == b["turns"][0] for a, b in zip(timed, timed[1:]))
        out["gaps"] = timed[-1]["turns"][1] - timed[0]["turns"][0] + 1 - different if timed else 0
        tables = []
        for r in held:
            paths = [p.split(",") for p in r["paths"]]
            tables.append((r["n"], {(int(b), int(k), int(a)): int(w, 16) for b, k, a, w in paths}))
        out["cost"], out["audit"], starts = joined(tables, costs)
        letters = deal(out["audit"], [r["n"] for r in held])
        out["parts"] = [{"key": r["key"], "last": s, "letters": x} for r, s, x in zip(held, starts, letters)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, records in groups(batches):
            out.append(judge(conv, list(records)))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_struct_array(pa.array(out, arrow))
                out = []
        yield pa.RecordBatch.from_struct_array(pa.array(out, arrow))

    return by_conversation(pieces.drop("rows"), ["key"]).mapInArrow(run, schema)


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    costs: Costs = Costs(), most_rows: int = 512, most_chars: int = 1 << 22,
) -> tuple[DataFrame, DataFrame]:
    """Judge and repair conversations: (one row per conversation, one row per repaired turn).

    Rows stand by turn, NULL first; NULL roles and texts are one space; rows whose column ``present`` is false (it may be
    missing) only say that their conversation exists.  A row's first fault counts: blank (spaces only), duplicate (role and
    text seen earlier), truncated (its last character but spaces is no full stop, exclamation or question mark).  Blank and
    duplicate rows must go.  What is left reads system? (user assistant)+ by the initials of the roles, or is empty.

    The first table has the conversation, gaps (turn numbers missing between the least and the largest), blank, duplicate,
    truncated, illegal (neighbours other than su, ua, au), cost and audit; the second the conversation, position (rises
    in order, with gaps), role and text.  A NULL conversation is one like others.  Chunks hold ``most_rows`` rows, and end after
    ``most_chars`` characters.  Empty tables give empty ones.
    """
    pieces = stored(chunks(sorted_rows(df, conv, turn, role, text), costs, most_rows, most_chars))
    judged = stored(verdicts(pieces, costs))
    letters = judged.select(F.explode("parts").alias("part")).select("part.*")
    whole = pieces.select("key", "conv", "rows").join(letters, "key")
    kind = pieces.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, key long, at int, role string, text string"
    arrow = to_arrow_type(df.sparkSession.createDataFrame([], schema).schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(start, 64).to_pylist():
                    turns = rewritten(r["letters"], r["last"], [(x["role"], x["text"]) for x in r["rows"]])
                    out += [{"conv": r["conv"], "key": r["key"], "at": i, "role": a, "text": b} for i, (a, b) in enumerate(turns)]
                yield pa.RecordBatch.from_struct_array(pa.array(out, arrow))

    turns = whole.mapInArrow(write, schema)
    named = judged.select(F.col("conv").alias(conv), *[c for c in judged.columns if c not in ("conv", "parts")])
    position = F.struct("key", "at")
    return named, turns.select(F.col("conv").alias(conv), position.alias("position"), F.col("role").alias(role), F.col("text").alias(text))


def digests(turns: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """SHA-256 of every conversation's ``role:text`` lines, read in order: the hash needs no conversation in memory."""
    own = turns.select(F.col(conv).alias("conv"), "position", F.concat_ws(":", role, text).alias("line"))
    schema = f"conv {own.schema['conv'].dataType.simpleString()}, sha256 string"
    arrow = to_arrow_type(turns.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, records in groups(batches):
            digest = hashlib.sha256()
            for i, r in enumerate(records):
                digest.update(("\n" if i else "").encode() + r["line"].encode())
            out.append({"conv": conv, "sha256": digest.hexdigest()})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_struct_array(pa.array(out, arrow))
                out = []
        yield pa.RecordBatch.from_struct_array(pa.array(out, arrow))

    return by_conversation(own, ["position"]).drop("position").mapInArrow(run, schema).withColumnRenamed("conv", conv)

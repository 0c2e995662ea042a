"""Repair of conversations: the cheapest edits that give a well-formed order of turns, with an audit string.

Every row is kept (cost 0), given another role (1) or deleted (2), and an empty turn may be inserted anywhere (5), so that
the initials of the roles read ``(s?(ua)+)?``.  Blank rows and repetitions must go; truncated rows that stay add 5.  Among
the cheapest sequences of edits the one whose letters (D, I, K, R) come first in ASCII is taken.

The search keeps, per row and per state of the pattern, the best sequence so far as a node of a tree: parent, letter,
length, rolling hash, ancestors at powers of two.  Sequences share their beginnings, so a step adds a few nodes and copies
nothing.  Equal costs are decided by the longest common prefix, searched through the ancestors by hash and verified letter
by letter up to where both paths meet; a collision falls back to the letters.  One sequence can't be the beginning of
another that costs the same and has read the same rows, since what they differ by would be insertions.

A step only depends on the state before, so a run of rows is a table from states to states.  Rows are sorted over all
partitions by conversation and turn; a conversation that spans several becomes a table for each, and only these tables
meet.  So a conversation may hold any part of all rows.  Its audit is one string, and the digest of its repaired text is
by nature computed in order; rows pass by one after the other, and nothing but the hash is held.

Rows go by turn, null ones first; equal turns by role, then by a digest of role and text, so repeated rows are adjacent.
A null role or text is one blank.  A null ``conv_id`` is a conversation of its own.  Fractional turns are cut to whole
numbers.  An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siftwork.sources.shared import stage

SPACE = r"[ \t\n\x0B\f\r]"
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
RETYPE, DELETE, INSERT, BROKEN = 1, 2, 5, 5
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# Where a turn of each kind may follow, and the state it leads to.
AFTER = {"s": ((EMPTY,), SYSTEM), "u": ((EMPTY, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Trail:
    """Sequences of letters as nodes of a tree; node 0 is the empty one."""

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(letter)) % MODULUS)
        ancestors, k = [parent], 0
        while k < len(self.up[ancestors[k]]):
            ancestors.append(self.up[ancestors[k]][k])
            k += 1
        self.up.append(ancestors)
        return node

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor at that depth."""
        while self.depth[node] > depth:
            gap = self.depth[node] - depth
            node = self.up[node][min(gap.bit_length() - 1, len(self.up[node]) - 1)]
        return node

    def equal(self, x: int, y: int) -> bool:
        """Letter by letter, up to where both paths meet."""
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def less(self, x: int, y: int) -> bool:
        """Whether x's sequence comes before y's."""
        both = min(self.depth[x], self.depth[y])
        a, b = self.lifted(x, both), self.lifted(y, both)
        if self.hash[a] == self.hash[b]:
            return self.depth[x] < self.depth[y] if self.equal(a, b) else self.text(x) < self.text(y)
        # The highest ancestors that differ; their parents are the longest common prefix.
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if not self.equal(self.up[a][0], self.up[b][0]):
            return self.text(x) < self.text(y)
        return self.letter[a] < self.letter[b]


class Search:
    """The best sequences from one state, as (cost, node) per state reached."""

    def __init__(self, trail: Trail, start: int):
        self.trail = trail
        self.best: list[tuple[int, int] | None] = [None] * STATES
        self.best[start] = (0, 0)
        self._insert()

    def _offer(self, best: list, state: int, cost: int, parent: int, letter: str) -> None:
        held = best[state]
        if held is not None and held[0] < cost:
            return
        node = self.trail.add(parent, letter)
        if held is None or cost < held[0] or self.trail.less(node, held[1]):
            best[state] = (cost, node)

    def _insert(self) -> None:
        """Insertions after what has been read: a user's turn, then an assistant's; more can't pay."""
        for state, kind in ((USER, "u"), (ASSISTANT, "a")):
            for before in AFTER[kind][0]:
                if self.best[before] is not None:
                    cost, node = self.best[before]
                    self._offer(self.best, state, cost + INSERT, node, "I")

    def row(self, initial: str, fault: int) -> None:
        after: list[tuple[int, int] | None] = [None] * STATES
        more = BROKEN if fault == TRUNCATED else 0
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, node = held
            self._offer(after, state, cost + DELETE, node, "D")
            if fault >= DUPLICATE:
                continue
            for kind in "sua":
                froms, to = AFTER[kind]
                if state in froms:
                    if initial == kind:
                        self._offer(after, to, cost + more, node, "K")
                    elif kind != "s":
                        self._offer(after, to, cost + RETYPE + more, node, "R")
        self.best = after
        self._insert()


def table_of(initials: str, faults: np.ndarray, starts: tuple[int, ...]) -> list[tuple[int, int, int, str]]:
    """(start, end, cost, audit) for a run of rows."""
    out = []
    for start in starts:
        trail = Trail()
        search = Search(trail, start)
        for initial, fault in zip(initials, faults.tolist()):
            search.row(initial, fault)
        out += [(start, end, held[0], trail.text(held[1])) for end, held in enumerate(search.best) if held is not None]
    return out


@dataclass(frozen=True, eq=False)
class Way:
    """A sequence over several runs: what came before, the state it has reached, and the last run's letters."""

    before: Way | None
    cost: int
    end: int
    letters: str

    def less(self, other: Way) -> bool:
        """Whether it is cheaper, or costs the same and comes first; what both share isn't looked at."""
        if self.cost != other.cost:
            return self.cost < other.cost
        x, y, mine, others = self, other, [], []
        while x is not y:
            mine.append(x.letters)
            others.append(y.letters)
            x, y = x.before, y.before
        return "".join(reversed(mine)) < "".join(reversed(others))


def path_through(tables: list[list[tuple[int, int, int, str]]]) -> list[Way]:
    """Cheapest way through the tables of a conversation's runs, run by run."""
    reached: dict[int, Way | None] = {EMPTY: None}
    for table in tables:
        after: dict[int, Way | None] = {}
        for start, end, cost, letters in table:
            if start in reached:
                held = reached[start]
                offer = Way(held, cost + (held.cost if held else 0), end, letters)
                if end not in after or offer.less(after[end]):
                    after[end] = offer
        reached = after
    way = reached.get(EMPTY)
    done = reached.get(ASSISTANT)
    if way is None or (done is not None and done.less(way)):
        way = done
    out = []
    while way is not None:
        out.append(way)
        way = way.before
    return out[::-1]


def damaged(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows (conv, turn, role, text) with the faults that crc32 of ``conv:turn`` plants."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col(f"`{conv}`").cast("string"), blank), F.lit(":"), F.coalesce(F.col(f"`{turn}`").cast("string"), blank))
    case = F.crc32(name.cast("binary")) % 20
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text"),
        case.alias("case"),
    ).where("case <> 0")
    rows = rows.withColumn("text", F.when(F.col("case") == 1, F.lit("")).when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("case") == 4, F.lit("user")).otherwise(F.col("role")))
    copies = F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv", "turn", "role", "text", copies.alias("copy")).drop("copy")


def sorted_rows(rows: DataFrame) -> DataFrame:
    """All rows in order, with their fault and a number (``place``) that runs on within a partition (``part``)."""
    blank = F.lit(" ")
    rows = rows.select("conv", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = stage(rows.withColumn("said", F.unhex(F.sha2(said.cast("binary"), 256))).withColumn("id", F.monotonically_increasing_id()), "turns")
    firsts = rows.groupBy(F.col("conv").alias("c"), F.col("said").alias("s")).agg(F.min(F.struct("turn", "id"))["id"].alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = rows.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left")
    fault = (
        F.when(~F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), BLANK)
        .when(F.col("id") != F.col("first"), DUPLICATE)
        .when(~F.col("text").rlike(rf"[.!?]{SPACE}*\z"), TRUNCATED)
        .otherwise(FINE)
    )
    # Equal rows differ in their id, so that a range can end between any two rows.
    order = ["conv", "turn", "role", "said", "id"]
    seen = seen.select(*order, "text", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"))
    placed = seen.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    return stage(placed.withColumn("part", F.shiftright("place", 33)), "turns-in-order")


TABLE = "table array<struct<start:int,end:int,cost:long,audit:string>>"
COUNTS = "turns long, low long, high long, blank long, duplicate long, truncated long, illegal long"


def runs_of(rows: DataFrame) -> DataFrame:
    """Per partition and conversation its counts and table; ``edge`` where the conversation may go on elsewhere."""
    kind = rows.schema["conv"].dataType.simpleString()

    def summed(run: pd.DataFrame, edge: bool) -> dict:
        initials, fault = run["initial"].tolist(), run["fault"].to_numpy()
        turns = run["turn"].dropna()
        table = table_of(initials, fault, tuple(range(STATES)) if edge else (EMPTY,))
        return {
            "conv": run["conv"].iloc[0],
            "part": int(run["part"].iloc[0]),
            "first": int(run["place"].iloc[0]),
            "edge": edge,
            "head": initials[0],
            "tail": initials[-1],
            "turns": turns.nunique(),
            "low": int(turns.iloc[0]) if len(turns) else None,
            "high": int(turns.iloc[-1]) if len(turns) else None,
            "blank": int((fault == BLANK).sum()),
            "duplicate": int((fault == DUPLICATE).sum()),
            "truncated": int((fault == TRUNCATED).sum()),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "table": [{"start": s, "end": e, "cost": c, "audit": a} for s, e, c, a in table],
        }

    def frame_of(out: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(out).astype({"low": "Int64", "high": "Int64"})

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the run that is not known to be over
        opens = True  # it is the first of its part
        for frame in frames:
            if not len(frame):
                continue
            frame["turn"] = frame["turn"].astype("Int64")
            out = []
            name = frame["conv"]
            other = (name != name.shift()) & ~(name.isna() & name.shift().isna())
            cuts = np.flatnonzero((other | (frame["part"] != frame["part"].shift())).to_numpy())
            cuts = cuts[cuts > 0]
            for start, stop in zip([0, *cuts], [*cuts, len(frame)]):
                piece = frame.iloc[start:stop]
                if held:
                    last = held[-1].iloc[-1]
                    new_part = last["part"] != piece["part"].iloc[0]
                    same = not new_part and (last["conv"] == piece["conv"].iloc[0] or (pd.isna(last["conv"]) and pd.isna(piece["conv"].iloc[0])))
                    if not same:
                        out.append(summed(pd.concat(held), opens or new_part))
                        held, opens = [], new_part
                held.append(piece)
            if out:
                yield frame_of(out)
        if held:
            yield frame_of([summed(pd.concat(held), True)])

    few = rows.select("conv", "turn", "initial", "fault", "place", "part")
    few = few.repartition("part").sortWithinPartitions("part", "place")
    return few.mapInPandas(read, f"conv {kind}, part long, first long, edge boolean, head string, tail string, {COUNTS}, {TABLE}")


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def paths_of(runs: DataFrame) -> DataFrame:
    """Per run the state it ends in and its letters; the conversation's report stands with its first run, others have nulls."""
    kind = runs.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, first long, end int, letters string, {REPORT}"

    def joined(pieces: list[dict]) -> list[dict]:
        ways = path_through([[(t["start"], t["end"], t["cost"], t["audit"]) for t in p["table"]] for p in pieces])
        out = [{"conv": p["conv"], "first": p["first"], "end": w.end, "letters": w.letters} for p, w in zip(pieces, ways)]
        dated = [p for p in pieces if not pd.isna(p["low"])]
        # A turn that goes on in the next run counts once.
        distinct = sum(p["turns"] for p in dated) - sum(x["high"] == y["low"] for x, y in zip(dated, dated[1:]))
        report = {
            "gaps": int(dated[-1]["high"]) - int(dated[0]["low"]) + 1 - distinct if dated else 0,
            "illegal": sum(p["illegal"] for p in pieces) + sum(x["tail"] + y["head"] not in LEGAL for x, y in zip(pieces, pieces[1:])),
            "cost": ways[-1].cost,
            "audit": "".join(w.letters for w in ways),
        }
        out[0] |= report | {n: sum(p[n] for p in pieces) for n in ("blank", "duplicate", "truncated")}
        return out

    names = [x.split()[0] for x in schema.split(", ")]

    def frame_of(rows: list[dict]) -> pd.DataFrame:
        whole = [x.split()[0] for x in schema.split(", ") if x.endswith(" long")]
        return pd.DataFrame(rows, columns=names).astype({n: "Int64" for n in whole if n != "conv"})

    def alone(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [r for p in frame.to_dict("records") for r in joined([p])]
            yield frame_of(rows)

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        return frame_of(joined(frame.sort_values("first").to_dict("records")))

    single = runs.where("NOT edge").mapInPandas(alone, schema)
    return single.unionByName(runs.where("edge").groupBy("conv").applyInPandas(together, schema))


def edits_of(paths: DataFrame) -> DataFrame:
    """One row per edit: place of the row it stands at, order there, letter, and the role it gives, if any."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []

        def frame_of() -> pd.DataFrame:
            return pd.DataFrame(out, columns=["place", "order", "letter", "given"])

        for frame in frames:
            for first, end, letters in zip(frame["first"], frame["end"], frame["letters"]):
                # Users and assistants take turns up to the state at the end, whatever comes before them.
                stays = sum(x != "D" for x in letters)
                rows = sum(x != "I" for x in letters)
                read = 0
                for order, letter in enumerate(letters):
                    given = None
                    if letter != "D":
                        stays -= 1
                        if letter != "K":
                            given = ROLE[end if stays % 2 == 0 else USER + ASSISTANT - end]
                    # A run has a row at least; what is inserted after its last row stands there.
                    out.append((int(first) + min(read, rows - 1), order, letter, given))
                    read += letter != "I"
                    if len(out) >= 50_000:
                        yield frame_of()
                        out.clear()
        if out:
            yield frame_of()

    return paths.select("first", "end", "letters").mapInPandas(walk, "place long, order long, letter string, given string")


def repaired(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """The rows that stay: conv, place and order (their sequence), letter, role, text."""
    source = rows.select("conv", "place", F.col("role").alias("own"), "text")
    both = edits_of(paths).where("letter <> 'D'").join(source, "place")
    text = F.when(F.col("letter") == "I", F.lit("")).otherwise(F.col("text")).alias("text")
    return both.select("conv", "place", "order", "letter", F.coalesce("given", "own").alias("role"), text)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation the SHA-256 of its ``role:text`` lines; turns pass in order, one at a time."""
    kind = turns.schema["conv"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state = None, None

        def done() -> pd.DataFrame:
            return pd.DataFrame({"conv": names, "repaired_sha256": hashes})

        names, hashes = [], []
        for frame in frames:
            for conv, role, text in zip(frame["conv"], frame["role"], frame["text"]):
                conv = None if pd.isna(conv) else conv
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if state is not None and conv == name:
                    state.update(b"\n" + line)
                    continue
                if state is not None:
                    names.append(name)
                    hashes.append(state.hexdigest())
                name, state = conv, hashlib.sha256(line)
            if names:
                yield done()
                names, hashes = [], []
        if state is not None:
            names, hashes = [name], [state.hexdigest()]
            yield done()

    ordered = turns.select("conv", "place", "order", "role", "text").repartition("conv").sortWithinPartitions("conv", "place", "order")
    return ordered.mapInPandas(run, f"conv {kind}, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For rows (conv, turn, role, text): a report per conversation, and the repaired turns."""
    ordered = sorted_rows(rows)
    paths = stage(paths_of(stage(runs_of(ordered), "conversation-runs")), "conversation-paths")
    report = paths.where("audit IS NOT NULL").select("conv", *[x.split()[0] for x in REPORT.split(", ")])
    return report, repaired(ordered, paths)


def repair_damaged(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damages ``df`` by rule and repairs it: one row per conversation of ``df``, with the digest of its repaired text."""
    report, turns = repair(damaged(df, conv=conv, turn=turn, role=role, text=text))
    every = df.select(F.col(f"`{conv}`").alias(conv)).distinct()
    hashes = digests(turns).select(F.col("conv").alias("c"), "repaired_sha256")
    out = every.join(report, F.col(f"`{conv}`").eqNullSafe(F.col("conv")), "left").join(hashes, F.col(f"`{conv}`").eqNullSafe(F.col("c")), "left")
    numbers = [F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(F.col(f"`{conv}`"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))

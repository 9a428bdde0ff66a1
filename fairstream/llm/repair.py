"""Conversation structure repair: the cheapest edits that make a conversation's
roles ``(s?(ua)+)?``, and of those the ones whose audit is least in ASCII.

1. Rows are range-partitioned by conversation and turn and written with their
   place (``pos``) and their partition (``part``), so a hot conversation is cut
   over as many tasks as its rows fill. Faults are Spark columns; the first row
   of each (conversation, role, text) comes from a partial aggregate.
2. Cost DP. A state is what the repaired roles so far allow next (nothing yet,
   after s, after u, after a). Each row is a min-plus matrix of four states by
   four; suffix products by doubling give every node (row, state) its cost to
   the end. A conversation that crosses partitions needs the cost vector at the
   border: each partition sends the products of its first and last conversation,
   and a sweep over them (two rows a partition) gives the vectors.
3. Prefix-doubling path ranking. The nodes ranked are the optimal arcs, one for
   each (row, state, edit) on a cheapest path. Arcs are ranked by the first 1, 2,
   4, ... letters of the audit that they begin, each round from the pairs (rank of
   the arc, rank of the arc its pointer names), and pointers double with the
   ranks. The rank at the start node selects the arc, and the doubled pointers
   list the path. Edits that leave one node have different letters, so equal
   prefixes end at one node and a rank needs one pointer.
4. A path crosses a border in a state: a second sweep carries it from left to
   right, then every partition writes the edits of its rows.

Defined results: null role, text, conv_id or turn counts as one space wherever it
is text; a null conv_id is a conversation of its own, null turns come first; rows
of one turn are ordered by role, then text; a role with another initial than s, u
and a (an empty one too) cannot be kept; a conversation of which nothing is left
has no edits; very long texts are never held by the path search; an empty table
gives no rows; other columns are ignored, so no name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.llm.shared import SPACE_CHARS, materialize

REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
STATES = 4                                  # nothing yet, after s, after u, after a
LETTERS = "DIKR"                            # delete, insert, keep, rerole: in ASCII order
NAMES = {"u": "user", "a": "assistant"}
ROLE = ("", "s", "u", "a")                  # the role initial that leads to a state
_FAR = 1 << 40
_NEXT = np.array([2, 2, 3, 2])              # where a user or assistant turn leads
_KEEP = np.full((STATES, 4), -1)            # by state and initial (s, u, a, other)
_KEEP[0, 0], _KEEP[0, 1], _KEEP[1, 1], _KEEP[2, 2], _KEEP[3, 1] = 1, 2, 2, 3, 2


# --- rows and faults ----------------------------------------------------------

def damage(messages: DataFrame) -> DataFrame:
    """The contract's damage by crc32 of ``conv_id:turn``: rows (conv_id, turn,
    role, text, live); a dropped row stays with ``live`` false, so that its
    conversation is still known."""
    name = F.concat(_text("conv_id"), F.lit(":"), _text("turn"))
    hurt = F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(20))
    text = F.when(hurt == 1, "").when(hurt == 2, F.regexp_replace(_text("text"), "[.!?]", "")).otherwise(_text("text"))
    copies = F.when(hurt == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return messages.select(
        "conv_id", "turn", F.when(hurt == 4, "user").otherwise(_text("role")).alias("role"),
        text.alias("text"), (hurt != 0).alias("live"), F.explode(copies).alias("copy")).drop("copy")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def place(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows (conv_id, turn, role, text, live) in order, written with ``part`` and
    ``pos``: the rows of a part are consecutive, ``pos`` rises over all parts.
    ``parts`` is their number (default: as many as the rows fill)."""
    order = ["conv_id", "turn", "role", "text"]
    rows = messages.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"),
                           F.col("live") if "live" in messages.columns else F.lit(True).alias("live"))
    dealt = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    return materialize(dealt.select("*", F.spark_partition_id().alias("part"),
                                    F.monotonically_increasing_id().alias("pos")), "turns")


def faults(placed: DataFrame) -> DataFrame:
    """(pos, part, conv_id, initial, blank, duplicate, truncated) of the live rows;
    the first fault of a row counts. ``initial`` is 0 for s, 1 for u, 2 for a, else 3."""
    live = placed.filter("live")
    seen = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    first = (live.groupBy("conv_id", seen.alias("seen")).agg(F.min("pos").alias("pos"))
             .select("pos", F.lit(True).alias("first")))
    seen_text = F.rtrim(F.col("text"), F.lit(SPACE_CHARS))
    code = F.instr(F.lit("sua"), F.substring("role", 1, 1)) - 1
    looked = live.select(
        "pos", "part", "conv_id",
        F.when((F.col("role") == "") | (code < 0), 3).otherwise(code).cast("int").alias("initial"),
        (seen_text == "").alias("blank"), (~F.substring(seen_text, -1, 1).isin(".", "!", "?")).alias("open"))
    marked = looked.join(first, "pos", "left")
    duplicate = ~F.col("blank") & F.col("first").isNull()
    return marked.select("pos", "part", "conv_id", "initial", "blank", duplicate.alias("duplicate"),
                         (~F.col("blank") & ~duplicate & F.col("open")).alias("truncated"))


# --- cost DP -------------------------------------------------------------------

def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of matrices (or of matrices and vectors)."""
    if b.ndim == a.ndim:
        return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), _FAR)
    return np.minimum((a + b[..., None, :]).min(-1), _FAR)


def _inserts() -> np.ndarray:
    out = np.full((STATES, STATES), _FAR)
    for q in range(STATES):
        one, two = _NEXT[q], _NEXT[_NEXT[q]]
        out[q, two] = min(out[q, two], 2 * INSERT)
        out[q, one] = min(out[q, one], INSERT)
        out[q, q] = 0
    return out


def _row_matrices() -> np.ndarray:
    """By kind of row (8 * initial + 2 * must go + truncated): inserts, then the row's edit."""
    out = np.full((32, STATES, STATES), _FAR)
    for kind in range(32):
        initial, must_go, late = kind >> 3, kind >> 1 & 1, UNFINISHED * (kind & 1)
        for q in range(STATES):
            out[kind, q, q] = DELETE
            if not must_go:
                out[kind, q, _NEXT[q]] = min(out[kind, q, _NEXT[q]], REROLE + late)
                if (to := _KEEP[q, initial]) >= 0:
                    out[kind, q, to] = min(out[kind, q, to], late)
    return _product(np.broadcast_to(_inserts(), out.shape), out)


_ROWS = _row_matrices()
#: Cost to the end behind the last row: a conversation may end before any turn or after an answer.
END = _product(_inserts(), np.array([0, _FAR, _FAR, 0]))


class Part:
    """The live rows of one partition, in order, cut into runs of one conversation."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches)
        col = lambda c: rows.column(c).to_numpy().astype(np.int64)
        self.pos, self.late = col("pos"), col("truncated")
        self.kind = 8 * col("initial") + 2 * (col("blank") | col("duplicate")) + self.late
        conv = rows.column("conv_id").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
        n = len(conv)
        self.starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        self.sizes = np.diff(np.r_[self.starts, n])
        self.run = np.repeat(np.arange(len(self.starts)), self.sizes)
        left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(n)    # rows to the run's end, itself too
        self.suffix, step = _ROWS[self.kind], 1
        while step < self.sizes.max():
            at = np.flatnonzero(left > step)
            self.suffix[at] = _product(self.suffix[at], self.suffix[at + step])
            step *= 2


class Paths:
    """Optimal arcs of a part and their ranks. The nodes are (place, state); a run
    of n rows has n + 1 places, the last one behind its rows. ``right`` is the cost
    vector behind the last run if its conversation goes on in a later part."""

    def __init__(self, part: Part, right: np.ndarray | None):
        runs, n = len(part.starts), len(part.pos)
        place = np.arange(n) + part.run                       # of each row
        behind = part.starts + part.sizes + np.arange(runs)   # of each run
        ends = np.broadcast_to(END, (runs, STATES)).copy()
        if right is not None:
            ends[-1] = right
        cost = np.empty((n + runs, STATES), np.int64)
        cost[behind] = ends
        cost[place] = _product(part.suffix, ends[part.run])
        self.first = part.starts + np.arange(runs)
        row = np.full(n + runs, -1)
        row[place] = np.arange(n)
        # targets by node and letter, -1 where the edit is impossible or not on a cheapest path
        here = np.arange(n + runs)[:, None] * STATES + np.arange(STATES)
        to = np.full((n + runs, STATES, 4), -1)
        may_insert = np.ones(n + runs, bool)
        if right is not None:
            may_insert[behind[-1]] = False                    # the next partition inserts there
        flat = cost.ravel()
        def lay(letter: int, nodes: np.ndarray, targets: np.ndarray, price: np.ndarray | int, fits: np.ndarray) -> None:
            best = fits & (flat[nodes] < _FAR) & (flat[targets] + price == flat[nodes])
            to.reshape(-1, 4)[nodes[best], letter] = targets[best]
        lay(1, here, here - np.arange(STATES) + _NEXT, INSERT, np.broadcast_to(may_insert[:, None], here.shape))
        mine, after = here[place], here[place] + STATES - np.arange(STATES)
        stays = np.broadcast_to((part.kind >> 1 & 1 == 0)[:, None], mine.shape)
        late = UNFINISHED * part.late[:, None]
        lay(0, mine, after + np.arange(STATES), DELETE, np.ones(mine.shape, bool))
        keep = _KEEP[:, part.kind >> 3].T
        lay(2, mine, after + np.maximum(keep, 0), np.broadcast_to(late, mine.shape), stays & (keep >= 0))
        lay(3, mine, after + _NEXT, np.broadcast_to(late + REROLE, mine.shape), stays)
        self.row, self.part = row, part
        self.node, self.letter = np.nonzero(to.reshape(-1, 4) >= 0)
        self.target = to.reshape(-1, 4)[self.node, self.letter]
        self._rank()

    def _rank(self) -> None:
        """Ranks by audit prefixes of 1, 2, 4, ... letters, and the doubled pointers."""
        none = len(self.node)
        rank = np.r_[self.letter + 1, 0]                      # 0: the audit has ended
        self.begin, self.ends = np.searchsorted(self.node, [np.arange(len(self.row) * STATES),
                                                            np.arange(len(self.row) * STATES) + 1])
        pointer = np.r_[self._least(rank, self.target), none]
        self.pointers = []
        while True:
            self.pointers.append(pointer)
            if (pointer == none).all():
                break
            pair = rank.astype(np.int64) * (none + 5) + rank[pointer]
            rank = np.unique(pair, return_inverse=True)[1]
            pointer = pointer[pointer]
        self.rank = rank

    def _least(self, rank: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """The arc of least rank that leaves each node; one past the arcs where none does."""
        none = len(self.node)
        out = np.full(len(nodes), none)
        for k in range(4):
            at = self.begin[nodes] + k
            arc = np.where(at < self.ends[nodes], at, none)
            better = (arc < none) & ((out == none) | (rank[arc] < rank[out]))
            out = np.where(better, arc, out)
        return out

    def path(self, entry: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(arcs in order, their index in ``runs``) of the least paths from states ``entry``."""
        none = len(self.node)
        arcs = self._least(self.rank, self.first[runs] * STATES + entry)
        owner = np.arange(len(runs))
        arcs, owner = arcs[arcs < none], owner[arcs < none]
        for pointer in reversed(self.pointers):
            arcs, owner = np.column_stack([arcs, pointer[arcs]]).ravel(), np.repeat(owner, 2)
            arcs, owner = arcs[arcs < none], owner[arcs < none]
        return arcs, owner

    def exits(self) -> list[int]:
        """The state behind the last run for each state before it; -1: no path from there."""
        runs = np.full(STATES, len(self.first) - 1)
        arcs, owner = self.path(np.arange(STATES), runs)
        out = np.full(STATES, -1)
        out[owner] = self.target[arcs] % STATES               # the last arc of an owner stays
        return out.tolist()

    def edits(self, entry: int) -> pa.RecordBatch:
        """(pos, audit, roles) of each row: its letters, after those of the turns
        inserted before it (the last row's, also behind), and the initials of the
        turns they give."""
        runs = np.arange(len(self.first))
        states = np.zeros(len(runs), np.int64)
        states[0] = entry
        arcs, owner = self.path(states, runs)
        place = self.node[arcs] // STATES
        behind = self.row[place] < 0
        row = np.where(behind, self.row[place - behind], self.row[place])
        letter, state = self.letter[arcs], self.target[arcs] % STATES
        cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        text = np.frombuffer(LETTERS.encode(), np.uint8)[letter].tobytes().decode()
        given = np.where(letter == 0, 0, state)
        bounds = np.r_[cuts, len(row)].tolist()
        audits = [text[a:b] for a, b in zip(bounds, bounds[1:])]
        marks = given.tolist()
        roles = ["".join([ROLE[s] for s in marks[a:b]]) for a, b in zip(bounds, bounds[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.part.pos[row[cuts]]), pa.array(audits, pa.string()), pa.array(roles, pa.string())],
            names=["pos", "audit", "roles"])


def _by_part(rows: DataFrame, work: Callable[[int, list], pa.RecordBatch], schema: str) -> DataFrame:
    """``work(part, batches)`` on the rows of each part, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            parts = batch.column("part").to_numpy()
            cuts = np.r_[0, np.flatnonzero(parts[1:] != parts[:-1]) + 1, len(parts)].tolist()
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts[a] != now and held:
                    yield work(now, held)
                    held = []
                now = int(parts[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield work(now, held)
    return rows.repartition("part").sortWithinPartitions("part", "pos").mapInArrow(run, schema)


# --- borders between partitions --------------------------------------------------

def _borders(rows: DataFrame) -> list:
    """A record for each part, in order: its first and last conversation, whether
    they are one (``single``), and whether the last goes on in the next part."""
    def at(which: Callable) -> Column:
        return which(F.struct("pos", "conv_id"))["conv_id"]
    ends = rows.groupBy("part").agg(at(F.min).alias("first"), at(F.max).alias("last")).orderBy("part").collect()
    later = [*ends[1:], None]
    return [{"part": r["part"], "last": r["last"], "single": r["first"] == r["last"],
             "goes_on": n is not None and n["first"] == r["last"]} for r, n in zip(ends, later)]


def _sweep_costs(borders: list, products: dict) -> dict[int, np.ndarray]:
    """Costs behind the last run of each part whose conversation goes on."""
    right: dict[int, np.ndarray] = {}
    for now, later in reversed(list(zip(borders, borders[1:]))):
        if now["goes_on"]:
            behind = right.get(later["part"], END) if later["single"] else END
            right[now["part"]] = _product(np.array(products[later["part"]]).reshape(STATES, STATES), behind)
    return right


def _sweep_states(borders: list, exits: dict) -> dict[int, int]:
    """The state in which each part's first run is entered, where not 0."""
    entry: dict[int, int] = {}
    for now, later in zip(borders, borders[1:]):
        if now["goes_on"]:
            before = entry.get(now["part"], 0) if now["single"] else 0
            entry[later["part"]] = exits[now["part"]][before]
    return entry


def find_edits(rows: DataFrame) -> DataFrame:
    """(pos, audit, roles) of the rows of ``faults``. What meets on the driver, and
    goes back to the tasks, is one matrix and two states for each partition."""
    spark, borders = rows.sparkSession, _borders(rows)
    right: dict[int, np.ndarray] = {}
    entry: dict[int, int] = {}
    if crossing := [(b["last"],) for b in borders if b["goes_on"]]:
        named = spark.createDataFrame(crossing, T.StructType([T.StructField("_id", rows.schema["conv_id"].dataType)]))
        split = rows.join(F.broadcast(named), F.col("conv_id").eqNullSafe(F.col("_id")), "left_semi")

        def product(part: int, batches: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                               "first": [Part(batches).suffix[0].ravel().tolist()]})
        products = {r["part"]: r["first"] for r in _by_part(split, product, "part int, first array<long>").collect()}
        right = _sweep_costs(borders, products)

        def leave(part: int, batches: list) -> pa.RecordBatch:
            to = Paths(Part(batches), right[part]).exits() if part in right else []
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                               "exits": pa.array([to], pa.list_(pa.int64()))})
        exits = {r["part"]: r["exits"] for r in _by_part(split, leave, "part int, exits array<long>").collect()}
        entry = _sweep_states(borders, exits)
    known = spark.sparkContext.broadcast((right, entry))

    def edit(part: int, batches: list) -> pa.RecordBatch:
        behind, states = known.value
        return Paths(Part(batches), behind.get(part)).edits(states.get(part, 0))
    return _by_part(rows, edit, "pos long, audit string, roles string")


# --- results ---------------------------------------------------------------------

def repair(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """Each row of ``messages`` (conv_id, turn, role, text and, where false stands
    for a row known to be lost, live) with its faults, ``audit`` (letters of the
    edits, inserts before the row first) and ``turns``: the repaired turns that
    stand in its place, each with role and text, in order."""
    placed = place(messages, parts)
    marked = materialize(faults(placed), "faults")
    edits = materialize(find_edits(marked), "edits")
    own = F.regexp_replace("audit", "D", "")                # letters that give a turn, one for each initial
    i = F.sequence(F.lit(1), F.char_length("roles"))
    turn = lambda k: F.struct(
        F.when(F.substr(own, k, F.lit(1)) == "K", F.col("role"))
        .when(F.substr("roles", k, F.lit(1)) == "u", NAMES["u"]).otherwise(NAMES["a"]).alias("role"),
        F.when(F.substr(own, k, F.lit(1)) == "I", "").otherwise(F.col("text")).alias("text"))
    turns = F.when(F.char_length("roles") > 0, F.transform(i, turn))
    return (placed.join(marked.drop("part", "conv_id"), "pos", "left").join(edits, "pos", "left")
            .select("conv_id", "turn", "pos", "live", "initial", "blank", "duplicate", "truncated", "audit",
                    F.coalesce(turns, F.array().cast("array<struct<role:string,text:string>>")).alias("turns")))


_DIGEST = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def digest(repaired: DataFrame) -> DataFrame:
    """The contract's row of each conversation. The hash and the audit are strings
    of a whole conversation, so its rows pass one task, in order and one at a time;
    only the audit's letters are kept."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    price = dict(zip(LETTERS, (DELETE, INSERT, 0, REROLE)))
    legal = {(0, 1), (1, 2), (2, 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, state, now = [], None, None

        def close() -> None:
            lo, hi, distinct = state["turns"]
            done.append((now, hi - lo + 1 - distinct if distinct else 0, state["blank"], state["duplicate"],
                         state["truncated"], state["illegal"], state["cost"], "".join(state["audit"]),
                         state["sha"].hexdigest()))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[] for _ in target]
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, target)], schema=target)

        for batch in batches:
            if state is None:
                target = pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type)] + [
                    pa.field(f.split()[0], pa.string() if f.endswith("string") else pa.int64())
                    for f in _DIGEST.split(", ")])
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != now:
                    if state is not None:
                        close()
                    now, state = r["conv_id"], {
                        "turns": (0, 0, 0), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0,
                        "audit": [], "sha": hashlib.sha256(), "last": None, "line": b""}
                if not r["live"]:
                    continue
                if (t := r["turn"]) is not None:
                    lo, hi, distinct = state["turns"]
                    state["turns"] = (lo, t, distinct + (t != hi)) if distinct else (t, t, 1)
                for fault in ("blank", "duplicate", "truncated"):
                    state[fault] += r[fault]
                if state["last"] is not None:
                    state["illegal"] += (state["last"], r["initial"]) not in legal
                state["last"] = r["initial"]
                kept = r["truncated"] and "D" not in r["audit"]
                state["cost"] += sum(price[x] for x in r["audit"]) + UNFINISHED * kept
                state["audit"].append(r["audit"])
                for turn in r["turns"]:
                    state["sha"].update(state["line"] + f"{turn['role']}:{turn['text']}".encode())
                    state["line"] = b"\n"
            if len(done) >= 4096:
                yield flush()
                done.clear()
        if state is not None:
            close()
            yield flush()

    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return rows.mapInArrow(run, f"conv_id {kind}, {_DIGEST}")

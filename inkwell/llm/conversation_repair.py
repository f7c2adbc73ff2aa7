"""Repair of conversation structure at the least cost.

The roles of a conversation should read: a system message or none, then user
and assistant in turn, the assistant last; or nothing at all.  Edits in order
give such a sequence: Keep a message (0), Rerole it to user or assistant (2),
Delete it (3; blank and repeated messages must go), Insert an empty message of
a user or assistant anywhere (2); a truncated message that stays costs 1.

Cost: a message is a min-plus matrix over the four states of the sequence, and
doubled products of them give the cheapest cost from every (message, state)
node to the end.

Audit: of the cheapest edit sequences, the one whose initials are least.  Arcs
that keep the cheapest cost are optimal.  Nodes are ranked by the least audit
of 1, 2, 4, ... letters from them: the rank for twice the letters is the rank of
(own rank, rank of the node that the doubled pointer leads to).  Every node
then takes its optimal arc of the least (initial, rank of its end), and doubled
pointers list the nodes of the path.  An initial fixes the next state, so from
one node two arcs never start with the same letter.

Rows are range-sorted by conversation once, texts with them.  A conversation
that lies inside one partition and has at most ``BLOCK`` rows is solved there.
The others, whatever their size (one may hold most rows), are cut into blocks
of ``BLOCK`` rows: matrices of blocks are combined over groups of blocks
(``scan``) into the cost to the end behind every block, each block is solved for
all four states before it, and a second scan of where those lead gives the
state that counts.  Only the digest of a repaired conversation is sequential by
its definition: one task reads its text, a block at a time.

Defined results: a null role or text is one space; null turns come first; rows
of one turn are ordered by role, then by the first 64 characters of the text
and its digest; a null conv_id is a conversation of its own; repeated rows each
count; one without rows (``present`` false for all of them) has zeros, an empty
audit and the digest of the empty string; an empty table gives no rows.  Only
the named columns are read, so extra columns never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import crc32_sql, crc32_table, map_arrow, written
from inkwell.session import ship_package

#: Rows of a block; blocks that one step of a scan combines (a power of two).
BLOCK, SCAN_BITS = 1024, 8

#: States: nothing yet, after the system message, after a user, after an assistant.
STATES, START = 4, 0
SYSTEM, USER, ASSISTANT, OTHER = range(4)
#: State after a role, -1 where it cannot follow; state after the role that must follow.
AFTER = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
NEXT = np.array([2, 2, 3, 2])
NAMES = {2: "user", 3: "assistant"}
MAY_END = np.array([True, False, False, True])
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: The initials in ASCII order.
INITIALS = b"DIKR"
FAR = 1 << 60

RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
_ROW = ("part bigint, at bigint, turn bigint, role string, text string, present boolean, code int, empty boolean, "
        "unended boolean, digest string")


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of the last two axes."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), FAR)


def _identity() -> np.ndarray:
    return np.where(np.eye(STATES, dtype=bool), 0, FAR).astype(np.int64)


def _inserts() -> np.ndarray:
    one = _identity()
    one[np.arange(STATES), NEXT] = INSERT
    return times(times(one, one), one)


def _message(code: int, forced: bool, late: bool) -> np.ndarray:
    """Inserts, then one edit of a message."""
    edit = np.where(np.eye(STATES, dtype=bool), DELETE, FAR).astype(np.int64)
    if not forced:
        for state in range(STATES):
            edit[state, NEXT[state]] = min(edit[state, NEXT[state]], REROLE + late * TRUNCATED)
            if AFTER[state, code] >= 0:
                edit[state, AFTER[state, code]] = min(edit[state, AFTER[state, code]], KEEP + late * TRUNCATED)
    return times(_inserts(), edit)


MESSAGES = np.array([[[_message(code, forced, late) for late in (False, True)] for forced in (False, True)] for code in range(4)])
#: Cost from each state behind the last message.
AT_END = np.where(MAY_END, _inserts(), FAR).min(axis=1)


def suffix_products(own: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Product of each row's matrix with all behind it in its segment, by doubling."""
    n = len(own)
    stop = np.repeat(begins[1:], np.diff(begins))
    out, span, longest = own.copy(), 1, int(np.diff(begins).max(initial=0))
    while span < longest:
        more = np.flatnonzero(np.arange(n) + span < stop)
        out[more] = times(out[more], out[more + span])
        span *= 2
    return out


class Plan:
    """Cheapest edits of segments of messages (``begins``, one more than
    segments), with the cost from each state behind each segment; ``final``:
    whether nothing follows it.  Node: boundary * STATES + state; a segment has
    one boundary more than messages."""

    def __init__(self, code: np.ndarray, forced: np.ndarray, late: np.ndarray, begins: np.ndarray, behind: np.ndarray, final: np.ndarray):
        n, m = len(code), len(begins) - 1
        self.segment = np.repeat(np.arange(m), np.diff(begins))
        self.starts = begins[:-1] + np.arange(m)
        self.ends = begins[1:] + np.arange(m)
        at = np.arange(n) + self.segment
        self.row_of = np.full(n + m, -1)
        self.row_of[at] = np.arange(n)
        to_go = np.empty((n + m, STATES), np.int64)
        to_go[self.ends] = behind
        products = suffix_products(MESSAGES[code, forced.astype(int), late.astype(int)], begins)
        to_go[at] = (products + behind[self.segment][:, None, :]).min(axis=2)
        self.to_go = to_go

        target = np.full((n + m, STATES, 4), -1)
        cost = np.full((n + m, STATES, 4), FAR)
        boundary, state = np.arange(n + m)[:, None], np.arange(STATES)[None, :]
        target[at, :, 0] = (at + 1)[:, None] * STATES + state
        cost[at, :, 0] = DELETE
        target[:, :, 1] = boundary * STATES + NEXT
        cost[:, :, 1] = INSERT
        free = at[~forced]
        late_cost = (late[~forced] * TRUNCATED)[:, None]
        kept = AFTER[:, code[~forced]].T
        target[free, :, 2] = np.where(kept >= 0, (free + 1)[:, None] * STATES + kept, -1)
        cost[free, :, 2] = KEEP + late_cost
        target[free, :, 3] = (free + 1)[:, None] * STATES + NEXT
        cost[free, :, 3] = REROLE + late_cost
        flat = to_go.ravel()
        optimal = (target >= 0) & (cost + flat[np.maximum(target, 0)] == to_go[:, :, None])
        done = np.zeros((n + m, STATES), bool)
        done[self.ends[final]] = to_go[self.ends[final]] == 0
        done[self.ends[~final]] = True
        self.done = done.ravel()
        self.target = target.reshape(-1, 4)
        self.optimal = optimal.reshape(-1, 4) & ~self.done[:, None]
        self._rank()

    def _rank(self) -> None:
        """Ranks by doubling, the chosen arcs, and pointers to 1, 2, 4, ... edits further."""
        nodes = np.arange(len(self.done))
        least = np.where(self.done, -1, self.optimal.argmax(axis=1))
        rank, pointer = least + 1, np.where(self.done, nodes, self.target[nodes, least])
        while not self.done[pointer].all():
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
            pointer = pointer[pointer]
        self.rank = rank
        order = np.arange(4) * (int(rank.max(initial=0)) + 1) + rank[np.maximum(self.target, 0)]
        self.edit = np.where(self.optimal, order, np.iinfo(np.int64).max).argmin(axis=1)
        step = np.where(self.done, nodes, self.target[nodes, self.edit])
        self.jumps = [step]
        while not self.done[self.jumps[-1]].all():
            self.jumps.append(self.jumps[-1][self.jumps[-1]])

    def paths(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the paths from ``nodes``, one path behind the other, and
        where each path ends in them."""
        which, offset, node = np.arange(len(nodes)), np.zeros(len(nodes), np.int64), nodes
        keep = ~self.done[node]
        which, offset, node = which[keep], offset[keep], node[keep]
        for k in range(len(self.jumps) - 1, -1, -1):
            further = self.jumps[k][node]
            keep = ~self.done[further]
            which, offset, node = (np.concatenate([which, which[keep]]), np.concatenate([offset, offset[keep] + (1 << k)]),
                                   np.concatenate([node, further[keep]]))
        order = np.lexsort((offset, which))
        return node[order], np.cumsum(np.bincount(which, minlength=len(nodes)))

    def last(self, nodes: np.ndarray) -> np.ndarray:
        """Where the paths from ``nodes`` end."""
        return self.jumps[-1][nodes]

    def audit(self, path: np.ndarray) -> str:
        return np.frombuffer(INITIALS, np.uint8)[self.edit[path]].tobytes().decode()


def messages(edits: str, states: list[int], roles: list[str], texts: list[str]) -> Iterator[str]:
    """The repaired ``role:text`` of edits, with the state before each."""
    k = 0
    for edit, state in zip(edits, states):
        if edit == "I":
            yield f"{NAMES[NEXT[state]]}:"
            continue
        if edit != "D":
            yield f"{roles[k] if edit == 'K' else NAMES[NEXT[state]]}:{texts[k]}"
        k += 1


def states_of(edits: str, codes: list[int], state: int = START) -> list[int]:
    """The state before each edit."""
    out, k = [], 0
    for edit in edits:
        out.append(state)
        if edit in "IR":
            state = int(NEXT[state])
        elif edit == "K":
            state = int(AFTER[state, codes[k]])
        k += edit != "I"
    return out


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, present) with faults by the CRC-32 of
    ``conv_id:turn`` modulo 20: 0 drops the row (``present`` false), 1 empties
    its text, 2 takes its end marks, 3 repeats it, 4 sets its role to user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col(text_col), space)
    return conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(F.coalesce(F.col(role_col), space)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault != 0).alias("present"), F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def described(rows: DataFrame) -> DataFrame:
    """What the plan needs to know of each row, beside it."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("key"), "conv_id", "turn",
                       role.alias("role"), text.alias("text"), "present")
    initial = F.left("role", F.lit(1))
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    return rows.select("*", code.alias("code"), (bare == "").alias("empty"),
                       (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("unended"), same.alias("digest"))


def in_order(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.left("text", F.lit(64)), F.col("digest")]
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (spread.repartitionByRange(parts, *order, F.col("spread")).sortWithinPartitions(*order, F.col("spread"))
            .select("key", "conv_id", "turn", "role", "text", "present", "code", "empty", "unended", "digest"))


def faults(code: np.ndarray, empty: np.ndarray, unended: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First fault of each row: blank, duplicate, truncated."""
    duplicate = again & ~empty
    return empty, duplicate, unended & ~empty & ~duplicate


def legal(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return ((first == SYSTEM) & (second == USER)) | ((first == USER) & (second == ASSISTANT)) | ((first == ASSISTANT) & (second == USER))


def illegal_pairs(code: np.ndarray, segment: np.ndarray, n: int) -> np.ndarray:
    wrong = (segment[1:] == segment[:-1]) & ~legal(code[:-1], code[1:])
    return np.bincount(segment[1:][wrong], minlength=n)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def starts_of_runs(names: pa.ChunkedArray) -> np.ndarray:
    if len(names) == 0:
        return np.zeros(0, np.int64)
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    return np.concatenate([[0], np.flatnonzero(pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)) + 1])


def solved(table: pa.Table) -> pa.Table:
    """Results of whole conversations, their rows one behind the other."""
    starts = starts_of_runs(table.column("key"))
    m = len(starts)
    owner = np.repeat(np.arange(m), np.diff(np.append(starts, table.num_rows)))
    present = _column(table, "present").astype(bool)
    conv = table.column("conv_id").take(pa.array(starts))
    table, owner = table.filter(pa.array(present)), owner[present]
    n = table.num_rows
    code, empty, unended = (_column(table, c).astype(t) for c, t in (("code", np.int64), ("empty", bool), ("unended", bool)))
    same = table.column("digest").combine_chunks().dictionary_encode()
    same = (same.chunk(0) if isinstance(same, pa.ChunkedArray) else same).indices.to_numpy().astype(np.int64) if n else np.zeros(0, np.int64)
    again = np.ones(n, bool)
    again[np.unique(owner * (n + 1) + same, return_index=True)[1]] = False
    blank, duplicate, late = faults(code, empty, unended, again)
    begins = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=m))])
    plan = Plan(code, blank | duplicate, late, begins, np.tile(AT_END, (m, 1)), np.ones(m, bool))
    nodes, ends = plan.paths(plan.starts * STATES + START)
    roles, texts = table.column("role").to_pylist(), table.column("text").to_pylist()
    audits, digests = [], []
    for k, (a, b) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)):
        audits.append(plan.audit(nodes[a:b]))
        lo, hi = begins[k], begins[k + 1]
        said = "\n".join(messages(audits[-1], (nodes[a:b] % STATES).tolist(), roles[lo:hi], texts[lo:hi]))
        digests.append(hashlib.sha256(said.encode()).hexdigest())
    return pa.table({
        "conv_id": conv, "gaps": gaps(table.column("turn"), owner, m), "blank": np.bincount(owner[blank], minlength=m),
        "duplicate": np.bincount(owner[duplicate], minlength=m), "truncated": np.bincount(owner[late], minlength=m),
        "illegal": illegal_pairs(code, owner, m), "cost": plan.to_go[plan.starts, START], "audit": pa.array(audits, pa.string()),
        "repaired_sha256": pa.array(digests, pa.string())})


def gaps(turn: pa.ChunkedArray, owner: np.ndarray, n: int) -> np.ndarray:
    """Turns missing between the first and the last of each conversation."""
    known = pc.is_valid(turn).to_numpy()
    turn, owner = pc.fill_null(turn, 0).to_numpy()[known], owner[known]
    new = np.ones(len(turn), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (turn[1:] != turn[:-1])
    out = np.zeros(n, np.int64)
    if len(turn):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        last = np.append(first[1:], len(turn)) - 1
        out[owner[first]] = turn[last] - turn[first] + 1 - np.bincount(owner[new], minlength=n)[owner[first]]
    return out


def solve_inside(rows: DataFrame) -> DataFrame:
    """(key, conv_id, done, row) of rows in order: ``done``, the result of a
    conversation that lies inside its partition and has at most ``BLOCK`` rows;
    or ``row``, a row of another one."""
    done_type, row_type = RESULT.split(", ", 1)[1], _ROW
    schema = f"key string, conv_id bigint, done struct<{done_type.replace(' ', ':').replace(',:', ',')}>, row struct<{row_type.replace(' ', ':').replace(',:', ',')}>"
    done_names = [x.split()[0] for x in done_type.split(", ")]
    row_names = [x.split()[0] for x in row_type.split(", ")]
    done_arrow = pa.struct([(c, pa.string() if c in ("audit", "repaired_sha256") else pa.int64()) for c in done_names])
    row_arrow = pa.struct([("part", pa.int64()), ("at", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                           ("present", pa.bool_()), ("code", pa.int32()), ("empty", pa.bool_()), ("unended", pa.bool_()), ("digest", pa.string())])
    block = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sent, across, left = TaskContext.get().partitionId(), 0, None, None

        def rows_out(t: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal sent
            for b in t.combine_chunks().to_batches():
                own = {"part": pa.array(np.full(b.num_rows, part)), "at": pa.array(np.arange(sent, sent + b.num_rows))}
                sent += b.num_rows
                fields = [own.get(c, None) if c in own else b.column(c) for c in row_names]
                cells = pa.StructArray.from_arrays([f.cast(row_arrow.field(c).type) for f, c in zip(fields, row_names)], fields=list(row_arrow))
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("conv_id"), pa.nulls(b.num_rows, done_arrow), cells],
                                                 names=["key", "conv_id", "done", "row"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([left, t]) if left is not None else t
            left = None
            if across is None:
                across = t.column("key")[0].as_py()
            starts = starts_of_runs(t.column("key"))
            if t.column("key")[0].as_py() == across:
                stop = int(starts[1]) if len(starts) > 1 else t.num_rows
                yield from rows_out(t.slice(0, stop))
                t, starts = t.slice(stop), starts[1:] - stop
            if not len(starts):
                continue
            last = int(starts[-1])
            if last:
                # an outlier of many rows in one batch goes on in blocks like any other
                sizes = np.diff(starts)
                large = np.repeat(sizes > block, sizes)
                inside = t.slice(0, last)
                if large.any():
                    yield from rows_out(inside.filter(pa.array(large)))
                    inside = inside.filter(pa.array(~large))
                if inside.num_rows:
                    found = solved(inside)
                    keys = inside.column("key").combine_chunks().take(pa.array(starts_of_runs(inside.column("key"))))
                    cells = pa.StructArray.from_arrays([found.column(c).combine_chunks().cast(done_arrow.field(c).type) for c in done_names],
                                                       fields=list(done_arrow))
                    yield pa.RecordBatch.from_arrays([keys, found.column("conv_id").combine_chunks(), cells, pa.nulls(len(cells), row_arrow)],
                                                     names=["key", "conv_id", "done", "row"])
            left = t.slice(last).combine_chunks()
            if left.num_rows > block:
                across = left.column("key")[0].as_py()
                yield from rows_out(left)
                left = None
        if left is not None:
            yield from rows_out(left)

    return map_arrow(rows, run, schema)


def scan(parts: DataFrame, backwards: bool) -> DataFrame:
    """(key, block, matrix) of ``parts(key, block, matrix)``: the min-plus
    product of the matrices of the key's other blocks before it (backwards:
    behind it), over groups of blocks and groups of groups."""
    widest = parts.groupBy("key").agg((F.max("block") - F.min("block")).alias("w")).agg(F.max("w")).first()[0] or 0
    if widest == 0:
        return parts.select("key", "block", F.array(*[F.lit(int(x)).cast("bigint") for x in _identity().ravel()]).alias("matrix"))
    schema = "key string, block bigint, matrix array<bigint>"
    grouped = parts.withColumn("above", F.shiftright("block", SCAN_BITS))

    def matrices(t: pa.Table) -> list[np.ndarray]:
        t = t.sort_by("block")
        return [np.array(x, np.int64).reshape(STATES, STATES) for x in t.column("matrix").to_pylist()]

    def product(key: tuple, t: pa.Table) -> pa.Table:
        whole = _identity()
        for x in matrices(t):
            whole = times(whole, x)
        return pa.table({"key": pa.array([key[0].as_py()]), "block": pa.array([key[1].as_py()]), "matrix": pa.array([whole.ravel().tolist()], pa.list_(pa.int64()))})

    above = scan(written(grouped.groupBy("key", "above").applyInArrow(product, schema), "scan-groups"), backwards)

    def within(key: tuple, t: pa.Table, outside: pa.Table) -> pa.Table:
        whole, out = matrices(outside)[0], []
        own = matrices(t)
        for x in reversed(own) if backwards else own:
            out.append(whole.ravel().tolist())
            whole = times(x, whole) if backwards else times(whole, x)
        blocks = t.sort_by("block").column("block")
        return pa.table({"key": pa.array([key[0].as_py()] * len(out)), "block": blocks,
                         "matrix": pa.array(out[::-1] if backwards else out, pa.list_(pa.int64()))})

    return (grouped.groupBy("key", "above")
            .cogroup(above.withColumn("above", F.col("block")).groupBy("key", "above")).applyInArrow(within, schema))


def solve_across(rows: DataFrame) -> DataFrame:
    """Results of conversations of any size from ``rows(key, conv_id, part, at, ...)``."""
    spark = rows.sparkSession
    ship_package(spark)
    names = rows.groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    here = rows.filter("present")
    sizes, total, bases = sorted(tuple(r) for r in rows.groupBy("part").agg(F.max("at") + 1).collect()), 0, []
    for part, n in sizes:
        bases.append((part, total))
        total += n
    base = F.broadcast(spark.createDataFrame(bases, "part bigint, base bigint"))
    block_bits = BLOCK.bit_length() - 1
    here = here.join(base, "part").withColumn("place", F.col("base") + F.col("at")).withColumn("block", F.shiftright("place", block_bits))
    first = here.groupBy("key", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    marks = written(here.select("key", "block", "place", "code", "empty", "unended").join(first, "place", "left")
                    .withColumn("again", F.col("first").isNull()).drop("first"), "repair-marks")

    def segments(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, tuple]:
        t = t.sort_by("place")
        starts = starts_of_runs(t.column("key"))
        begins = np.append(starts, t.num_rows)
        code = _column(t, "code").astype(np.int64)
        found = faults(code, *(_column(t, c).astype(bool) for c in ("empty", "unended", "again")))
        return t, begins, code, found

    def summary(key: tuple, t: pa.Table) -> pa.Table:
        t, begins, code, (blank, duplicate, late) = segments(t)
        m = len(begins) - 1
        owner = np.repeat(np.arange(m), np.diff(begins))
        forced = blank | duplicate
        product = suffix_products(MESSAGES[code, forced.astype(int), late.astype(int)], begins)[begins[:-1]]
        return pa.table({
            "key": t.column("key").take(pa.array(begins[:-1])), "block": np.full(m, key[0].as_py()),
            "matrix": pa.array(product.reshape(m, -1).tolist(), pa.list_(pa.int64())), "first": code[begins[:-1]], "last": code[begins[1:] - 1],
            "blank": np.bincount(owner[blank], minlength=m), "duplicate": np.bincount(owner[duplicate], minlength=m),
            "truncated": np.bincount(owner[late], minlength=m), "illegal": illegal_pairs(code, owner, m)})

    parts = written(marks.groupBy("block").applyInArrow(
        summary, "key string, block bigint, matrix array<bigint>, first bigint, last bigint, blank bigint, duplicate bigint, "
                 "truncated bigint, illegal bigint"), "repair-blocks")
    behind = scan(parts.select("key", "block", "matrix"), True)
    last_block = parts.groupBy("key").agg(F.max("block").alias("last_block"))
    behind = written(behind.join(last_block, "key").select("key", "block", "matrix", (F.col("block") == F.col("last_block")).alias("final")), "repair-behind")

    def planned(key: tuple, t: pa.Table, outside: pa.Table) -> pa.Table:
        t, begins, code, (blank, duplicate, late) = segments(t)
        m = len(begins) - 1
        own = t.column("key").take(pa.array(begins[:-1])).to_pylist()
        known = {r["key"]: r for r in outside.to_pylist()}
        matrix = np.array([known[k]["matrix"] for k in own], np.int64).reshape(m, STATES, STATES)
        plan = Plan(code, blank | duplicate, late, begins, (matrix + AT_END).min(axis=2), np.array([known[k]["final"] for k in own]))
        entries = (plan.starts[:, None] * STATES + np.arange(STATES)).ravel()
        nodes, ends = plan.paths(entries)
        audits = [plan.audit(nodes[a:b]) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
        moves = np.full((m * STATES, STATES), FAR)
        moves[np.arange(m * STATES), plan.last(entries) % STATES] = 0
        return pa.table({"key": pa.array(own), "block": np.full(m, key[0].as_py()), "matrix": pa.array(moves.reshape(m, -1).tolist(), pa.list_(pa.int64())),
                         "audits": pa.array([audits[k:k + STATES] for k in range(0, len(audits), STATES)], pa.list_(pa.string())),
                         "cost": plan.to_go[plan.starts, START]})

    plans = written(marks.groupBy("block").cogroup(behind.groupBy("block")).applyInArrow(
        planned, "key string, block bigint, matrix array<bigint>, audits array<string>, cost bigint"), "repair-plans")
    entry = scan(plans.select("key", "block", "matrix"), False)
    state = F.array_position(F.slice("outside", 1, STATES), F.lit(0).cast("bigint")).cast("int") - 1
    chosen = written(plans.join(entry.withColumnRenamed("matrix", "outside"), ["key", "block"])
                     .withColumn("state", state).select("key", "block", "state", F.get("audits", F.col("state")).alias("audit"), "cost"), "repair-audits")

    def said(key: tuple, t: pa.Table, edits: pa.Table) -> pa.Table:
        t = t.sort_by("place")
        starts = starts_of_runs(t.column("key"))
        known = {r["key"]: r for r in edits.to_pylist()}
        own, out = [], []
        for a, b in zip(starts, np.append(starts[1:], t.num_rows)):
            part = t.slice(a, b - a)
            own.append(part.column("key")[0].as_py())
            r = known[own[-1]]
            states = states_of(r["audit"], part.column("code").to_pylist(), r["state"])
            out.append("\n".join(messages(r["audit"], states, part.column("role").to_pylist(), part.column("text").to_pylist())))
        return pa.table({"key": pa.array(own, pa.string()), "block": np.full(len(own), key[0].as_py()), "said": pa.array(out, pa.string())})

    pieces = (here.select("key", "block", "place", "code", "role", "text").groupBy("block")
              .cogroup(chosen.groupBy("block")).applyInArrow(said, "key string, block bigint, said string"))
    digests = digests_of(pieces)

    before = parts.select("key", (F.col("block") + 1).alias("block"), F.col("last").alias("before"))
    follows = F.concat("before", "first").isin(f"{SYSTEM}{USER}", f"{USER}{ASSISTANT}", f"{ASSISTANT}{USER}")
    edge = F.when(F.col("before").isNotNull() & ~follows, 1).otherwise(0)
    counts = (parts.join(before, ["key", "block"], "left").groupBy("key")
              .agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + edge).alias("illegal")))
    audits = chosen.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"),
                                       F.min_by("cost", "block").alias("cost"))
    turns = (here.filter("turn is not null").groupBy("key", "turn").agg(F.lit(1).alias("one")).groupBy("key")
             .agg((F.max("turn") - F.min("turn") + 1 - F.count("one")).alias("gaps")))
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (names.join(turns, "key", "left").join(counts, "key", "left").join(audits, "key", "left").join(digests, "key", "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in zero], F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")))


def digests_of(pieces: DataFrame) -> DataFrame:
    """(key, repaired_sha256): SHA-256 of the pieces of a key in block order,
    joined by newlines; empty pieces hold no message."""
    ordered = pieces.filter("said <> ''").repartition("key").sortWithinPartitions("key", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([sha.hexdigest()], pa.string())], names=["key", "repaired_sha256"])

        for b in batches:
            for name, said in zip(b.column("key"), b.column("said")):
                name = name.as_py()
                if name != key:
                    if sha is not None:
                        yield out()
                    key, sha = name, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(said.as_buffer())
        if sha is not None:
            yield out()

    return map_arrow(ordered.select("key", "said"), run, "key string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text, present)``:
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    found = written(solve_inside(in_order(described(rows))), "repair")
    inside = found.filter("done is not null").select("conv_id", "done.*")
    others = found.filter("row is not null").select("key", "conv_id", "row.*")
    if others.isEmpty():
        return inside
    return inside.unionByName(solve_across(others))


def oracle() -> str:
    """DuckDB text of the query: the least (cost, audit) of every state, message by message."""
    def via(state: str, cost: str, letter: str, said: str) -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {said}}} END"

    def least(*states: str) -> str:
        return f"least({', '.join(states)})"

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    user_next = ("s0", "s1", "s3")
    kept = "chr(10) || role || ':' || text"

    def kept_as(code: str, *states: str) -> list[str]:
        return [f"CASE WHEN code = '{code}' AND NOT forced THEN {via(s, 'late', 'K', kept)} END" for s in states]

    def reroled(said: str, *states: str) -> list[str]:
        return [f"CASE WHEN NOT forced THEN {via(s, f'{REROLE} + late', 'R', f'{said} || text')} END" for s in states]

    dropped = [via(f"s{k}", str(DELETE), "D", "''") for k in range(STATES)]
    steps = [dropped[0], least(dropped[1], *kept_as("s", "s0")),
             least(dropped[2], *kept_as("u", *user_next), *reroled(user, *user_next)),
             least(dropped[3], *kept_as("a", "s2"), *reroled(assistant, "s2"))]

    def closed(source: str) -> str:
        inserted = least("s2", *[via(s, str(INSERT), "I", user) for s in user_next])
        return (f"SELECT conv, k, s0, s1, s2, {least('s3', via('s2', str(INSERT), 'I', assistant))} AS s3 "
                f"FROM (SELECT conv, k, s0, s1, {inserted} AS s2, s3 FROM ({source}))")

    def name(c: str) -> str:
        return f"coalesce({c}::varchar, ' ')"

    none = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    return f"""
WITH RECURSIVE {crc32_table()},
given AS (SELECT name AS conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("name || ':' || " + name("turn"))} % 20 AS fault
          FROM (SELECT *, {name("conv_id")} AS name FROM conversations), crc),
damaged AS (SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
            FROM given WHERE fault <> 0),
described AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
                     row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text[:64], sha256(length(role)::varchar || ':' || role || text)) AS k
              FROM damaged),
marked AS (SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 AS duplicate,
                  lag(role[1:1]) OVER (PARTITION BY conv ORDER BY k) AS before FROM described),
messages AS (SELECT *, blank OR duplicate AS forced, (NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?'))::bigint AS late,
                    role[1:1] AS code, (before IS NOT NULL AND before || role[1:1] NOT IN ('su', 'ua', 'au'))::bigint AS wrong FROM marked),
plan AS (
  {closed(f"SELECT DISTINCT conv, 0 AS k, {{'c': 0::bigint, 'a': '', 't': ''}} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM given")}
  UNION ALL
  {closed(f"SELECT conv, m.k, {', '.join(f'{x} AS s{k}' for k, x in enumerate(steps))} FROM plan JOIN messages m USING (conv) WHERE m.k = plan.k + 1")}),
best AS (SELECT conv, least(arg_max(s0, k), arg_max(s3, k)) AS b FROM plan GROUP BY conv),
counts AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::bigint) AS blank, sum(duplicate::bigint) AS duplicate,
                  sum(late) AS truncated, sum(wrong) AS illegal FROM messages GROUP BY conv)
SELECT g.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank, coalesce(duplicate, 0)::bigint AS duplicate,
       coalesce(truncated, 0)::bigint AS truncated, coalesce(illegal, 0)::bigint AS illegal, b.c::bigint AS cost, b.a AS audit, sha256(b.t[2:]) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM given) g JOIN best USING (conv) LEFT JOIN counts USING (conv)"""

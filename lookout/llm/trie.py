"""The prefix trie of conversations, by a sort of their turn arrays.

Method: conversations are sorted globally, by range, as arrays of turn hashes.  Then the nodes of the trie are the prefixes that neighbours share:
a task sweeps its sorted rows with a stack that holds the path of the last row, opens nodes below the longest common prefix (LCP) of
two neighbours, and closes those above the next LCP, when all that is in them has been seen.  Nodes on the path of a task's first or last row may
go on in another task: of those only what the task itself has seen is put out, and one small task stitches the paths together in order
of the tasks.  It reads two paths a task, whatever the corpus.

A turn is 16 bytes of the sha256 of its role and text, and the number of code points of its text in 4 bytes, so texts are shuffled by no one.
A conversation is one row, of 20 bytes a turn, which must fit a task.  Copies of one conversation, however many, are spread over tasks by their id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookout.llm.common import materialise, prepare, tidy

#: Bytes of a turn in a key; those of its hash.
TURN, HASH = 20, 16
#: Closed nodes that a task holds back until their parent is closed too, and characters of the ids that it holds of a node's ends.
HELD, CHUNK = 50_000, 1 << 16
#: Rows of a lookup table of parents up to which it is broadcast; it has two paths a task, and is joined by shuffle beyond.
MOST_REFS = 200_000

_NODE = [("kind", "string", pa.string()), ("part", "long", pa.int64()), ("no", "long", pa.int64()), ("conv_id", "long", pa.int64()), ("depth", "long", pa.int64()), ("parent_part", "long", pa.int64()), ("parent_no", "long", pa.int64()), ("parent_conv_id", "long", pa.int64()), ("n_convs", "long", pa.int64()), ("n_children", "long", pa.int64()), ("n_leaves", "long", pa.int64()), ("saved_tokens", "long", pa.int64()), ("ends_sha256", "string", pa.string())]
_EXTRA = [("open", "boolean", pa.bool_()), ("turn", "binary", pa.binary()), ("seq", "long", pa.int64()), ("ids", "string", pa.string())]
_COLUMNS = _NODE + _EXTRA
_KIND = ", ".join(f"{n} {t}" for n, t, _ in _COLUMNS)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (an array of 20 bytes each), in order of turn, null first, then role and text (by its first 32 characters, then by hash).

    Null role or text counts as empty; rows without a conv_id are no conversation's and go; repeated rows are turns of their own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)  # no two turns have one name
    turn = F.concat(F.substring(F.unhex(F.sha2(named, 256)), 1, HASH), F.unhex(F.lpad(F.hex(F.length(text)), 2 * (TURN - HASH), "0")))
    own = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("at"), role.alias("role"), F.substring(text, 1, 32).alias("begin"), turn.alias("turn")).alias("t"))
    own = own.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(100))).repartition("base")
    return own.groupBy("base", "conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda x: x["turn"]).alias("turns"))


def key(turns: Column) -> Column:
    """An array of turns as bytes, which sort as the array does."""
    return F.unhex(F.array_join(F.transform(turns, F.hex), ""))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and key: of conversation c the first h turns of the one with c's hundreds, then its own after its first h, h = crc32 of c's digits modulo 6.

    What a hundred's first conversation lends is at most five turns, and a hundred are one group, so no join or second shuffle is needed.  Hundreds of a negative id are
    those below it.
    """
    own = turns(conversations).withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int"))
    lent = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 5))).over(Window.partitionBy("base"))
    head = F.slice(F.coalesce(lent, F.array().cast("array<binary>")), F.lit(1), F.col("h"))
    return own.withColumn("head", head).select("conv_id", key(F.concat("head", F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))).alias("key"))


def common(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common at their beginning."""
    n = min(len(a), len(b)) // TURN
    if a[: n * TURN] == b[: n * TURN]:
        return n
    low, step = 0, 1
    while low + step <= n and a[low * TURN : (low + step) * TURN] == b[low * TURN : (low + step) * TURN]:
        low, step = low + step, 2 * step
    high = min(n, low + step)
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * TURN : mid * TURN] == b[low * TURN : mid * TURN]:
            low = mid
        else:
            high = mid
    return low


class _Open:
    """A node of which not everything has been seen."""

    __slots__ = ("at", "turn", "first", "n", "children", "leaves", "saved", "sha", "ids", "size", "seq", "asked")

    def __init__(self, at, turn: bytes):
        self.at, self.turn, self.first, self.n, self.children, self.leaves, self.saved = at, turn, None, 0, 0, 0, 0
        self.sha, self.ids, self.size, self.seq, self.asked = None, [], 0, 0, False

    def met(self, first: int, n: int) -> None:
        self.first, self.n = first if self.first is None else min(first, self.first), self.n + n

    def finish(self) -> None:
        if not self.children:
            self.leaves = 1
        self.saved += (self.n - 1) * int.from_bytes(self.turn[HASH:], "big")

    def child(self, node: _Open) -> None:
        self.met(node.first, node.n)
        self.children, self.leaves, self.saved = self.children + 1, self.leaves + node.leaves, self.saved + node.saved


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, _, t) in zip(zip(*rows, strict=True), _COLUMNS, strict=True)], [n for n, _, _ in _COLUMNS])


def _sweep(batches: Iterator[pa.RecordBatch], held: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and conv_id -> `node`s that are closed, with their parent's conv_id or its place (part, no) if that wasn't closed in time; the
    `path`s of the first and the last row; and `ids` of the conversations that end in a node, in pieces, for those on a path."""
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId(), 0
    stack: list[_Open] = []
    last, first_path = None, 0  # first_path: how deep the path of the first row still goes
    waiting: list[tuple[_Open, int, int]] = []  # closed nodes, their depth, their parent's number
    known: dict[int, int] = {}
    paths, pieces = [], []

    def piece(node: _Open) -> None:
        pieces.append(("ids", part, node.at, *[None] * 12, node.seq, ",".join(node.ids)))
        node.ids, node.size, node.seq = [], 0, node.seq + 1

    def path(node: _Open, depth: int, side: str, is_open: bool) -> None:
        if node.ids:
            piece(node)
        paths.append((side, part, node.at, node.first, depth, None, None, None, node.n, node.children, node.leaves, node.saved, None, is_open, node.turn, node.seq, None))

    def close() -> None:
        node, depth = stack.pop(), len(stack)
        if depth <= first_path:
            path(node, depth, "first", False)
            return
        node.finish()
        stack[-1].child(node)
        known[node.at] = node.first
        waiting.append((node, depth, stack[-1].at))

    def flush() -> list[tuple]:
        places = {n.at: n for n in stack}
        out = []
        for node, depth, parent in waiting:
            above = places.get(parent)
            if above is not None:
                above.asked = True
            of_parent = (part, parent, None) if parent not in known else (None, None, known[parent])
            out.append(("asked" if node.asked else "node", part, node.at, node.first, depth, *of_parent, node.n, node.children, node.leaves, node.saved, node.sha.hexdigest() if node.sha else NO_ENDS, None, None, None, None))
        out += paths + pieces
        waiting.clear(), known.clear(), paths.clear(), pieces.clear()
        return out

    for batch in batches:
        for conv_id, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shared, depth = -1, len(k) // TURN
            if last is not None:
                shared = common(last, k)
                while len(stack) - 1 > shared:
                    close()
            first_path = depth if last is None else min(first_path, shared)
            for d in range(shared + 1, depth + 1):
                stack.append(_Open(made, k[(d - 1) * TURN : d * TURN] if d else b""))
                made += 1
            top, text = stack[-1], str(conv_id)
            top.met(conv_id, 1)
            if top.sha is None:
                top.sha = hashlib.sha256(text.encode())
            else:
                top.sha.update(f",{text}".encode())
            top.ids.append(text)
            top.size += len(text) + 1
            if top.size > chunk:
                piece(top)
            last = k
            if len(waiting) + len(paths) + len(pieces) >= held:
                yield _batch(flush())
    while stack:
        node, depth = stack.pop(), len(stack)
        path(node, depth, "first" if depth <= first_path else "last", True)
    if out := flush():
        yield _batch(out)


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths in order of part, side (first, last) and depth -> the `node`s on them; `ref`, the place of each and the conv_id it got; `run`, the place of each and
    that of the node that its ends belong to."""
    stack: list[_Open] = []
    places: list[list[tuple[int, int]]] = []  # of each open node, where its parts are
    out: list[tuple] = []

    def close() -> None:
        node, own, depth = stack.pop(), places.pop(), len(stack)
        node.finish()
        if stack:
            stack[-1].child(node)
        above = places[-1][0] if stack else (None, None)
        out.append(("node", *own[0], node.first, depth, *above, None, node.n, node.children, node.leaves, node.saved, None if node.asked else NO_ENDS, None, None, None, None))
        out.extend(("ref", *at, node.first, *[None] * 13) for at in own)
        if node.asked:  # it has ends
            out.extend(("run", *at, None, None, *own[0], *[None] * 10) for at in own)

    def merge(r: dict) -> None:
        if r["depth"] == len(stack):
            stack.append(_Open(None, r["turn"])), places.append([])
        node = stack[r["depth"]]
        places[r["depth"]].append((r["part"], r["no"]))
        if r["n_convs"]:
            node.met(r["conv_id"], r["n_convs"])
        node.children, node.leaves, node.saved, node.asked = node.children + r["n_children"], node.leaves + r["n_leaves"], node.saved + r["saved_tokens"], node.asked or r["seq"] > 0

    def part_of(first: list[dict], rest: list[dict]) -> None:
        shared = -1
        while shared + 1 < min(len(stack), len(first)) and stack[shared + 1].turn == first[shared + 1]["turn"]:
            shared += 1
        while len(stack) - 1 > shared:
            close()
        for r in first:
            merge(r)
        still = max(r["depth"] for r in first if r["open"])
        while len(stack) - 1 > still:
            close()
        for r in rest:
            merge(r)

    part, first, rest = None, [], []
    for batch in batches:
        for r in batch.to_pylist():
            if r["part"] != part:
                if first:
                    part_of(first, rest)
                part, first, rest = r["part"], [], []
            (first if r["kind"] == "first" else rest).append(r)
        if out:
            yield _batch(out)
            out.clear()
    if first:
        part_of(first, rest)
    while stack:
        close()
    if out:
        yield _batch(out)


def _joined_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ids in order of run, part and seq -> each run's hash of all of them, joined by commas; one is held at a time."""
    at, sha = None, None
    for batch in batches:
        found = []
        for *run, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if run == at:
                sha.update(f",{ids}".encode())
            else:
                if at is not None:
                    found.append((*at, sha.hexdigest()))
                at, sha = run, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["run_part", "run_no", "sha"])
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]]), pa.array([sha.hexdigest()])], ["run_part", "run_no", "sha"])


def prefix_trie(arrays: DataFrame, held: int = HELD, chunk: int = CHUNK) -> DataFrame:
    """arrays(conv_id, key), a row for each conversation -> a row for each node: conv_id (the smallest member's), depth, parent_conv_id (the root's: null), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    A conversation without turns ends in the root; equal ones end in one node; without conversations there is no node.  The hash of the ids that end in a node is made where they
    are swept; only of nodes on the border of tasks are ids passed on, in pieces, to a task that reads them one after another, as sha256 can't be made of parts.
    """
    prepare(arrays.sparkSession)
    ranged = arrays.select("conv_id", "key").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    swept = materialise(ranged.mapInArrow(tidy(lambda batches: _sweep(batches, held, chunk)), _KIND), "trie")
    paths = swept.where(F.col("kind").isin("first", "last")).repartition(1).sortWithinPartitions("part", "kind", "depth")  # two paths a task
    stitched = materialise(paths.mapInArrow(tidy(_stitch), _KIND), "trie-paths")

    runs = stitched.where("kind = 'run'").select("part", "no", F.col("parent_part").alias("run_part"), F.col("parent_no").alias("run_no"))
    pieces = swept.where("kind = 'ids'").select("part", "no", "seq", "ids").join(runs, ["part", "no"])
    shas = pieces.repartition("run_part", "run_no").sortWithinPartitions("run_part", "run_no", "part", "seq").select("run_part", "run_no", "ids").mapInArrow(tidy(_joined_hashes), "run_part long, run_no long, sha string")
    names = [n for n, _, _ in _NODE]
    border = stitched.where("kind = 'node'").join(shas, (F.col("part") == F.col("run_part")) & (F.col("no") == F.col("run_no")), "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "sha")).select(names)

    nodes = swept.where(F.col("kind").isin("node", "asked")).select(names).unionByName(border)
    refs = swept.where("kind = 'asked'").unionByName(stitched.where("kind = 'ref'")).select(F.col("part").alias("ref_part"), F.col("no").alias("ref_no"), F.col("conv_id").alias("ref_conv_id"))
    refs = F.broadcast(refs) if refs.count() <= MOST_REFS else refs
    asking = nodes.where("parent_no IS NOT NULL").join(refs, (F.col("parent_part") == F.col("ref_part")) & (F.col("parent_no") == F.col("ref_no"))).withColumn("parent_conv_id", F.col("ref_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return nodes.where("parent_no IS NULL").select(out).unionByName(asking.select(out))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """prefix_trie() of the conversations as rebuilt() makes them; odd rows as in turns(), other columns are ignored."""
    prepare(conversations.sparkSession)
    return prefix_trie(rebuilt(conversations))

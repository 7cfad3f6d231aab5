"""Repair of the turn structure of conversations, by an auction for shortest paths.

A conversation's rows in order are the layers of a lattice. Its states are what has been kept so far:
nothing, an opening system turn, a user turn last, an assistant turn last. Arcs are edits: keep a row
(K), give it the role that the state asks for (R), delete it (D), insert an empty turn (I). Blank and
duplicate rows must go; the path must end with nothing or with an assistant turn.

Every node has an integer price, never more than what an arc costs plus the price behind it. The auction
holds a path from the start. If the price of its last node is less than its cheapest arc asks, the price
rises to that and the path is contracted by the node; else the path is extended along that arc. When the
end is reached, the price of the start is the least cost, and every cheapest path runs along tight arcs,
those whose cost is the difference of two prices. The tight arcs that lead to the end are followed in the
order of their letters, which gives the least of the cheapest edits.

Conversations may have any number of rows: rows are ordered by a range shuffle, cut into blocks of
``BLOCK`` at most, and the auction runs in each block. For a conversation of more than one block the
blocks' costs between their states are combined by a scan (in groups of ``FAN``), which gives every block
the prices behind it, and then the states that paths pass through by another. Copies of one row are one
row with a number before anything is shuffled by conversation.

Nulls: a null role or text counts as one space; null turns come first; rows of null conversations are a
conversation. Rows of one turn are ordered by role and text. A role is known by its initial (s, u or a);
rows of others cannot be kept as they are. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.session import stage

BLOCK_BITS = 6  # rows of a block
FAN_BITS = 8  # blocks combined at once
DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5  # costs; UNFINISHED for a truncated row that stays

FAR = 1 << 50
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = (USER, USER, ASSISTANT, USER)  # the state that a further turn leads to
_AT_END = (0, 2 * INSERT, INSERT, 0)  # what is missing to a proper end, by state
_ROLES = (None, "system", "user", "assistant")
_CHOICE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_WHITE = " \t\n\x0b\x0c\r"
PLAIN, TRUNCATED, FORCED = range(3)

Row = tuple[int, int, int]  # initial (a state, 0 for others), fault, copies


# --- one block ------------------------------------------------------------------------------------


class Lattice:
    """Costs of a block's edits; layer k lies before row k."""

    def __init__(self, rows: list[Row]):
        self.rows, self.size = rows, len(rows)
        self.drop = [DELETE * copies for _, _, copies in rows]
        # what staying costs, whatever the role: copies are deleted, a truncated text is fined
        self.stay = [
            FAR if fault == FORCED else DELETE * (copies - 1) + UNFINISHED * (fault == TRUNCATED) for _, fault, copies in rows
        ]

    def arcs(self, layer: int, state: int) -> list[tuple[str, int, int]]:
        """(letter, cost, node) of the edits at a node, by letter."""
        initial, ahead = self.rows[layer][0], _AFTER[state]
        found = [("D", self.drop[layer], 4 * layer + 4 + state), ("I", INSERT, 4 * layer + ahead)]
        stay = self.stay[layer]
        if stay < FAR:
            if initial == ahead:
                found.append(("K", stay, 4 * layer + 4 + ahead))
            else:
                if initial == SYSTEM and state == NOTHING:
                    found.append(("K", stay, 4 * layer + 4 + SYSTEM))
                found.append(("R", stay + REROLE, 4 * layer + 4 + ahead))
        return found

    def first_prices(self, ends: list[int]) -> list[int]:
        """Prices to begin with: what the rows ahead cost at least, one by one."""
        least = min(ends)
        prices = [least] * (4 * self.size + 4)
        for layer in range(self.size - 1, -1, -1):
            least += min(self.drop[layer], self.stay[layer])
            prices[4 * layer : 4 * layer + 4] = [least] * 4
        # nodes from which no end can be reached
        lost = [] if min(ends[USER], ends[ASSISTANT]) < FAR else [USER, ASSISTANT]
        lost += [SYSTEM] if lost and ends[SYSTEM] >= FAR else []
        for state in lost:
            prices[state::4] = [FAR] * (self.size + 1)
        return prices

    def auction(self, start: int, ends: list[int], prices: list[int]) -> int:
        """Least cost from a state before the block to the ends behind it; raises prices on the way."""
        last, path = 4 * self.size, [start]
        while True:
            node = path[-1]
            if node >= last:
                best, to = ends[node - last], -1
            else:
                best, to = min((cost + prices[there], there) for _, cost, there in self.arcs(node >> 2, node & 3))
            if prices[node] < best:
                prices[node] = min(best, FAR)
                if len(path) > 1:
                    path.pop()
                    continue
            if prices[start] >= FAR:
                return FAR
            if prices[node] >= best:
                if to < 0:
                    return prices[start]
                path.append(to)

    def tight(self, ends: list[int], prices: list[int]) -> list[list[tuple[str, int, int]]]:
        """Of each node, its tight arcs that lead to an end, by letter."""
        last = 4 * self.size
        good = [False] * last + [ends[q] < FAR and prices[last + q] == ends[q] for q in range(4)]
        kept: list[list[tuple[str, int, int]]] = [[] for _ in range(last)]
        for layer in range(self.size - 1, -1, -1):
            nodes = range(4 * layer, 4 * layer + 4)
            told = {n: [arc for arc in self.arcs(layer, n & 3) if prices[n] < FAR and prices[n] == arc[1] + prices[arc[2]]] for n in nodes}
            changed = True
            while changed:  # insertions stay in the layer
                changed = False
                for n in nodes:
                    if not good[n] and any(good[arc[2]] for arc in told[n]):
                        good[n] = changed = True
            for n in nodes:
                kept[n] = [arc for arc in told[n] if good[arc[2]]]
        return kept


def costs(rows: list[Row]) -> list[int]:
    """Least cost from each state before a block to each behind it (16 numbers, by the state before)."""
    lattice, out = Lattice(rows), [FAR] * 16
    for end in range(4):
        ends = [0 if q == end else FAR for q in range(4)]
        prices = lattice.first_prices(ends)
        for start in range(4):
            if prices[start] < FAR:
                out[4 * start + end] = lattice.auction(start, ends, prices)
    return out


def trace(rows: list[Row], starts: list[int], ends: list[int]) -> list[tuple[list[tuple[int, str, int]], int, int]]:
    """For each start: edits (row, letter, state behind), the state behind the block, their cost."""
    lattice = Lattice(rows)
    prices = lattice.first_prices(ends)
    for start in starts:
        lattice.auction(start, ends, prices)
    arcs = lattice.tight(ends, prices)
    out = []
    for start in starts:
        node, edits, cost = start, [], 0
        while node < 4 * lattice.size:
            letter, price, there = arcs[node][0]
            edits.append((node >> 2, letter, there & 3))
            cost += price
            node = there
        out.append((edits, node & 3, cost))
    return out


def illegal_pairs(rows: list[Row], before: int) -> int:
    """Adjacent rows that do not follow each other; ``before`` is the initial in front, -1 for none."""
    count = 0
    for initial, _, copies in rows:
        count += (before >= 0 and (before, initial) not in _LEGAL) + copies - 1
        before = initial
    return count


# --- scans over the blocks of long conversations --------------------------------------------------

Combine = Callable[[list[int], list[int]], list[int]]

ONE_COST = [0 if k % 5 == 0 else FAR for k in range(16)]
ONE_MAP = [0, 1, 2, 3, -1]


def chained(a: list[int], b: list[int]) -> list[int]:
    """Costs through two blocks."""
    return [min(FAR, *(a[4 * p + m] + b[4 * m + q] for m in range(4))) for p in range(4) for q in range(4)]


def followed(a: list[int], b: list[int]) -> list[int]:
    """States through two blocks, and the last initial of the second (or of the first, if it has none)."""
    return [*(b[a[q]] for q in range(4)), b[4] if b[4] >= 0 else a[4]]


def scan(elements: DataFrame, combine: Combine, one: list[int], backward: bool) -> DataFrame:
    """(conv, chunk, around): what lies before each element (conv, chunk, e) of its conversation, combined;
    behind it with ``backward``. Groups of at most 2**``FAN_BITS`` elements are combined at once."""
    most = elements.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    group = F.lit(0).cast("long") if most <= 1 << FAN_BITS else F.shiftright("chunk", FAN_BITS)
    groups = elements.groupBy("conv", group.alias("group")).agg(F.array_sort(F.collect_list(F.struct("chunk", "e"))).alias("parts"))
    groups = stage(groups, "structure-groups")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for parts in batch.column("parts").to_pylist():
                sum_ = one
                for part in parts:
                    sum_ = combine(sum_, part["e"])
                sums.append(sum_)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("group"), pa.array(sums, pa.list_(pa.int64()))], ["conv", "chunk", "e"])

    if most <= 1 << FAN_BITS:
        outer = groups.withColumn("outer", F.array(*map(F.lit, one)).cast("array<long>"))
    else:
        whole = stage(groups.mapInArrow(total, "conv string, chunk long, e array<long>"), "structure-totals")
        outer = scan(whole, combine, one, backward).select("conv", F.col("chunk").alias("group"), F.col("around").alias("outer"))
        outer = groups.join(outer, ["conv", "group"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, chunk, around = [], [], []
            for name, parts, seen in zip(*(batch.column(c).to_pylist() for c in ("conv", "parts", "outer")), strict=True):
                for part in reversed(parts) if backward else parts:
                    conv.append(name)
                    chunk.append(part["chunk"])
                    around.append(seen)
                    seen = combine(part["e"], seen) if backward else combine(seen, part["e"])
            columns = [pa.array(conv, pa.string()), pa.array(chunk, pa.int64()), pa.array(around, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "chunk", "around"])

    return outer.select("conv", "parts", "outer").mapInArrow(spread, "conv string, chunk long, around array<long>")


# --- conversations --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Repaired:
    """``rows``: (conv_id, place, step, edit, copies, role, text) of every edit, in order of place and step;
    ``report``: one row per conversation."""

    rows: DataFrame
    report: DataFrame


def key_of(conv_id: Column) -> Column:
    """Text that stands for a conversation, the null one included."""
    return F.coalesce(F.concat(F.lit("v"), conv_id.cast("string")), F.lit("n"))


def _ordered(turns: DataFrame) -> DataFrame:
    """Distinct rows with their number, fault and place in a global order by conversation."""
    count = F.col("copies") if "copies" in turns.columns else F.lit(1)
    rows = turns.select(
        key_of(F.col("conv_id")).alias("conv"), "conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), count.cast("long").alias("copies")
    )
    rows = rows.groupBy("conv", "conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    sign = [F.xxhash64("role", "text").alias("sign"), F.xxhash64(F.lit(1), "text", "role").alias("sign2")]
    rows = stage(rows.withColumns({"sign": sign[0], "sign2": sign[1]}), "turns")
    first = rows.groupBy("conv", "sign", "sign2").agg(F.min(F.struct("turn")).alias("first"))
    bare = F.btrim("text", F.lit(_WHITE))
    fault = (
        F.when(bare == "", "blank")
        .when(~F.col("turn").eqNullSafe(F.col("first.turn")), "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    )
    judged = rows.join(first, ["conv", "sign", "sign2"]).select("conv", "conv_id", "turn", "role", "text", "copies", fault.alias("fault"))
    by = ["conv", "turn", "role", "text"]
    # the place counts rows within a partition, and partitions are in order
    placed = judged.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id())
    return stage(placed, "turns-in-order")


_BLOCK = "conv string, chunk long, cost long, illegal long, edits array<struct<place:long,step:int,edit:string,copies:long,state:int>>"


def _solved(blocks: DataFrame) -> DataFrame:
    """Edits of each block (conv, chunk, rows, starts, ends, before, is_last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block in batch.to_pylist():
                rows, places = _rows_of(block["rows"]), [r["place"] for r in block["rows"]]
                edits, state, cost = trace(rows, [block["start"]], block["ends"])[0]
                steps, told = {}, []
                for row, letter, after in edits:
                    steps[row] = steps.get(row, -1) + 1
                    told.append({"place": places[row], "step": steps[row], "edit": letter, "copies": 1 if letter == "I" else rows[row][2], "state": after})
                if block["is_last"]:
                    while state in (SYSTEM, USER):
                        state = _AFTER[state]
                        steps[len(rows) - 1] += 1
                        told.append({"place": places[-1], "step": steps[len(rows) - 1], "edit": "I", "copies": 1, "state": state})
                        cost += INSERT
                out.append({"conv": block["conv"], "chunk": block["chunk"], "cost": cost, "illegal": illegal_pairs(rows, block["before"]), "edits": told})
            yield pa.RecordBatch.from_pylist(out, _block_schema())

    return blocks.mapInArrow(run, _BLOCK)


def _block_schema() -> pa.Schema:
    edit = pa.struct([("place", pa.int64()), ("step", pa.int32()), ("edit", pa.string()), ("copies", pa.int64()), ("state", pa.int32())])
    return pa.schema([("conv", pa.string()), ("chunk", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64()), ("edits", pa.list_(edit))])


def _rows_of(rows: list[dict]) -> list[Row]:
    return [(r["code"] // 3, r["code"] % 3, r["copies"]) for r in rows]


def _with_matrix(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [costs(_rows_of(rows)) for rows in batch.column("rows").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("chunk"), pa.array(found, pa.list_(pa.int64()))], ["conv", "chunk", "e"])

    return blocks.mapInArrow(run, "conv string, chunk long, e array<long>")


def _with_map(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for block, ends in zip(batch.column("rows").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                rows = _rows_of(block)
                found.append([*(state for _, state, _ in trace(rows, [0, 1, 2, 3], ends)), rows[-1][0]])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("chunk"), pa.array(found, pa.list_(pa.int64()))], ["conv", "chunk", "e"])

    return blocks.mapInArrow(run, "conv string, chunk long, e array<long>")


def _long_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks of conversations of several, with the state in front and the prices behind."""
    behind = scan(stage(_with_matrix(blocks), "block-costs"), chained, ONE_COST, backward=True)
    end = F.array(*map(F.lit, _AT_END)).cast("array<long>")

    def least(q: int):
        return F.least(F.lit(FAR), *(F.col("around")[4 * q + m] + end[m] for m in range(4)))

    last = F.col("around") == F.array(*map(F.lit, ONE_COST)).cast("array<long>")
    priced = blocks.join(behind, ["conv", "chunk"]).select(
        "conv", "chunk", "rows", F.array(*map(least, range(4))).alias("ends"), last.alias("is_last")
    )
    priced = stage(priced, "priced-blocks")
    front = scan(stage(_with_map(priced), "block-states"), followed, ONE_MAP, backward=False)
    return priced.join(front, ["conv", "chunk"]).select(
        "conv", "chunk", "rows", "ends", "is_last", F.col("around")[0].cast("int").alias("start"), F.col("around")[4].cast("int").alias("before")
    )


def repair(turns: DataFrame) -> Repaired:
    """Cheapest edits of every conversation of (conv_id, turn, role, text), and a report on each.

    An integer column ``copies``, if there is one, tells how often each row stands there.
    """
    placed = _ordered(turns)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(NOTHING)
    fault = F.when(F.col("fault").isin("blank", "duplicate"), FORCED).when(F.col("fault") == "truncated", TRUNCATED).otherwise(PLAIN)
    blocks = placed.groupBy("conv", F.shiftright("place", BLOCK_BITS).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("place", (code * 3 + fault).alias("code"), "copies"))).alias("rows")
    )
    number = stage(blocks, "blocks")
    many = stage(number.groupBy("conv").count().where("count > 1").select("conv"), "long-conversations")
    alone = number.join(many, "conv", "left_anti").select(
        "conv", "chunk", "rows", F.array(*map(F.lit, _AT_END)).cast("array<long>").alias("ends"),
        F.lit(True).alias("is_last"), F.lit(0).alias("start"), F.lit(-1).alias("before"),
    )
    if not many.isEmpty():
        alone = alone.unionByName(_long_blocks(stage(number.join(many, "conv", "left_semi"), "long-blocks")))
    solved = stage(_solved(alone), "solved-blocks")

    edits = solved.select("conv", F.explode("edits").alias("x")).select("conv", "x.*")
    texts = placed.select("place", F.col("role").alias("own_role"), "text")
    stays = edits.where("edit in ('K', 'R')").join(texts, "place")
    role = F.when(F.col("edit") == "K", F.col("own_role")).otherwise(F.element_at(F.array(*map(F.lit, _ROLES)), F.col("state") + 1))
    columns = ["conv", "place", "step", "edit", "copies"]
    kept = stays.select(*columns, role.alias("role"), "text")
    made = edits.where("edit = 'I'").select(*columns, F.element_at(F.array(*map(F.lit, _ROLES)), F.col("state") + 1).alias("role"), F.lit("").alias("text"))
    gone = edits.where("edit = 'D'").select(*columns, F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    kind = placed.schema["conv_id"].dataType
    conv_id = F.when(F.col("conv") != "n", F.expr("substring(conv, 2)").cast(kind)).alias("conv_id")
    times, first = F.col("copies"), F.col("fault")
    by_turn = placed.groupBy("conv", "turn").agg(
        F.sum(F.when(first == "blank", times).otherwise(0)).alias("blank"),
        F.sum(F.when(first == "blank", 0).when(first == "duplicate", times).otherwise(times - 1)).alias("duplicate"),
        F.sum(F.when(first == "truncated", 1).otherwise(0)).alias("truncated"), F.sum("copies").alias("n_rows"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    counted = by_turn.groupBy("conv").agg(
        gaps.alias("gaps"), *(F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "n_rows"))
    )
    costs_ = solved.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    report = counted.join(costs_, "conv").select("conv", conv_id, "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return Repaired(kept.unionByName(made).unionByName(gone).select("conv", conv_id, *columns[1:], "role", "text"), report)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, turn, role, text) with new turns from 0 (the conversation is
    passed through one task in order, a row at a time)."""
    kept = repair(turns).rows.where("edit <> 'D'")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turn = None, 0
        for batch in batches:
            numbers = []
            for name in batch.column("conv").to_pylist():
                conv, turn = name, turn + 1 if name == conv else 0
                numbers.append(turn)
            columns = [batch.column("conv_id"), pa.array(numbers, pa.int64()), batch.column("role"), batch.column("text")]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "role", "text"])

    kind = kept.schema["conv_id"].dataType.simpleString()
    ordered = kept.repartition("conv").sortWithinPartitions("conv", "place", "step")
    return ordered.select("conv", "conv_id", "role", "text").mapInArrow(number, f"conv_id {kind}, turn long, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256) of the edits of each conversation. A hash is taken in order, so a
    conversation passes through one task, which holds its letters and no texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: str | None = None
        letters: list[str] = []
        hashed, begun = hashlib.sha256(), False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([conv]), pa.array(["".join(letters)]), pa.array([hashed.hexdigest()])], ["conv", "audit", "repaired_sha256"]
            )

        ended: list[pa.RecordBatch] = []
        for batch in batches:
            for name, edit, copies, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != conv:
                    if conv is not None:
                        ended.append(done())
                    conv, letters, hashed, begun = name, [], hashlib.sha256(), False
                letters.append(edit * copies if edit == "D" else edit + "D" * (copies - 1))
                if edit != "D":
                    hashed.update(f"{'\n' if begun else ''}{role}:{text}".encode())
                    begun = True
            if ended:
                yield pa.Table.from_batches(ended).combine_chunks().to_batches()[0]
                ended = []
        if conv is not None:
            yield done()

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "place", "step")
    return ordered.select("conv", "edit", "copies", "role", "text").mapInArrow(run, "conv string, audit string, repaired_sha256 string")

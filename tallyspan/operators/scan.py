"""Folds with carried state over ordered rows, in parallel.

A ``Machine`` is a table: in a phase, on an event, go to a phase and count
something. What a stretch of rows does to a machine is itself a small table
(from each phase: the phase reached and what was counted), and such tables
compose. So a scan needs no unit in one task: rows are sorted by ranges and cut
into blocks, each block is reduced to the tables of the units at its edges,
these are scanned in the same way, and each block then runs once more from the
state that it really starts with.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.session import materialize

#: Rows of a block; a task holds one block at a time.
BLOCK = 10_000
#: Edge tables that one task scans; more are cut into blocks again.
ONE_TASK = 50_000


@dataclass(frozen=True)
class Machine:
    """``rules``: (phase, event) -> (phase, names of counters to raise); a pair without a rule changes nothing."""

    start: str
    rules: dict[tuple[str, str], tuple[str, tuple[str, ...]]]

    @property
    def phases(self) -> list[str]:
        return sorted({self.start} | {p for p, _ in self.rules} | {p for p, _ in self.rules.values()})

    @property
    def counters(self) -> list[str]:
        return sorted({c for _, raised in self.rules.values() for c in raised})


class _Compiled:
    """Machines as integers. An element has, of each machine and phase, the phase reached and the counts."""

    def __init__(self, machines: list[Machine]):
        self.machines = machines
        self.phases = [m.phases for m in machines]
        self.counters = [m.counters for m in machines]
        self.identity = tuple(tuple((p, (0,) * len(c)) for p in range(len(ph))) for ph, c in zip(self.phases, self.counters, strict=True))
        self.start = tuple((ph.index(m.start), (0,) * len(c)) for m, ph, c in zip(machines, self.phases, self.counters, strict=True))
        self.held: dict[tuple, tuple] = {}

    def of(self, events: tuple) -> tuple:
        """The element of one row, from the event that each machine sees."""
        if events not in self.held:
            out = []
            for m, event, ph, counters in zip(self.machines, events, self.phases, self.counters, strict=True):
                rows = []
                for p in ph:
                    to, raised = m.rules.get((p, event), (p, ()))
                    rows.append((ph.index(to), tuple(raised.count(c) for c in counters)))
                out.append(tuple(rows))
            self.held[events] = tuple(out)
        return self.held[events]

    @staticmethod
    def step(state: tuple, element: tuple) -> tuple:
        return tuple((e[p][0], tuple(map(sum, zip(n, e[p][1], strict=True)))) for (p, n), e in zip(state, element, strict=True))

    @staticmethod
    def then(a: tuple, b: tuple) -> tuple:
        return tuple(tuple((y[p][0], tuple(map(sum, zip(n, y[p][1], strict=True)))) for p, n in x) for x, y in zip(a, b, strict=True))

    def flat(self, element: tuple) -> list[int]:
        return [v for m in element for p, n in m for v in (p, *n)]

    def element(self, flat: list[int]) -> tuple:
        out, at = [], 0
        for ph, c in zip(self.phases, self.counters, strict=True):
            rows = []
            for _ in ph:
                rows.append((flat[at], tuple(flat[at + 1 : at + 1 + len(c)])))
                at += 1 + len(c)
            out.append(tuple(rows))
        return tuple(out)

    def state(self, flat: list[int]) -> tuple:
        out, at = [], 0
        for c in self.counters:
            out.append((flat[at], tuple(flat[at + 1 : at + 1 + len(c)])))
            at += 1 + len(c)
        return tuple(out)


def _cut(rows: DataFrame, order: list[str], label: str, block: int) -> DataFrame:
    """``rows`` sorted by ranges, with ``__id``, ascending in that order, and ``__block``."""
    run = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    place = F.expr(f"shiftleft(shiftright(__id, 33), 20) + (__id & {(1 << 33) - 1}) div {block}")
    return materialize(run.withColumn("__block", place), label)


def _edges(rows: DataFrame, unit: str, elements: list[str], machines: _Compiled, of_rows: bool) -> DataFrame:
    """``(__unit, __id, __block, first, element)`` of the first and the last unit of each block."""
    kind = rows.schema[unit].dataType.simpleString()
    schema = f"__unit {kind}, __id long, __block long, first boolean, element array<long>"

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("__id")
        units, ids = t.column("__unit").to_pylist(), t.column("__id").to_pylist()
        read = [t.column(e).to_pylist() for e in elements]
        out: list[list] = []
        for k, (u, i) in enumerate(zip(units, ids, strict=True)):
            if not out or u != units[k - 1]:
                if len(out) > 1:
                    out.pop()  # a unit within the block is whole
                out.append([u, i, not out, machines.identity])
            element = machines.of(tuple(r[k] for r in read)) if of_rows else machines.element(read[0][k])
            out[-1][3] = machines.then(out[-1][3], element)
        block = t.column("__block")[0].as_py()
        return pa.table(
            {
                "__unit": pa.array([o[0] for o in out], t.schema.field("__unit").type),
                "__id": pa.array([o[1] for o in out], pa.int64()),
                "__block": pa.array([block] * len(out), pa.int64()),
                "first": pa.array([o[2] for o in out], pa.bool_()),
                "element": pa.array([machines.flat(o[3]) for o in out], pa.list_(pa.int64())),
            }
        )

    return rows.select(F.col(unit).alias("__unit"), "__id", "__block", *elements).groupBy("__block").applyInArrow(run, schema)


def _starts(edges: DataFrame, machines: _Compiled, block: int, one_task: int, above: int | None = None) -> DataFrame:
    """``(__block, state)``: the state in which the first unit of each block begins.

    ``above`` is the number of edges that were cut into these; blocks so small
    that their edges don't become fewer are left to one task.
    """
    schema = "__block long, state array<long>"

    def run(key: tuple, t: pa.Table, starts: pa.Table) -> pa.Table:
        t = t.sort_by("__id")
        state, before, out = machines.start, object(), []
        if starts.num_rows:
            state, before = machines.state(starts.column("state")[0].as_py()), t.column("__unit")[0].as_py()
        rows = zip(*(t.column(c).to_pylist() for c in ("__unit", "__block0", "first", "element")), strict=True)
        for u, b, first, element in rows:
            if u != before:
                state, before = machines.start, u
            if first:
                out.append((b, [v for p, n in state for v in (p, *n)]))
            state = machines.step(state, machines.element(element))
        return pa.table({"__block": pa.array([o[0] for o in out], pa.int64()), "state": pa.array([o[1] for o in out], pa.list_(pa.int64()))})

    named = edges.withColumnRenamed("__block", "__block0").withColumnRenamed("__id", "__id0")
    count = edges.count()
    if count <= one_task or (above is not None and 2 * count > above):
        whole = named.withColumn("__block", F.lit(0).cast("long")).withColumnRenamed("__id0", "__id")
        none = edges.limit(0).select("__block", F.col("element").alias("state"))
    else:
        whole = _cut(named, ["__id0"], "scan-edges", block)
        none = _starts(materialize(_edges(whole, "__unit", ["element"], machines, False), "scan-edges"), machines, block, one_task, count)
    return whole.groupBy("__block").cogroup(none.groupBy("__block")).applyInArrow(run, schema)


def scan(rows: DataFrame, unit: str, order: list[str], machines: dict[str, tuple[str, Machine]], block: int = BLOCK, one_task: int = ONE_TASK) -> DataFrame:
    """``rows`` with, of each machine, a column of its name, the phase before the row, and its counters after the row.

    ``machines`` maps a name to (column of events, machine). ``unit`` and
    ``order`` must order the rows totally. A null unit is a unit of its own; a
    null event changes nothing. Whole rows pass through Python once.
    """
    names = list(machines)
    own = _Compiled([machines[n][1] for n in names])
    events = [f"__e{i}" for i in range(len(names))]
    marked = rows.withColumns({e: F.col(machines[n][0]).cast("string") for e, n in zip(events, names, strict=True)})
    run = _cut(marked, [unit, *order], "scan-rows", block)
    edges = materialize(_edges(run, unit, events, own, True), "scan-edges")
    starts = _starts(edges, own, block, one_task)
    columns = [(n, "string") for n in names] + [(c, "long") for m in own.counters for c in m]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema], *[f"{n} {t}" for n, t in columns]])
    keep = rows.columns

    def fold(key: tuple, t: pa.Table, begin: pa.Table) -> pa.Table:
        t = t.sort_by("__id")
        state, before = own.start, object()
        if begin.num_rows:
            state, before = own.state(begin.column("state")[0].as_py()), t.column(unit)[0].as_py()
        phases: list[list[str]] = [[] for _ in names]
        counts: list[list[int]] = [[] for _ in range(len(columns) - len(names))]
        for u, *e in zip(*(t.column(c).to_pylist() for c in (unit, *events)), strict=True):
            if u != before:
                state, before = own.start, u
            for out, ph, (p, _) in zip(phases, own.phases, state, strict=True):
                out.append(ph[p])
            state = own.step(state, own.of(tuple(e)))
            for out, v in zip(counts, [v for _, n in state for v in n], strict=True):
                out.append(v)
        made = [pa.array(x, pa.string()) for x in phases] + [pa.array(x, pa.int64()) for x in counts]
        return pa.Table.from_arrays([*[t.column(c) for c in keep], *made], names=[*keep, *[n for n, _ in columns]])

    return run.groupBy("__block").cogroup(starts.groupBy("__block")).applyInArrow(fold, schema)

"""Ordered folds by small automata, and the funnel over the order of events.

A fold that depends on the order of a key's events (a state machine) is usually
done by sorting the key's rows in one task.  Here every event becomes the
transition function of its symbol, a table "state before -> state after" packed
into one BIGINT.  Functions compose associatively, so they are composed within
short blocks of time, the blocks' functions within longer ones, and so on: a
block of each level has at most 2^16 blocks of the level below, whatever the
number of events, and blocks of one key lie in different tasks.  A key with a
third of all rows is spread like any other.

All steps are built-in expressions; a level is one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.operators.funnel import FUNNEL_STEPS

#: Bits of a state in a packed function; states are 0 to 15.
STATE_BITS = 4
#: Microseconds (as a power of two) that a block of the first level spans, and how many blocks go into one above.
FIRST_BITS = 14
LEVEL_BITS = 16
LEVELS = 3


@dataclass(frozen=True)
class Machine:
    """``table[symbol][state]``: the state after a symbol; a fold starts in state 0."""
    table: tuple[tuple[int, ...], ...]

    def __post_init__(self):
        n = len(self.table[0])
        if not 0 < n <= 1 << STATE_BITS or any(len(t) != n or not all(0 <= s < n for s in t) for t in self.table):
            raise ValueError("a machine has 1 to 16 states, and every symbol leads from each of them to one")

    @property
    def states(self) -> int:
        return len(self.table[0])

    def packed(self, after: Sequence[int]) -> int:
        """The function ``state -> after[state]`` as a signed BIGINT."""
        code = sum(s << (STATE_BITS * i) for i, s in enumerate(after))
        return code - (1 << 64) if code >> 63 else code


def _at(function: Column, state: Column) -> Column:
    shift = (state * STATE_BITS).cast("int")
    return F.call_function("shiftright", function, shift).bitwiseAND(F.lit((1 << STATE_BITS) - 1).cast("long"))


def _then(first: Column, second: Column, states: int) -> Column:
    """The function that applies ``first`` and then ``second``."""
    out = F.lit(0).cast("long")
    for s in range(states):
        out = out.bitwiseOR(F.shiftleft(_at(second, _at(first, F.lit(s))), STATE_BITS * s))
    return out


def _composed(parts: Column, machine: Machine) -> Column:
    """The functions ``f`` of an array of structs, one after the other in the structs' order."""
    same = F.lit(machine.packed(range(machine.states))).cast("long")
    return F.aggregate(F.sort_array(parts), same, lambda acc, x: _then(acc, x["f"], machine.states))


def ordered_fold(events: DataFrame, keys: Sequence[str], symbol: Column, machine: Machine,
                 time_col: str = "timestamp") -> DataFrame:
    """Per key (keys..., state): the machine's state after the key's events in order of time.

    ``symbol`` numbers an event's row of ``machine.table``; null: the event changes nothing.  Events of one time
    are taken in order of their symbols, equal ones once.  Events without a time have no place and are left out.
    Keys may be null; a key all of whose events change nothing is in state 0.
    """
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    codes = F.array(*(F.lit(machine.packed(t)).cast("long") for t in machine.table))
    rows = events.select(*keys, micros.alias("at"), symbol.cast("int").alias("symbol")).filter(F.col("at").isNotNull())
    moved = F.when(F.col("symbol").isNotNull(), F.struct(
        "at", "symbol", F.element_at(codes, F.col("symbol") + 1).alias("f")))
    # events of one time and symbol merge here, map-side first: 2^14 microseconds times the symbols at most
    level = (rows.withColumn("block", F.shiftright("at", FIRST_BITS))
             .groupBy(*keys, "block").agg(F.collect_set(moved).alias("parts")))
    for _ in range(LEVELS - 1):
        level = (level.select(*keys, "block", _composed(F.col("parts"), machine).alias("f"))
                 .groupBy(*keys, F.shiftright("block", LEVEL_BITS).alias("block"))
                 .agg(F.collect_list(F.struct("block", "f")).alias("parts")))
    last = (level.select(*keys, "block", _composed(F.col("parts"), machine).alias("f"))
            .groupBy(*keys).agg(F.collect_list(F.struct("block", "f")).alias("parts")))
    return last.select(*keys, _at(_composed(F.col("parts"), machine), F.lit(0)).cast("int").alias("state"))


def steps_machine(n: int) -> Machine:
    """States 0 to n: how many steps were taken in order; symbol k leads from state k to k + 1 and changes no other."""
    return Machine(tuple(tuple(s + 1 if s == k else s for s in range(n + 1)) for k in range(n)))


def session_depth(events: DataFrame, time_col: str = "timestamp", steps=FUNNEL_STEPS) -> DataFrame:
    """(session_id, depth): the steps a session took one after the other, whatever lies between them."""
    symbol = F.lit(None).cast("int")
    for i, (_, types) in reversed(list(enumerate(steps))):
        symbol = F.when(F.col("event_type").isin(list(types)), F.lit(i)).otherwise(symbol)
    return ordered_fold(events, ["session_id"], symbol, steps_machine(len(steps)), time_col).withColumnRenamed("state", "depth")


def funnel_ordered(events: DataFrame, time_col: str = "timestamp", steps=FUNNEL_STEPS) -> DataFrame:
    """G1 over the order of events: sessions that took each step after the ones before it (step_no, step, sessions).

    Unlike :func:`eventlens.operators.funnel.conversion_funnel`, which compares the steps' first times, a cart before
    the first view hides nothing: ``cart, view, cart, checkout, purchase`` takes all four steps.
    """
    depth = session_depth(events, time_col, steps)
    counts = depth.agg(*[F.count_if(F.col("depth") >= i).alias(f"s{i}") for i in range(1, len(steps) + 1)])
    stack = ", ".join(f"{i}, '{name}', s{i}" for i, (name, _) in enumerate(steps, start=1))
    return counts.selectExpr(f"stack({len(steps)}, {stack}) AS (step_no, step, sessions)")

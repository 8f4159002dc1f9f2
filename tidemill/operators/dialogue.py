"""Guided dialogues as a finite-state machine over the ordered turns of a session.

A turn is a function on the few states of the machine, and functions compose. So a long session is
cut into chunks of turns: each chunk is folded to one function, the functions give every chunk its
starting state, and the chunks then run side by side. No session is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.text import is_cancel, is_help, match_option, normalise_answer
from tidemill.operators.ordered import row_numbers

Step = tuple[str, str, str, str | None]


class Machine:
    """States numbered from 1; state 1 is idle."""

    def __init__(self, steps: Sequence[Step] = tuple(fv.DIALOGUE_STEPS)):
        self.states = ["idle"]
        self.options: dict[str, list[tuple[str, str | None]]] = {}
        self.starts: dict[str, str] = {}
        for flow, state, answer, nxt in steps:
            self.starts.setdefault(flow, state)
            self.options.setdefault(state, []).append((answer, nxt))
            if state not in self.states:
                self.states.append(state)

    def number(self, state: str | None) -> int:
        return 1 if state is None else self.states.index(state) + 1

    def next_states(self, text: Column, intent: Column) -> Column:
        """Array with the next state for every current state: help keeps it, a cancel word leaves, a
        matched option advances or ends, anything else stays; an idle session starts an intent's flow."""
        key = normalise_answer(F.trim(text))
        start = F.lit(1)
        for flow, state in self.starts.items():
            start = F.when(intent == flow, F.lit(self.number(state))).otherwise(start)
        rows = [F.when(is_help(text), F.lit(1)).otherwise(start)]
        for state in self.states[1:]:
            here = F.lit(self.number(state))
            option = match_option(key, [a for a, _ in self.options[state]])
            move = here
            for answer, nxt in self.options[state]:
                move = F.when(option == answer, F.lit(self.number(nxt))).otherwise(move)
            rows.append(F.when(is_help(text), here).when(is_cancel(text), F.lit(1)).otherwise(move))
        return F.array(*rows)

    def action(self, before: Column, after: Column, text: Column, intent: Column) -> Column:
        """What the turn did: help, cancel, start, advance, finish, repeat (not understood), answer."""
        idle_before, idle_after = before == 1, after == 1
        return (
            F.when(is_help(text), "help")
            .when(idle_before & idle_after, "answer")
            .when(idle_before, "start")
            .when(is_cancel(text), "cancel")
            .when(idle_after, "finish")
            .when(before == after, "repeat")
            .otherwise("advance")
        )

    def names(self) -> Column:
        return F.array(*[F.lit(s) for s in self.states])


def turn_numbers(turns: DataFrame, session: str, order: str, grain_width: int = 4096) -> DataFrame:
    """Position of each turn in its session from 1, for sessions of any length."""
    return row_numbers(turns, [session], [F.col(order)], F.floor(F.col(order) / grain_width), "turn_no")


def dialogue(turns: DataFrame, session: str, order: str, text: str, intent: str, machine: Machine | None = None, chunk: int = 2048,
             clear: Column | None = None) -> DataFrame:
    """Per turn the state before and after and the action taken. A turn for which ``clear`` holds ends the
    open dialogue, whatever it says."""
    m = machine or Machine()
    size = len(m.states)
    cleared = F.lit(False) if clear is None else F.coalesce(clear, F.lit(False))
    idle = F.array(*[F.lit(1)] * size)
    stepped = turns.withColumn("__step", F.when(cleared, idle).otherwise(m.next_states(F.col(text), F.col(intent)))).withColumn("__chunk", F.floor(F.col(order) / chunk))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("__step").alias("s"))))
    identity = F.array(*[F.lit(i + 1) for i in range(size)])
    chunks = stepped.groupBy(session, "__chunk").agg(ordered.alias("__turns")).withColumn(
        "__map", F.aggregate("__turns", identity, lambda acc, t: F.transform(acc, lambda s: F.element_at(t.getField("s"), s)))
    )
    started = chunks.drop("__map").join(_chunk_starts(chunks.select(session, "__chunk", "__map"), session), [session, "__chunk"])
    walked = started.withColumn(
        "__states",
        F.aggregate(
            "__turns",
            F.array(F.col("__start")),
            lambda acc, t: F.concat(acc, F.array(F.element_at(t.getField("s"), F.element_at(acc, -1)))),
        ),
    )
    states = walked.select(
        session,
        F.posexplode(F.col("__turns.o")).alias("__i", order),
        "__states",
    ).select(
        session, order,
        F.element_at("__states", F.col("__i") + 1).alias("__before"),
        F.element_at("__states", F.col("__i") + 2).alias("__after"),
    )
    out = turns.join(states, [session, order])
    return out.select(
        *turns.columns,
        F.element_at(m.names(), F.col("__before")).alias("state_before"),
        F.element_at(m.names(), F.col("__after")).alias("state_after"),
        F.when(cleared, "clear").otherwise(m.action(F.col("__before"), F.col("__after"), F.col(text), F.col(intent))).alias("action"),
    )


def _chunk_starts(maps: DataFrame, session: str) -> DataFrame:
    """Start state per chunk (session, chunk, start). Sessions of one chunk start idle; longer ones run
    through their maps, a few numbers per chunk."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__chunk")
        state, starts = 1, []
        for step in pdf["__map"]:
            starts.append(state)
            state = int(step[state - 1])
        return pdf.drop(columns="__map").assign(__start=starts)

    kind = maps.schema[session].dataType.simpleString()
    sizes = maps.groupBy(session).agg(F.count("*").alias("__n"))
    counted = maps.join(sizes, session)
    long = counted.filter("__n > 1").select(session, "__chunk", "__map")
    starts = long.groupBy(session).applyInPandas(run, f"`{session}` {kind}, `__chunk` bigint, `__start` int")
    return counted.filter("__n = 1").select(session, "__chunk", F.lit(1).alias("__start")).unionByName(starts)


def session_history(turns: DataFrame, session: str, order: str, cleared: DataFrame | None = None) -> DataFrame:
    """The turns of each session in order with their number and the session's count; sessions listed in
    ``cleared`` lose the turns up to the given order."""
    rows = turns
    if cleared is not None:
        marks = cleared.groupBy(session).agg(F.max(order).alias("__cleared"))
        rows = rows.join(marks, session, "left").filter(F.col("__cleared").isNull() | (F.col(order) > F.col("__cleared"))).drop("__cleared")
    counts = rows.groupBy(session).agg(F.count("*").alias("turn_count"))
    return turn_numbers(rows, session, order).join(counts, session)

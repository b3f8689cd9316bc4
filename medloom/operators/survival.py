"""Time to event, competing, recurrent and counting-process outputs, and Kaplan-Meier."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def censored(cohort: DataFrame, start_offset: int = 0, end_offset: int | None = None, death: DataFrame | None = None, admin: str | None = None) -> DataFrame:
    """Episodes with entry_day and exit_day of the time at risk, in days from the index."""
    c = cohort
    ends = [F.col("cohort_end_date"), F.col("obs_end")]
    if death is not None:
        c = c.join(death.groupBy(F.col("person_id").alias("subject_id")).agg(F.min("death_date").alias("death_date")), "subject_id", "left")
        ends.append(F.coalesce("death_date", "cohort_end_date"))
    if end_offset is not None:
        ends.append(F.date_add("cohort_start_date", end_offset))
    if admin:
        ends.append(F.lit(admin).cast("date"))
    c = c.withColumn("entry_day", F.lit(start_offset)).withColumn("exit_day", F.datediff(F.least(*ends), "cohort_start_date"))
    return c.where("exit_day >= entry_day").select("subject_id", "episode_id", "cohort_start_date", "entry_day", "exit_day")


def _at_risk(risk: DataFrame, outcomes: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Outcome events at risk: (subject_id, episode_id, outcome_name, day)."""
    out = None
    for name, (df, date) in outcomes.items():
        e = df.select(F.col("person_id").alias("subject_id"), F.col(date).alias("d"), F.lit(name).alias("outcome_name"))
        out = e if out is None else out.unionByName(e)
    j = risk.join(out, "subject_id").withColumn("day", F.datediff("d", "cohort_start_date")).where("day between entry_day and exit_day")
    return j.select("subject_id", "episode_id", "outcome_name", "day")


def time_to_event(risk: DataFrame, outcomes: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The first outcome of each episode, or its censoring: event and time; with several
    outcomes they compete, and a tie goes to the first name."""
    first = _at_risk(risk, outcomes).groupBy("subject_id", "episode_id").agg(F.min(F.struct("day", "outcome_name")).alias("f"))
    j = risk.join(first, ["subject_id", "episode_id"], "left")
    return j.select("subject_id", "episode_id", F.col("f").isNotNull().cast("int").alias("event"), F.col("f.outcome_name").alias("outcome_name"), (F.coalesce("f.day", "exit_day") - F.col("entry_day")).alias("time_to_event_days"))


def recurrent(risk: DataFrame, outcomes: dict[str, tuple[DataFrame, str]], washout: int = 0, ties: str = "all") -> DataFrame:
    """All events of each episode in order; within ``washout`` days of the last one kept of the
    same outcome none counts. Of outcomes on one day all count, or (ties "priority") the
    first of the list."""
    at = _at_risk(risk, outcomes)
    if ties == "priority":
        rank = F.array_position(F.array(*map(F.lit, outcomes)), F.col("outcome_name"))
        at = at.groupBy("subject_id", "episode_id", "day").agg(F.min_by("outcome_name", rank).alias("outcome_name"))
    elif ties != "all":
        raise ValueError(f"no such policy: {ties}")
    days = at.groupBy("subject_id", "episode_id", "outcome_name").agg(F.array_sort(F.collect_set("day")).alias("days"))
    zero = F.array().cast("array<int>")
    kept = F.aggregate("days", zero, lambda s, d: F.when((F.size(s) == 0) | (d - F.try_element_at(s, F.lit(-1)) > washout), F.concat(s, F.array(d))).otherwise(s))
    return days.select("subject_id", "episode_id", "outcome_name", F.posexplode(kept).alias("i", "event_days_from_index")).select("subject_id", "episode_id", "outcome_name", (F.col("i") + 1).alias("event_number"), "event_days_from_index")


def counting_process(risk: DataFrame, outcome: DataFrame, date: str) -> DataFrame:
    """Intervals between events until the end of risk: (interval_number, start, end, event)."""
    e = _at_risk(risk, {"outcome": (outcome, date)}).select("subject_id", "episode_id", "day", F.lit(1).alias("event")).distinct()
    end = risk.select("subject_id", "episode_id", F.col("exit_day").alias("day"), F.lit(0).alias("event"))
    steps = e.unionByName(end).groupBy("subject_id", "episode_id", "day").agg(F.max("event").alias("event"))
    w = W.partitionBy("subject_id", "episode_id").orderBy("day")
    entry = risk.select("subject_id", "episode_id", "entry_day")
    out = steps.join(entry, ["subject_id", "episode_id"]).withColumn("interval_start_days", F.coalesce(F.lag("day").over(w), F.col("entry_day")))
    return out.withColumn("interval_number", F.row_number().over(w)).select("subject_id", "episode_id", "interval_number", "interval_start_days", F.col("day").alias("interval_end_days"), "event")


def state_graph(states: Sequence[str], transitions: Sequence | dict) -> tuple[list[str], list[tuple[str, str]]]:
    """The states, the first being where an episode begins, and the transitions as edges in
    order. transitions: edges (from, to); or a dict of each state's targets, by name or by
    number from 1; or a square matrix over the states with the transitions' numbers 1 to n,
    None where there is none. An error: names that aren't states or come twice, no edge, an
    edge twice, one from a state to itself, a state that the first doesn't reach.
    """
    states, n = list(states), len(states)
    if n < 2 or len({s.lower() for s in states}) < n or not all(re.fullmatch(r"[A-Za-z][A-Za-z0-9_.-]*", s) for s in states):
        raise ValueError("states need two or more names of letters, digits, _, . and -, different in lower case too")
    if isinstance(transitions, dict):
        named = lambda t: states[int(t) - 1] if str(t).isdigit() and 0 < int(t) <= n else t
        edges = [(a, named(b)) for a, to in transitions.items() for b in to or ()]
    elif len(transitions) and not isinstance(transitions[0][0], str):
        if len(transitions) != n or any(len(row) != n for row in transitions):
            raise ValueError("a matrix of transitions must have a row and a column for each state")
        cells = sorted((x, states[i], states[j]) for i, row in enumerate(transitions) for j, x in enumerate(row) if x is not None)
        if [x for x, _, _ in cells] != list(range(1, len(cells) + 1)):
            raise ValueError("transitions of a matrix must be numbered from 1, each once")
        edges = [(a, b) for _, a, b in cells]
    else:
        edges = [tuple(e) for e in transitions]
    if not edges or len(set(edges)) < len(edges) or any(a not in states or b not in states or a == b for a, b in edges):
        raise ValueError("transitions must be different edges between different states")
    reached, front = set(), {states[0]}
    while front:
        reached |= front
        front = {b for a, b in edges if a in front} - reached
    if lost := [s for s in states if s not in reached]:
        raise ValueError(f"states that the first doesn't reach: {lost}")
    return states, edges


def multi_state(cohort: DataFrame, events: DataFrame, states: Sequence[str], transitions: Sequence | dict, ties: str = "priority", step_days: float = 0.01) -> DataFrame:
    """Risk rows of a state graph: (subject_id, episode_id, from_state, to_state, t_start, t_stop, status).

    events: (subject_id, episode_id, day, state, exit_day). Events are walked in the order
    of days (ties by state order); one that the current state doesn't lead to is passed
    over. Each stay gives a row for each edge out of its state. With ties "priority" an
    episode moves once a day; with "sequential" it moves on within the day, each time
    ``step_days`` later, and times are doubles. transitions: see state_graph. The walk is a fold over the days of an
    episode, in the JVM.
    """
    if ties not in ("priority", "sequential"):
        raise ValueError(f"no such policy: {ties}")
    states, edges = state_graph(states, transitions)
    time = "double" if ties == "sequential" else "int"
    spark = cohort.sparkSession
    code = {s: i for i, s in enumerate(states)}
    number = F.element_at(F.create_map(*[F.lit(x) for s, i in code.items() for x in (s, i)]), F.col("state"))
    to = F.array(*[F.array(*[F.lit(code[b]) for a, b in edges if a == s]).cast("array<int>") for s in states])
    seq = events.groupBy("subject_id", "episode_id").agg(F.array_sort(F.collect_set(F.struct("day", number.alias("state")))).alias("walk"))
    base = cohort.join(seq, ["subject_id", "episode_id"], "left").withColumn("walk", F.coalesce("walk", F.array().cast("array<struct<day:int,state:int>>")))
    kind = f"array<struct<state:int,start:{time},stop:{time},next:int>>"
    state = f"struct<cur:int,since:{time},out:{kind}>"
    zero = F.struct(F.lit(0).alias("cur"), F.col("entry_day").alias("since"), F.array().cast(kind).alias("out")).cast(state)

    def step(s, x):
        moved = (F.size(s["out"]) > 0) & (x["day"] == F.floor(s["since"]))  # this day
        when = F.when(x["day"] > s["since"], x["day"].cast(time))
        if ties == "sequential":
            when = when.when(moved, F.round(s["since"] + step_days, 9))
        go = F.array_contains(F.element_at(to, s["cur"] + 1), x["state"]) & when.isNotNull() & (x["day"] <= F.col("exit_day"))
        stay = F.struct(s["cur"].alias("state"), s["since"].alias("start"), when.alias("stop"), x["state"].alias("next"))
        return F.when(go, F.struct(x["state"].alias("cur"), when.alias("since"), F.concat(s["out"], F.array(stay)).alias("out")).cast(state)).otherwise(s)

    last = lambda s: F.concat(s["out"], F.array(F.struct(s["cur"].alias("state"), s["since"].alias("start"), F.col("exit_day").cast(time).alias("stop"), F.lit(None).cast("int").alias("next")))).cast(kind)
    stays = base.select("subject_id", "episode_id", F.explode(F.aggregate("walk", zero, step, last)).alias("x")).where("x.stop > x.start")
    table = spark.createDataFrame([(code[a], code[b], a, b) for a, b in edges], "a int, b int, from_state string, to_state string")
    return stays.join(F.broadcast(table), F.col("x.state") == F.col("a")).select("subject_id", "episode_id", "from_state", "to_state", F.col("x.start").alias("t_start"), F.col("x.stop").alias("t_stop"), F.coalesce(F.col("x.next") == F.col("b"), F.lit(False)).cast("int").alias("status"))


def kaplan_meier(times: DataFrame, time: str, event: str) -> DataFrame:
    """(time, at_risk, events, survival) at each time with an event, by running counts and product."""
    g = times.groupBy(F.col(time).alias("time")).agg(F.count("*").alias("n"), F.sum(event).alias("events"))
    back = W.orderBy(F.desc("time")).rowsBetween(W.unboundedPreceding, 0)  # one row per distinct day
    g = g.withColumn("at_risk", F.sum("n").over(back)).where("events > 0")
    up = W.orderBy("time").rowsBetween(W.unboundedPreceding, 0)
    return g.select("time", "at_risk", "events", F.product(1 - F.col("events") / F.col("at_risk")).over(up).alias("survival"))

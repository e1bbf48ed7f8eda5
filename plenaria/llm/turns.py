"""Conversation structure repair: the cheapest edits that make a conversation alternate, by a fold in Spark SQL functions.

A conversation's turns are taken by turn (nulls first; ties by role, text). Faults come from windows: blank (no character
but white space), duplicate (role and text stood in an earlier turn), truncated (the last character that is no white
space ends no sentence); of several the first named counts. A repaired conversation has role initials
`(s?(ua)+)?`. Edits: keep (K, costs nothing), rerole to user or assistant (R, 1), delete (D, 2; blank and duplicate turns
must go), insert an empty user or assistant turn (I, 5); a truncated turn that stays adds 5. The fold over the sorted
turn structs carries the cheapest (cost, audit) for each of four states: nothing yet, after the system turn, after
a user turn, after an assistant turn. `least` over the structs takes the lower cost and, of equal costs, the audit
that is less in ASCII order. An audit tells the repaired turns: of each state only one role can follow.

Scale: one shuffle moves turns to their conversation; the windows and the collection that follow use its partitioning. Repair is
sequential, so the turns of one conversation stand in one row (as many rows of a hot conversation as it has turns go to one task,
whatever engine folds them); conversations never meet each other. Audits grow with the turns, so a fold over n turns
copies n * n / 2 characters.

Null roles and texts are read as one space; a null conv_id is a conversation, a null turn sorts first and counts in no
gap. Repeated rows are turns of their own (the later one is a duplicate). A conversation none of whose turns are left has
counts of 0, no audit and no repaired turns. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

#: More than any repair costs.
NEVER = 1 << 50
STATES = ("none", "s", "u", "a")
VISIBLE = rf"[^{common.SPACE}]"


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by crc32 of `conv_id:turn`, and gone (the row is dropped; it stays so
    that its conversation does)."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    k = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(k == 1, "").when(k == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    rows = rows.select("conv_id", "turn", F.when(k == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"), (k == 0).alias("gone"), F.when(k == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("times", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times")


def flagged(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, gone) with fault: blank, duplicate, truncated or null."""
    rows = rows.repartition("conv_id")
    body = F.rtrim("text", F.lit(" \t\n\v\f\r"))
    earlier = F.row_number().over(W.partitionBy("conv_id", "gone", "role", F.xxhash64("text"), "text").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = F.when(~F.col("text").rlike(VISIBLE), "blank").when(earlier, "duplicate").when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated")
    return rows.withColumn("fault", fault)


def _add(state: Column, cost, mark: str) -> Column:
    return F.struct((state["cost"] + cost).alias("cost"), F.concat(state["audit"], F.lit(mark)).alias("audit"))


def _inserted(states: Column, c: Costs) -> Column:
    """The states with up to two turns inserted; a third is never cheaper."""
    put = lambda x: _add(x, F.lit(c.insert), "I")  # noqa: E731

    def once(s: Column) -> Column:
        user = F.least(s["u"], put(s["none"]), put(s["s"]), put(s["a"]))
        return F.struct(s["none"].alias("none"), s["s"].alias("s"), user.alias("u"), F.least(s["a"], put(s["u"])).alias("a"))

    return common.let(once(states), once)


def _turn(s: Column, turn: Column, c: Costs) -> Column:
    """The states after one more turn (initial, fault)."""
    gone = lambda x: _add(x, F.lit(c.delete), "D")  # noqa: E731
    stays = F.when(turn["fault"].isin("blank", "duplicate"), F.lit(NEVER)).when(turn["fault"] == "truncated", F.lit(c.truncated)).otherwise(F.lit(0))

    def to(x: Column, role: str) -> Column:
        kept = turn["initial"] == role
        return F.struct((x["cost"] + stays + F.when(kept, 0).otherwise(c.rerole)).alias("cost"), F.concat(x["audit"], F.when(kept, "K").otherwise("R")).alias("audit"))

    system = F.struct((s["none"]["cost"] + stays + F.when(turn["initial"] == "s", 0).otherwise(F.lit(NEVER))).alias("cost"), F.concat(s["none"]["audit"], F.lit("K")).alias("audit"))
    return F.struct(
        gone(s["none"]).alias("none"),
        F.least(gone(s["s"]), system).alias("s"),
        F.least(gone(s["u"]), to(s["none"], "u"), to(s["s"], "u"), to(s["a"], "u")).alias("u"),
        F.least(gone(s["a"]), to(s["u"], "a")).alias("a"),
    )


def cheapest(turns: Column, costs: Costs = Costs()) -> Column:
    """(cost, audit) of the cheapest repair of sorted turn structs (initial, fault)."""
    start = lambda cost: F.struct(F.lit(cost).cast("long").alias("cost"), F.lit("").alias("audit"))  # noqa: E731
    # states that cannot be are more than any repair, and stay so
    zero = F.struct(*[start(0 if k == "none" else NEVER).alias(k) for k in STATES])

    step = lambda state, turn: common.let(_inserted(state, costs), lambda s: _turn(s, turn, costs))  # noqa: E731
    last = lambda state: common.let(_inserted(state, costs), lambda s: F.least(s["none"], s["a"]))  # noqa: E731
    return F.aggregate(turns, zero, step, last)


def repaired(turns: Column, audit: Column) -> Column:
    """The turns (role, text) that an audit makes of sorted turn structs (role, initial, text)."""
    marks = F.regexp_extract_all(F.concat(audit, F.lit("E")), F.lit("(I*[DKRE])"), F.lit(1))
    empty = F.struct(F.lit("I").alias("mark"), F.lit("").alias("role"), F.lit("").alias("text"))
    own = lambda m, t: F.array_repeat(empty, F.length(m) - 1) if t is None else F.concat(F.array_repeat(empty, F.length(m) - 1), F.array(F.struct(F.substring(m, -1, 1).alias("mark"), t["role"].alias("role"), t["text"].alias("text"))))  # noqa: E731
    rows = F.flatten(F.zip_with(F.slice(marks, 1, F.size(turns)), turns, own))
    rows = F.filter(F.concat(rows, own(F.element_at(marks, -1), None)), lambda x: x["mark"] != "D")

    def named(rows: Column) -> Column:
        system = F.when((F.size(rows) > 0) & (F.get(rows, F.lit(0))["mark"] == "K") & F.get(rows, F.lit(0))["role"].startswith("s"), 1).otherwise(0)
        turn = lambda x, k: F.when(x["mark"] == "K", x["role"]).when((k - system) % 2 == 0, "user").otherwise("assistant")  # noqa: E731
        return F.transform(rows, lambda x, k: F.struct(turn(x, k).alias("role"), x["text"].alias("text")))

    return common.let(rows, named)


def repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Of each conv_id of rows (conv_id, turn, role, text, gone): gaps, blank, duplicate, truncated, illegal, cost, audit and
    turns, the repaired (role, text) in order."""
    there = ~F.col("gone")
    each = F.struct("turn", "role", "text", "fault", F.substring("role", 1, 1).alias("initial"))
    n = lambda fault: F.coalesce(F.count_if(there & (F.col("fault") == fault)), F.lit(0)).alias(fault)  # noqa: E731
    at = F.when(there, F.col("turn"))
    found = flagged(rows).groupBy("conv_id").agg(
        F.coalesce(F.max(at) - F.min(at) + 1 - F.size(F.collect_set(at)), F.lit(0)).cast("long").alias("gaps"),
        n("blank"), n("duplicate"), n("truncated"),
        F.sort_array(F.collect_list(F.when(there, each))).alias("all"),
    )  # fmt: skip
    pairs = F.zip_with(F.slice("all", 1, F.greatest(F.size("all") - 1, F.lit(0))), F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))), lambda x, y: ~F.concat(x["initial"], y["initial"]).isin("su", "ua", "au"))
    found = found.withColumn("illegal", F.size(F.filter(pairs, lambda x: x)).cast("long")).withColumn("best", cheapest(F.col("all"), costs))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), repaired(F.col("all"), F.col("best.audit")).alias("turns"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: what is wrong with each damaged conversation, and its cheapest repair."""
    rows = common.pick(common.table(spark, sf_dir, "conversations"), conv_id="conv_id", turn="turn", role="role", text="text")
    out = repair(damage(rows))
    text = F.array_join(F.transform("turns", lambda x: F.concat_ws(":", x["role"], x["text"])), "\n")
    return out.select(*out.columns[:-1], F.sha2(text, 256).alias("repaired_sha256"))


def _sql() -> str:
    """DuckDB: damage, faults, then the four states turn by turn in a recursive query, where the next turn's edits are
    read off a table of moves; inserts are left out, as no cheapest repair has one (a turn next to it goes for less)."""
    crc = "xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1)))), lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)"
    best = lambda to, *moves: f"least({', '.join(moves)}) as {to}"  # noqa: E731
    row = lambda cost, audit: f"{{'cost': {cost}, 'audit': {audit}}}"  # noqa: E731
    gone = lambda s: row(f"{s}.cost + 2", f"{s}.audit || 'D'")  # noqa: E731
    kept = lambda s, r: row(f"{s}.cost + stays + case when initial = '{r}' then 0 else {NEVER if r == 's' else 1} end", f"{s}.audit || case when initial = '{r}' then 'K' else 'R' end")  # noqa: E731
    start = lambda cost: row(f"{cost}::bigint", "''")  # noqa: E731
    return rf"""
        with recursive keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
        crc as materialized (select *, {crc} % 20 as k from keyed),
        damaged as (select conv_id, turn, case when k = 4 then 'user' else role end as role,
            case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text from (select *, unnest(case when k = 0 then [] when k = 3 then [1, 2] else [1] end) as n from crc)),
        numbered as (select *, row_number() over (partition by conv_id, role, text order by turn nulls first) > 1 as earlier, regexp_replace(text, '[ 	-]+$', '') as body from damaged),
        placed as (select *, substr(role, 1, 1) as initial, row_number() over (partition by conv_id order by turn nulls first, role, text, earlier) as i,
            case when body = '' then 'blank' when earlier then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' end as fault from numbered),
        turns as (select *, lag(initial) over (partition by conv_id order by i) || initial as pair, case when fault in ('blank', 'duplicate') then {NEVER} when fault = 'truncated' then 5 else 0 end as stays from placed),
        fold as (
            select conv_id, 0::bigint as pos, {start(0)} as n, {start(NEVER)} as s, {start(NEVER)} as u, {start(NEVER)} as a from (select distinct conv_id from conversations)
            union all
            select f.conv_id, f.pos + 1, {gone('n')} as n, {best('s', gone('s'), kept('n', 's'))}, {best('u', gone('u'), kept('n', 'u'), kept('s', 'u'), kept('a', 'u'))}, {best('a', gone('a'), kept('u', 'a'))}
            from fold f join turns t on t.conv_id is not distinct from f.conv_id and t.i = f.pos + 1),
        ends as (select conv_id, max(pos) as pos from fold group by all),
        told as (select f.conv_id, least(n, a).cost as cost, least(n, a).audit as audit from fold f join ends e on e.conv_id is not distinct from f.conv_id and e.pos = f.pos),
        edits as (select t.conv_id, t.i, t.role, t.text, substr(o.audit, t.i::int, 1) as mark, starts_with(t.role, 's') as system from turns t join told o on o.conv_id is not distinct from t.conv_id),
        left_over as (select *, row_number() over w as k, first(system and mark = 'K') over w as leads from edits where mark <> 'D' window w as (partition by conv_id order by i)),
        texts as (select conv_id, string_agg(case when mark = 'K' then role when (k - case when leads then 1 else 0 end) % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by i) as said from left_over group by all),
        counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
            count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal from turns group by all)
        select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cost, audit, sha256(coalesce(said, '')) as repaired_sha256
        from told o left join counts c on c.conv_id is not distinct from o.conv_id left join texts x on x.conv_id is not distinct from o.conv_id"""


SQL = _sql()

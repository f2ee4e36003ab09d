"""Multi-party perspective rotation: a dialogue as training text, once for every participant.

For a participant, its own turns are rendered as the assistant's, turns of the others as users with their names, and
turns of context roles (`system`) as they are. The masks are the spans that the participant wrote, end mark included;
loss is taken there.

A dialogue of any length is one rendering per participant, in one row, whose limit is that of a Spark string (2 GB).
A caller who needs smaller rows names a size, and every dialogue is then cut by one rule: a turn belongs to the part that
its place in the whole dialogue falls into, a part after the first repeats the context turns that the dialogue begins
with, and a participant has rows for the parts it speaks in.

Turns of dialogues of more than `PART` code points are sorted and placed by range partitions and sums over these, those
of others within their dialogue, which gives the same rows; a task then holds what it renders, a dialogue or a part.

Turns are in order of their number, then role, then the MD5 digest of the text; turns equal in all of them are
interchangeable. Turn numbers need not be dense.

Defined results: null dialogue ids form one dialogue. A null text is empty; a null role is a nameless user and no
participant, a null turn is before all others. A dialogue without participants has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import discard, materialize

PART = 1_000_000  # code points of a dialogue whose turns one task may sort
CONTEXT = ("system",)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ORDER = ("turn", "role", "mark")


def _name(role: Column, context: tuple[str, ...]) -> Column:
    """What a turn of this role is headed by for all who are not its speaker."""
    return F.when(role.isin(*context), role).otherwise(F.concat(F.lit("user"), F.coalesce(F.concat(F.lit(" name="), role), F.lit(""))))


def _turn(name: Column, said: Column) -> Column:
    return F.concat(F.lit(OPEN), name, F.lit("\n"), said, F.lit(CLOSE + "\n"))


def _parts(placed: DataFrame) -> DataFrame:
    return placed.groupBy("key", "part").agg(F.sort_array(F.collect_list(F.struct("at", "own", "role", "body"))).alias("said"))


def _whole(rows: DataFrame) -> DataFrame:
    """Shorter dialogues, placed within themselves; each is one part."""
    order = Window.partitionBy("key").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("at", F.sum("size").over(order) - F.col("size"))
    placed = placed.withColumn("own", F.row_number().over(Window.partitionBy("key", "role").orderBy("at")) - F.lit(1).cast("long"))
    return _parts(placed.withColumn("part", F.lit(0).cast("long"))).withColumn("lead", F.lit(""))


def _spread(rows: DataFrame, context: tuple[str, ...], part: int | None) -> DataFrame:
    """Longer dialogues, whole or in parts. `at` and `own`, the code points and the speaker's turns before a turn, are those within
    its range partition and the sums of the partitions before; a dialogue has one sum per partition and role."""
    stored = materialize(rows, "long-turns")
    # a number from the stored files spreads equal turns over partitions, the same way whenever a task is repeated
    order = [*ORDER, "salt"]
    dealt = stored.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)))
    dealt = dealt.repartitionByRange("key", *order).withColumn("range", F.spark_partition_id())
    dealt = materialize(dealt, "dealt-turns")
    roles = dealt.groupBy("range", "key", "role").agg(F.sum("size").alias("w"), F.count("*").alias("n"))
    roles = materialize(roles.withColumn("turns", F.sum("n").over(Window.partitionBy("key", "role").orderBy("range")) - F.col("n")), "role-sums")
    sums = roles.groupBy("range", "key").agg(F.sum("w").alias("w"))
    sums = sums.withColumn("points", F.sum("w").over(Window.partitionBy("key").orderBy("range")) - F.col("w"))

    within = Window.partitionBy("range", "key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("at", F.sum("size").over(within) - F.col("size"))
    placed = placed.withColumn("own", F.row_number().over(Window.partitionBy("range", "key", "role").orderBy("at")) - 1)
    p, s, r = placed.alias("p"), sums.alias("s"), roles.alias("r")
    same = lambda a, b, *names: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]
    placed = p.join(s, same("p", "s", "range", "key")).join(r, same("p", "r", "range", "key", "role"))
    at = F.col("at") + F.col("points")
    number = F.lit(0).cast("long") if part is None else F.floor(at / part)
    placed = placed.select("p.key", at.alias("at"), (F.col("own") + F.col("turns")).alias("own"), "p.role", "p.body", number.alias("part"))
    discard(stored)
    if part is None:
        return _parts(placed).withColumn("lead", F.lit(""))

    spoken = F.min(F.when(~F.coalesce(F.col("role").isin(*context), F.lit(False)), F.col("at")))
    spoken = placed.where("part = 0").groupBy("key").agg(spoken.alias("spoken")).select(F.col("key").alias("of"), F.coalesce("spoken", F.lit(part)).alias("spoken"))
    opening = placed.where("part = 0").join(spoken, (F.col("key").eqNullSafe(F.col("of"))) & (F.col("at") < F.col("spoken")))
    said = F.sort_array(F.collect_list(F.struct("at", "role", "body")))
    leads = opening.groupBy("of").agg(F.array_join(F.transform(said, lambda t: _turn(t["role"], t["body"])), "").alias("begin"))
    return _parts(placed).join(leads, F.col("key").eqNullSafe(F.col("of")), "left").select("key", "part", "said", F.when(F.col("part") > 0, F.coalesce("begin", F.lit(""))).otherwise("").alias("lead"))


def perspectives(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", context: tuple[str, ...] = CONTEXT, part: int | None = None) -> DataFrame:
    """Whole dialogues, or their parts of about `part` code points: key, speaker, part, start (code points of the speaker's whole rendering before the part), lead (code points that
    repeat the dialogue's first context turns), n_turns (without these), rendered, masks (start and end in code points
    of this row's text; `start - lead` more in the whole rendering)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = turns.select(F.col(key).alias("key"), F.col(turn).alias("turn"), F.col(role).alias("role"), body.alias("body"))
    rows = rows.withColumns({"mark": F.md5("body"), "size": F.length(_turn(_name(F.col("role"), context), F.col("body"))).cast("long")})
    long = materialize(rows.groupBy("key").agg(F.sum("size").alias("w")).where(F.col("w") > (PART if part is None else min(part, PART))).select(F.col("key").alias("of")), "long-dialogues")
    known = F.col("key").eqNullSafe(F.col("of"))
    parts = _whole(rows.join(long, known, "left_anti"))
    if not long.isEmpty():
        parts = parts.unionByName(_spread(rows.join(long, known, "left_semi"), context, part))

    speakers = F.filter(F.array_distinct(F.transform("said", lambda t: t["role"])), lambda r: r.isNotNull() & ~r.isin(*context))
    each = parts.withColumn("speaker", F.explode(speakers))
    speaker, lead = F.col("speaker"), F.col("lead")
    each = each.withColumn("mine", F.filter("said", lambda t: t["role"] == speaker))
    # how much longer a turn is in its speaker's own rendering
    change = F.length(F.lit("assistant")) - F.length(_name(speaker, ()))
    before = F.col("said")[0]["at"] + change * F.col("mine")[0]["own"]
    # names that no result column has, for the lambdas below
    each = each.withColumns({"change": change, "begun": before, "shift": F.length(lead) - before + len(f"{OPEN}assistant\n")})

    def mask(t: Column) -> Column:
        first = t["at"] + F.col("change") * t["own"] + F.col("shift")
        return F.struct(first.alias("start"), (first + F.length(t["body"]) + len(CLOSE)).alias("end"))

    name = lambda t: F.when(t["role"] == speaker, "assistant").otherwise(_name(t["role"], context))
    return each.select(
        F.col("key").alias(key),
        "speaker",
        "part",
        F.col("begun").alias("start"),
        F.length(lead).alias("lead"),
        F.size("said").alias("n_turns"),
        F.concat(lead, F.array_join(F.transform("said", lambda t: _turn(name(t), t["body"])), "")).alias("rendered"),
        F.transform("mine", mask).alias("masks"),
    )

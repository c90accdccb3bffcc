r"""Chat formatting into budgeted windows, with DataFrame functions alone.

Each turn has a token estimate (word runs and single marks, plus ``TURN_TOKENS`` for its markers).  Prefix sums of these
choose turn-aligned spans: a turn belongs to span ``floor((sum - 1) / stride)``, where the stride is half of what the budget
leaves beside the system turn and the history, so a span of turns no longer than the stride never exceeds the budget (a
longer turn stays whole and may make a window of its own).  A window holds

* the leading system turn of the conversation, retained in every window,
* up to ``history_turns`` turns before the span, nearest first while they fit ``history_tokens``, repeated as context,
* the turns of the span.

Only assistant turns of the span itself are targets: the loss mask leaves out whatever is repeated, so each target counts
once over all windows.

Template: ``<s>`` opens a window; turns are ``[SYS] x [/SYS]``, ``[INST] x [/INST]``, ``[ASST] x </s>`` and, for any other
role, ``[ROLE hex] x [/ROLE]``.  A control string inside a text gets one backslash after its first character (one more, if
it has some there already), which the reader takes off again, so texts come back as they were.

A conversation is one sorted run of one task in the window functions, which spill; arrays are only built for windows, whose
size the budget bounds.  Defined cases: a null text or role is an empty one; rows are ordered by turn (nulls first), ties by
role and text, and repeated rows are turns of their own; rows with a null conv_id form one conversation; other columns are
ignored; an empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
TURN_TOKENS = 4

#: What counts as one token in the estimate.
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
ANGLE, BRACKET = r"<(\\*)(/?s)>", r"\[(\\*)(/?(?:SYS|INST|ASST|ROLE)[^\[\]]*)\]"
_TURN = r"(?s)\[(?:SYS|INST|ASST|ROLE [0-9A-F]*)\] .*? (?:\[/(?:SYS|INST|ROLE)\]|</s>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, ANGLE, r"<\\$1$2>"), BRACKET, r"[\\$1$2]")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"<\\(\\*)(/?s)>", "<$1$2>"), r"\[\\(\\*)(/?(?:SYS|INST|ASST|ROLE)[^\[\]]*)\]", "[$1$2]")


def _marks(role: Column) -> tuple[Column, Column]:
    opening = F.when(role == "system", "[SYS] ").when(role == "user", "[INST] ").when(role == "assistant", "[ASST] ").otherwise(F.concat(F.lit("[ROLE "), F.hex(F.encode(role, "UTF-8")), F.lit("] ")))
    return opening, F.when(role == "system", " [/SYS]").when(role == "user", " [/INST]").when(role == "assistant", " </s>").otherwise(" [/ROLE]")


def spans(turns: DataFrame, *, budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """(conv_id, pos, role, text, span, head, repeats): each turn with its span and the later spans that repeat it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", (F.regexp_count("text", F.lit(TOKEN)) + TURN_TOKENS).cast("long"))
    rows = rows.select("*", F.row_number().over(order).alias("pos"), F.sum("tokens").over(run).alias("total"), F.first(F.when(F.col("role") == "system", F.struct("text", "tokens"))).over(run).alias("head"))
    head = F.coalesce(F.col("head.tokens"), F.lit(0))
    stride = F.greatest(F.floor((F.lit(budget - history_tokens) - head) / 2), F.lit(1))
    is_head = F.col("head").isNotNull() & (F.col("pos") == 1)
    rows = rows.withColumn("own", F.when(~is_head, F.floor((F.col("total") - head - 1) / stride)))
    after = [F.lead("own", j).over(order) for j in range(1, history_turns + 1)]
    sums = [F.col("total"), *(F.lead("total", j).over(order) for j in range(1, history_turns))]
    rows = rows.select("conv_id", "pos", "role", "text", "head", "tokens", "total", "own", *(c.alias(f"after{j}") for j, c in enumerate(after, 1)), *(c.alias(f"sum{j}") for j, c in enumerate(sums, 1)))
    repeats = []
    for j in range(1, history_turns + 1):
        before = F.col("own") if j == 1 else F.col(f"after{j - 1}")
        fits = F.col(f"sum{j}") - (F.col("total") - F.col("tokens")) <= history_tokens
        repeats.append(F.when((F.col(f"after{j}") != before) & fits, F.col(f"after{j}")))
    return rows.select("conv_id", "pos", "role", "text", F.coalesce("own", "after1" if history_turns else F.lit(None), F.lit(0)).alias("span"), "head", F.when(F.col("own").isNull(), F.array().cast("array<bigint>")).otherwise(F.array_compact(F.array(*repeats)) if repeats else F.array().cast("array<bigint>")).alias("repeats"))


def windows(turns: DataFrame, *, budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """(conv_id, window, text, n_repeated, mask): formatted windows; mask: code-point spans of the targets, end exclusive;
    n_repeated: how many turns at the beginning are repeated."""
    placed = spans(turns, budget=budget, history_turns=max(1, history_turns), history_tokens=history_tokens if history_turns else -1)
    copies = F.concat(F.array(F.struct(F.col("span").alias("window"), F.lit(False).alias("again"))), F.transform("repeats", lambda s: F.struct(s.alias("window"), F.lit(True).alias("again"))))
    rows = placed.select("conv_id", "pos", "role", "text", "head", F.inline(copies))
    turn = F.struct("pos", "again", "role", "text")
    grouped = rows.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.max("head.text").alias("head"), F.min("pos").alias("first"))
    retained = F.array(F.struct(F.lit(1).alias("pos"), F.lit(True).alias("again"), F.lit("system").alias("role"), F.col("head").alias("text")))
    grouped = grouped.withColumn("turns", F.when(F.col("head").isNotNull() & (F.col("first") > 1), F.concat(retained, "turns")).otherwise(F.col("turns")))

    def piece(t: Column) -> Column:
        opening, closing = _marks(t["role"])
        return F.struct(opening.alias("opening"), escaped(t["text"]).alias("body"), closing.alias("closing"), (~t["again"] & (t["role"] == "assistant")).alias("target"))

    grouped = grouped.withColumn("pieces", F.transform("turns", piece))

    def place(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["opening"])
        end = start + F.length(p["body"])
        return F.struct((end + F.length(p["closing"])).alias("at"), F.when(p["target"], F.concat(state["mask"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(state["mask"]).alias("mask"))

    zero = F.struct(F.lit(3).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))
    text = F.concat(F.lit("<s>"), F.array_join(F.transform("pieces", lambda p: F.concat(p["opening"], p["body"], p["closing"])), ""))
    return grouped.select("conv_id", "window", text.alias("text"), F.size(F.filter("turns", lambda t: t["again"])).alias("n_repeated"), F.aggregate("pieces", zero, place)["mask"].alias("mask"))


def read_turns(text: Column) -> Column:
    """The turns of a formatted window: array<struct<role, text>>."""

    def turn(s: Column) -> Column:
        name = F.regexp_extract(s, r"^\[([A-Z]+)", 1)
        role = F.when(name == "SYS", "system").when(name == "INST", "user").when(name == "ASST", "assistant").otherwise(F.decode(F.unhex(F.regexp_extract(s, r"^\[ROLE ([0-9A-F]*)\]", 1)), "UTF-8"))
        skip = F.locate("] ", s) + 1
        closing = F.when(name == "SYS", 7).when(name == "INST", 8).when(name == "ASST", 5).otherwise(8)
        return F.struct(role.alias("role"), unescaped(F.substring(s, skip + 1, F.length(s) - skip - closing)).alias("text"))

    return F.transform(F.regexp_extract_all(text, F.lit(_TURN), F.lit(0)), turn)


def targets(text: Column, mask: Column) -> Column:
    """The unescaped texts under the mask, in order."""
    return F.transform(mask, lambda m: unescaped(F.substring(text, m["start"] + 1, m["end"] - m["start"])))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the windows hold, read back from them, for each conversation."""
    turns = read_turns(F.col("text"))
    own = F.slice(turns, F.col("n_repeated") + 1, F.greatest(F.size(turns) - F.col("n_repeated"), F.lit(0)))
    read = formatted.select("conv_id", "window", F.length("text").cast("long").alias("chars"), own.alias("own"), F.array_join(targets(F.col("text"), F.col("mask")), "").alias("loss"))
    read = read.select("conv_id", F.struct("window", F.array_join(F.transform("own", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"), "loss").alias("part"), F.size("own").cast("long").alias("n"), "chars")
    whole = read.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    joined = lambda f: F.array_join(F.transform("parts", lambda p: p[f]), "")
    return whole.select("conv_id", "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"), F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars")

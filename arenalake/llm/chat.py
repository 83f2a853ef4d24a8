r"""Chat formatting in budgeted, turn-aligned windows, with Spark functions only.

Prefix sums of turn tokens deal a conversation's turns into spans: a new span starts where the sum passes
the next multiple of a stride, and around turns longer than the stride. Each span becomes one window: the
system turn again (if the span does not hold it), up to HISTORY turns before the span as far as they fit
their budget, then the span's own turns. Only own assistant texts are targets, so a repeated turn is never
trained on twice: the loss spans of all windows hold each assistant text once.

With stride = budget / 4 a window's new turns stay under half the budget and its history under a quarter; a
window exceeds the budget only where a single turn or the system turn does. Texts are never cut.

Template: `<|im_start|>role\ntext<|im_end|>\n`. Inside roles and texts `\` is doubled and every control string
gets a `\` after its first character, as does a line feed in a role; dropping each `\` before any character
gives the text back.

Defined cases: NULL text or role is empty; turns are ordered by turn, role, text (NULL first), ties and
repeated rows all kept; a NULL conv_id is a conversation of its own; columns besides conv_id, turn, role and
text are ignored; an empty table gives an empty result. One exchange by conversation serves every step; a
conversation's turns meet in one task but are streamed through windows, not gathered, until its digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 2048
HISTORY = 2
START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates.
CONTROL = (
    "<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>",
    "[SYSTEM_PROMPT]", "[/SYSTEM_PROMPT]", "<pad>", "<unk>", "<bos>", "<eos>",
)
_CONTROL = "|".join(rf"(?<=\Q{c[0]}\E)(?=\Q{c[1:]}\E)" for c in CONTROL)


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tokens(text: Column) -> Column:
    """Budget measure of a text: a token per four characters, at least one."""
    return F.greatest(F.ceil(F.length(text) / 4), F.lit(1)).cast("long")


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, text, loss_spans, n_repeated, n_turns) per window; spans are in characters of `text`."""
    stride = max(1, budget // 4)
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = tokens(F.col("text"))
    sums = (
        turns.withColumn("n", F.row_number().over(by))
        .withColumn("size", size)
        .withColumn("before", F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    )
    order = Window.partitionBy("conv_id").orderBy("n")
    block = F.floor(F.col("before") / stride)
    long_turn = F.col("size") > stride
    new_span = F.coalesce(
        (block != F.lag(block).over(order)) | long_turn | F.lag(long_turn).over(order), F.lit(True)
    )
    spans = sums.withColumn("window", F.sum(new_span.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)

    # The later windows a turn is repeated in: those that start within the next `history` turns.
    nexts = []
    for k in range(1, history + 1):
        to = F.lead("window", k).over(order)
        starts = to != F.lead("window", k - 1).over(order) if k > 1 else to != F.col("window")
        fits = F.sum("size").over(order.rowsBetween(0, k - 1)) <= stride
        nexts.append(F.when(starts & fits, to))
    first = Window.partitionBy("conv_id")
    spans = spans.withColumn("later", F.array_distinct(F.array_compact(F.array(*nexts)))).withColumn(
        "count", F.max("window").over(first)
    )
    is_system = (F.col("n") == 1) & (F.col("role") == "system")
    others = F.when(F.col("count") > 0, F.sequence(F.lit(1), F.col("count"))).otherwise(F.array().cast("array<int>"))
    repeated = F.when(is_system, others).otherwise(F.col("later"))
    placed = spans.select(
        "conv_id", "n", "role", "text", F.col("window").alias("own"),
        F.explode(F.concat(F.array(F.col("window")), repeated)).alias("window"),
    )
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    body = escape(F.col("text"))
    pieces = placed.select(
        "conv_id", "window", "n", (F.col("own") != F.col("window")).alias("again"),
        (F.col("role") == "assistant").alias("target"), head.alias("head"), body.alias("body"),
    ).withColumn("length", F.length("head") + F.length("body") + len(END) + 1)
    inside = Window.partitionBy("conv_id", "window").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    offset = F.sum("length").over(inside) - F.col("length") + F.length("head")
    loss = F.when(
        F.col("target") & ~F.col("again"),
        F.struct(F.col("offset").cast("long").alias("start"), (F.col("offset") + F.length("body")).cast("long").alias("end")),
    )
    parts = F.array_sort(F.collect_list(F.struct("n", "head", "body", "loss", "again")))
    return (
        pieces.withColumn("offset", offset).withColumn("loss", loss)
        .groupBy("conv_id", "window").agg(parts.alias("parts"))
        .select(
            "conv_id", "window",
            F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), "").alias("text"),
            F.array_compact(F.transform("parts", lambda p: p["loss"])).alias("loss_spans"),
            F.size(F.filter("parts", lambda p: p["again"])).alias("n_repeated"),
            F.size("parts").alias("n_turns"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows hold: turns, their digest, the text under the loss mask and its digest.

    Everything is parsed from `text`; repeated turns lead each window and are skipped.
    """
    turn = r"(?s)((?:[^\\\n]|\\.)*)\n(.*)\Q" + END + r"\E\n"
    one = lambda part: F.concat(
        unescape(F.regexp_extract(part, turn, 1)), F.lit("\n"), unescape(F.regexp_extract(part, turn, 2)), F.lit("\n")
    )
    told = F.split("text", r"\Q" + START + r"\E")
    own = F.slice(told, F.col("n_repeated") + 2, F.col("n_turns"))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring("text", s["start"] + 1, s["end"] - s["start"])))
    rows = formatted.select(
        "conv_id", "window", F.array_join(F.transform(own, one), "").alias("turns"),
        (F.col("n_turns") - F.col("n_repeated")).alias("own"), F.array_join(masked, "").alias("loss"),
        F.length("text").alias("chars"),
    )
    joined = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    digest = lambda text: F.lower(F.sha2(text.cast("binary"), 256))
    return (
        rows.groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"),
            F.sum("own").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
            F.count(F.lit(1)).alias("n_windows"),
        )
        .select(
            "conv_id", "n_turns", digest(joined("turns")).alias("turns_sha256"),
            F.length(joined("loss")).cast("long").alias("loss_chars"), digest(joined("loss")).alias("loss_sha256"),
            "formatted_chars", "n_windows",
        )
    )

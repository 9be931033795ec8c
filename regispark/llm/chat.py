"""Chat formatting with DataFrame functions: conversations to one marked text each, and back.

The turns of a conversation are collected as structs and sorted; runs of the same role become one
turn. Every turn is ``<|im_start|>role`` line feed, text, ``<|im_end|>`` line feed; texts joined
into one turn stay apart by ``<|im_sep|>``. Control strings inside roles and texts get a backslash
after their first character, and backslashes are doubled, so no marker is ever read from a text
and every text comes back as it was. A line feed in a role is a backslash and ``l``, which no control
string has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of this and other widespread templates, as a pattern (fixed values).
CONTROL = r"(<)(\|[^|<>]*\|>|/?s>|/?SYS>>|</?SYS>>|/?unk>|pad>|start_of_turn>|end_of_turn>)|(\[)(/?INST\])"
START, END, APART = "<|im_start|>", "<|im_end|>", "<|im_sep|>"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1$3\\$2$4")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\l"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\l", "$1\\\\\n"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _length(text: Column) -> Column:
    return F.length(text).cast("bigint")


def formatted(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``id``, ``formatted`` and ``loss``, an array of ``(start, length)``
    spans, in code points from 0, of what a model is trained on: the texts of the assistant;
    ``loss_bytes`` has them in bytes of UTF-8.

    Null texts and roles are empty. Rows with null ids form one conversation. Rows go by turn, nulls
    first, then by role and text; repeated rows stay. A conversation is one output value, so it
    is the unit that one task holds.
    """
    rows = turns.select(
        F.col(id).alias("id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    gathered = rows.groupBy("id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    # Runs of one role, found from the places where the role changes.
    starts = F.filter(
        F.sequence(F.lit(0), F.size("rows") - 1),
        lambda i: F.coalesce(F.get("rows", i)["role"] != F.get("rows", i - 1)["role"], F.lit(True)),
    )
    gathered = gathered.withColumn("starts", starts)
    runs = F.transform(
        "starts",
        lambda s, k: F.slice("rows", s + 1, F.coalesce(F.get("starts", k + 1), F.size("rows")) - s),
    )
    merged = F.transform(
        "runs",
        lambda run: F.struct(
            F.concat(F.lit(START), escaped_role(F.get(run, F.lit(0))["role"]), F.lit("\n")).alias("head"),
            F.transform(run, lambda x: escaped(x["text"])).alias("texts"),
            (F.get(run, F.lit(0))["role"] == TRAINED).alias("trained"),
        ),
    )
    gathered = gathered.withColumn("runs", runs).withColumn("merged", merged)
    # Pieces in order, each with its text and whether it is trained on.
    pieces = F.flatten(
        F.transform(
            "merged",
            lambda t: F.concat(
                F.array(F.struct(t["head"].alias("text"), F.lit(False).alias("trained"))),
                F.flatten(
                    F.transform(
                        t["texts"],
                        lambda x, k: F.concat(
                            F.when(k > 0, F.array(F.struct(F.lit(APART).alias("text"), F.lit(False).alias("trained"))))
                            .otherwise(F.slice(F.array(F.struct(F.lit("").alias("text"), F.lit(False).alias("trained"))), 1, 0)),
                            F.array(F.struct(x.alias("text"), t["trained"].alias("trained"))),
                        ),
                    )
                ),
                F.array(F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("trained"))),
            ),
        )
    )
    gathered = gathered.withColumn("pieces", pieces)
    sizes = F.transform(
        "pieces",
        lambda p: F.struct(
            _length(p["text"]).alias("length"), F.octet_length(p["text"]).cast("bigint").alias("bytes"), p["trained"].alias("trained")
        ),
    )
    gathered = gathered.withColumn("sizes", sizes)
    return gathered.select(
        F.col("id").alias(id),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        _spans("length").alias("loss"),
        _spans("bytes").alias("loss_bytes"),
    )


def _spans(unit: str) -> Column:
    """``(start, length)`` of the trained ones of ``sizes``.

    A fold that appends to an array copies it every time, so the sizes go in runs of about the square root
    of their number, each from the sum of the runs before.
    """
    none = F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")
    width = F.greatest(F.ceil(F.sqrt(F.size("sizes"))), F.lit(1)).cast("int")
    firsts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("sizes") / width) - 1, F.lit(0)).cast("int"))
    runs = F.transform(firsts, lambda k: F.slice("sizes", k * width + 1, width))
    zero = F.lit(0).cast("bigint")
    placed = F.aggregate(
        runs,
        F.struct(zero.alias("at"), F.expr("cast(array() as array<bigint>)").alias("begins")),
        lambda a, run: F.struct(
            (a["at"] + F.aggregate(run, zero, lambda n, x: n + x[unit])).alias("at"),
            F.concat(a["begins"], F.array(a["at"])).alias("begins"),
        ),
        lambda a: a["begins"],
    )

    def of_run(both: Column) -> Column:
        return F.aggregate(
            both["run"],
            F.struct(both["begin"].alias("at"), none.alias("spans")),
            lambda a, x: F.struct(
                (a["at"] + x[unit]).alias("at"),
                F.when(x["trained"], F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), x[unit].alias("length")))))
                .otherwise(a["spans"])
                .alias("spans"),
            ),
            lambda a: a["spans"],
        )

    return F.flatten(F.transform(F.arrays_zip(runs.alias("run"), placed.alias("begin")), of_run))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns``, an array of ``(role, texts)``, read from ``formatted``."""
    marked = F.split("formatted", r"<\|im_start\|>")
    marked = F.slice(marked, F.lit(2), F.size(marked) - 1)
    turns = F.transform(
        marked,
        lambda m: F.struct(
            unescaped_role(F.substring_index(m, "\n", 1)).alias("role"),
            F.transform(
                F.split(F.regexp_replace(F.regexp_replace(m, r"^[^\n]*\n", ""), r"<\|im_end\|>\n\z", ""), r"<\|im_sep\|>"),
                unescaped,
            ).alias("texts"),
        ),
    )
    return chats.withColumn("turns", turns)


def digests(chats: DataFrame, id: str = "conv_id") -> DataFrame:
    """What formatted conversations hold, read back from them: every row's role and text, and all
    text under the loss mask."""
    rows = F.flatten(F.transform("turns", lambda t: F.transform(t["texts"], lambda x: F.concat(t["role"], F.lit("\n"), x, F.lit("\n")))))
    back = read_back(chats).select(id, "formatted", rows.alias("rows"), F.col("formatted").cast("binary").alias("raw"), "loss_bytes")
    # A generator, so that the bytes are made once and not again for every span.
    back = back.select(id, "formatted", "rows", "loss_bytes", F.inline(F.array(F.struct("raw"))))
    trained = F.array_join(
        F.transform(
            "loss_bytes",
            lambda s: unescaped(F.decode(F.substring(F.col("raw"), s["start"].cast("int") + 1, s["length"].cast("int")), "UTF-8")),
        ),
        "",
    )
    back = back.select(id, "formatted", "rows", trained.alias("trained"))
    return back.select(
        id,
        F.size("rows").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("rows", ""), 256).alias("turns_sha256"),
        _length(F.col("trained")).alias("loss_chars"),
        F.sha2(F.col("trained"), 256).alias("loss_sha256"),
        _length(F.col("formatted")).alias("formatted_chars"),
    )

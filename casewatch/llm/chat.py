"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted by turn, then role, then text. Runs of
one role become one block that keeps its texts apart, and the blocks are concatenated:

    <|turn|>role<|text|>text<|next|>text<|end|>

Control strings, own and foreign, are broken inside roles and texts by a backslash after their
first character, and backslashes are doubled first, so that ``parse_chat`` gives back every turn.

Cases: a null role or text is empty; turns without ``conv_id`` form one conversation; repeated
rows are turns of their own; an empty table gives no conversation; further columns are ignored. A
conversation is one row of the result, so its turns must fit a task, however few others it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"
#: Strings that mean something to this template or to common others; none holds a backslash.
CONTROL = (
    TURN, TEXT, NEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>",
)


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chat(turns: DataFrame, learned_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, pieces (the text in pieces, each under the loss mask or not) and loss_mask.

    The mask says where in ``formatted`` the learned texts lie: start, from 0, and length in characters.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    starts = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (i == 1) | (F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]),
    )
    grouped = grouped.withColumn("starts", starts)

    def block(start: Column, k: Column) -> Column:
        following = F.coalesce(F.get("starts", k + 1), F.size("turns") + 1)
        run = F.slice("turns", start, following - start)
        return F.struct(F.element_at(run, 1)["role"].alias("role"), F.transform(run, lambda t: t["text"]).alias("texts"))

    def pieces(b: Column) -> Column:
        plain = lambda text: F.struct(text.alias("text"), F.lit(False).alias("loss"))
        learned = b["role"].isin(*learned_roles)
        texts = F.transform(
            b["texts"],
            lambda t, i: F.array(plain(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT))), F.struct(escape(t).alias("text"), learned.alias("loss"))),
        )
        return F.concat(F.array(plain(F.concat(F.lit(TURN), escape(b["role"]), F.lit(TEXT)))), F.flatten(texts), F.array(plain(F.lit(END))))

    blocks = grouped.select("conv_id", F.transform("starts", block).alias("blocks"))
    made = blocks.select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    nothing = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def put(so_far: Column, piece: Column) -> Column:
        length = F.char_length(piece["text"])
        span = F.array(F.struct(so_far["end"].alias("start"), length.alias("length")))
        return F.struct((so_far["end"] + length).alias("end"), F.when(piece["loss"], F.concat(so_far["spans"], span)).otherwise(so_far["spans"]).alias("spans"))

    mask = F.aggregate("pieces", nothing, put, lambda done: done["spans"])
    return made.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), "pieces", mask.alias("loss_mask"))


def learned_text(formatted: Column, loss_mask: Column) -> Column:
    """The unescaped text under the mask, cut from the formatted text."""
    return F.array_join(F.transform(loss_mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def parse_chat(formatted: Column) -> Column:
    """Array of (role, text), one per turn, read from a formatted conversation."""
    quoted = lambda s: "".join(f"[{c}]" for c in s)
    blocks = F.filter(F.split(formatted, quoted(TURN)), lambda b: b != "")

    def turns(b: Column) -> Column:
        halves = F.split(b, quoted(TEXT))
        texts = F.split(F.replace(F.element_at(halves, 2), F.lit(END), F.lit("")), quoted(NEXT))
        return F.transform(texts, lambda t: F.struct(unescape(F.element_at(halves, 1)).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def op10(spark, sf_dir: str) -> DataFrame:
    from casewatch.llm.common import table

    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"
    )
    done = format_chat(table(spark, sf_dir, "conversations").select(extra.columns).unionByName(extra))
    done = done.withColumn("turns", parse_chat(F.col("formatted")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = learned_text(F.col("formatted"), F.col("loss_mask"))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escaped(column: str) -> str:
    sql = f"replace({column}, '\\', '\\\\')"
    for control in CONTROL:
        sql = f"replace({sql}, '{control}', '{control[0]}\\{control[1:]}')"
    return sql


OP10_SQL = f"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed as (
    select *, lag(role) over (partition by conv_id order by turn, role, text) is distinct from role as opens from rows
)
select conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(length({_sql_escaped('text')}) + case when opens
        then {len(TURN + TEXT + END)} + length({_sql_escaped('role')}) else {len(NEXT)} end) as bigint) as formatted_chars
from placed group by conv_id
"""

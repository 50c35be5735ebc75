"""Chat formatting with Spark expressions only.

One conversation becomes one string. Its turns are collected as structs, sorted
by ``turn`` (then role and text, so repeated rows and ties have one order), and
adjacent turns of the same role are merged into one block::

    ### user:
    first text<turn/>second text</turn>
    ### assistant:
    an answer</turn>

Inside texts a backslash is doubled, and a backslash is put into ``</turn>`` and
``<turn/>`` after the ``<``; inside roles it follows a colon that stands before
a line end, and ``</turn>`` and ``<turn/>`` are escaped too. So no control
string can come from a text, and removing one backslash before any character
gives the text back (``parse``). ``loss_spans`` holds the place of each
assistant text (escaped, in code points from 0): the loss mask. Block heads,
separators and ends are never under it.

Cost is in proportion to a conversation's length: the string is one join of its
pieces, the places of the spans are sums over runs of ``RUN`` pieces and then within
each run, and loss texts are cut from the string by way of ever smaller parts of
it. A conversation is one output value, so its turns meet
in one row by contract; different conversations never do.

Defined results: null text and null role are empty strings; a null turn sorts
first; repeated rows are turns of their own; a null id is one conversation; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END, JOIN = "</turn>", "<turn/>"
RUN = 128                       # array items that are worked on one after the other
PARTS = (4096, 64)              # spans of the parts by which a string is cut


def _escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(END), F.lit("<\\/turn>"))
    return F.replace(text, F.lit(JOIN), F.lit("<\\turn/>"))


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(_escape(role), F.lit(":\n"), F.lit(":\\\n"))


def _starts(turns: Column) -> Column:
    """Places (from 1) of the turns that begin a block."""
    return F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (
        F.element_at(turns, i)["role"] != F.element_at(turns, F.greatest(i - 1, F.lit(1)))["role"]))


def _merged(turns: Column, starts: Column) -> Column:
    """Sorted turns -> blocks of adjacent same-role turns: array<struct<role, texts>>."""
    return F.transform(starts, lambda s, j: F.struct(
        F.element_at(turns, s)["role"].alias("role"),
        F.transform(F.slice(turns, s, F.coalesce(F.get(starts, j + 1), F.size(turns) + 1) - s), lambda t: t["text"]).alias("texts")))


def _sums_before(numbers: Column, first: Column) -> Column:
    """For each number of a short array, ``first`` plus the sum of those before it."""
    return F.aggregate(
        numbers, F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"])


def _in_runs(array: Column, n: int) -> Column:
    """An array as an array of arrays of ``n`` items; of none if it is empty."""
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)), F.lit(n)), lambda i: F.slice(array, i + 1, n))
    return F.filter(runs, lambda r: F.size(r) > 0)


def format_chats(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row a conversation: id, ``formatted``, ``loss_spans`` (array of start, length)."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sorted_turns = rows.groupBy(F.col(id_col)).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # Columns that a lambda reads stay steps of their own: they are computed once a row.
    sorted_turns = sorted_turns.withColumn("starts", _starts(F.col("turns")))
    blocks = sorted_turns.select(id_col, _merged(F.col("turns"), F.col("starts")).alias("blocks"))
    piece = lambda s, loss: F.struct(s.alias("s"), loss.alias("loss"))
    no = F.lit(False)

    def pieces(b):
        texts = F.transform(b["texts"], lambda t, i: F.array(
            piece(F.when(i == 0, F.lit("")).otherwise(F.lit(JOIN)), no),
            piece(_escape(t), b["role"] == loss_role)))
        return F.concat(F.array(piece(F.concat(F.lit("### "), _escape_role(b["role"]), F.lit(":\n")), no)),
                        F.flatten(texts), F.array(piece(F.lit(END + "\n"), no)))

    parts = blocks.select(id_col, F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    parts = parts.withColumn("lengths", F.transform("pieces", lambda p: F.length(p["s"]).cast("long")))
    parts = parts.withColumn("runs", _in_runs(F.col("lengths"), RUN))
    parts = parts.withColumn("bases", _sums_before(
        F.transform("runs", lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0).cast("long")))
    places = F.flatten(F.zip_with("runs", "bases", _sums_before))
    spans = F.filter(F.zip_with("pieces", places, lambda p, at: F.when(p["loss"], F.struct(
        at.alias("start"), F.length(p["s"]).cast("long").alias("length")))), lambda x: x.isNotNull())
    return parts.select(id_col, F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"),
                        spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns read back from a formatted string: array<struct<role, text>>."""
    blocks = F.split(formatted, END + "\n")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block):
        head = F.substring_index(block, ":\n", 1)
        role = _unescape(F.substr(head, F.lit(5)))
        texts = F.split(F.substr(block, F.length(head) + 3), JOIN)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), _unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    piece = lambda text, base, s: F.substr(text, (s["start"] - base + 1).cast("int"), s["length"].cast("int"))
    parts = F.array(F.struct(formatted.alias("text"), F.lit(0).cast("long").alias("base"), spans.alias("spans")))

    def smaller(n: int):
        def cut(part):
            return F.transform(_in_runs(part["spans"], n), lambda run: F.struct(
                piece(part["text"], part["base"], F.struct(
                    F.get(run, F.lit(0))["start"].alias("start"),
                    (F.element_at(run, -1)["start"] + F.element_at(run, -1)["length"] - F.get(run, F.lit(0))["start"])
                    .alias("length"))).alias("text"),
                F.get(run, F.lit(0))["start"].alias("base"), run.alias("spans")))
        return cut

    for n in PARTS:
        parts = F.flatten(F.transform(parts, smaller(n)))
    texts = F.flatten(F.transform(parts, lambda p: F.transform(p["spans"], lambda s: _unescape(piece(p["text"], p["base"], s)))))
    return F.array_join(texts, "")

"""Chat formatting with prefix-target expansion.

A turn is written `<|turn|>role<|says|>text<|end|>`, a conversation as its turns one after the
other. Control strings inside roles and texts are escaped with a backslash, reversibly, so
that no text can open or close a turn. Every assistant turn makes an example of its own:
the context is everything before the reply, and only the reply is trainable. As all
examples of a conversation are beginnings of the same formatted text, an example is kept as
where its reply begins and ends in that text: the expansion (`expanded`) holds each turn once and a row per example,
so the number of rows and bytes stays that of the input, however long a conversation is. The query reads its
results back from the expansion alone: turns by the marks in the formatted text, wherever it is cut, and replies under the
examples' masks. `example_pieces` writes chosen examples out with their contexts.

Turns come in the order of `turn` (null first), equal ones by role and text, repeated rows as
often as they occur. Null text and null role read as empty. Null ids are one conversation.
A conversation without an assistant turn has no example. Input columns beyond the four that are
named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
# What texts may not contain literally: the start of the marks above, and the marks of other
# common templates, which a model may have learnt as control strings.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
TRAINED_ROLE = "assistant"

BLOCK_TURNS = 64
ADDED_CONVERSATION = (-1, ("user", "assistant"), "</s>[INST] ok [/INST]")


def escaped(text: Column) -> Column:
    """Backslashes are doubled; then a single one goes behind the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def unescaped(text: str) -> str:
    """After doubling, single backslashes are only those that were put into control strings."""
    for mark in CONTROL:
        text = text.replace(f"{mark[0]}\\{mark[1:]}", mark)
    return text.replace("\\\\", "\\")


def formatted_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> (conv_id, turn, block, piece, reply_from, piece_chars, trainable).

    `piece` is the formatted turn, and the reply within it is `[reply_from, piece_chars - len(END))`.
    """
    role = escaped(F.coalesce("role", F.lit("")))
    text = escaped(F.coalesce("text", F.lit("")))
    opening = F.concat(F.lit(TURN), role, F.lit(SAYS))
    return conversations.select(
        "conv_id",
        "turn",
        F.floor(F.col("turn") / F.lit(BLOCK_TURNS)).alias("block"),
        F.concat(opening, text, F.lit(END)).alias("piece"),
        F.length(opening).cast("long").alias("reply_from"),
        (F.length(opening) + F.length(text) + len(END)).cast("long").alias("piece_chars"),
        (F.coalesce("role", F.lit("")) == TRAINED_ROLE).alias("trainable"),
    )


def placed_turns(turns: DataFrame) -> DataFrame:
    """Formatted turns -> the same with `starts`, the code points of the conversation before each.

    A prefix sum in two steps, blocks of turns and turns within a block, so that a window
    never holds more than a block of a long conversation.
    """
    turns = turns.withColumn("place", F.struct("conv_id", "block"))
    blocks = turns.groupBy("place").agg(F.sum("piece_chars").alias("block_chars"))
    before = Window.partitionBy("place.conv_id").orderBy(F.asc_nulls_first("place.block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("place", F.coalesce(F.sum("block_chars").over(before), F.lit(0)).alias("block_starts"))
    within = Window.partitionBy("place").orderBy(F.asc_nulls_first("turn"), F.asc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    running = turns.withColumn("starts", F.coalesce(F.sum("piece_chars").over(within), F.lit(0)))
    starts = (F.col("starts") + F.col("block_starts")).alias("starts")
    return running.join(blocks, "place").select(*[c for c in turns.columns if c != "place"], starts)


def expanded(placed: DataFrame) -> DataFrame:
    """Placed turns -> (conv_id, at, piece, reply_chars, example_chars), the output: formatted text and examples.

    A row with a `piece` is formatted text from place `at` of its conversation on. A row without is an example, one per assistant turn:
    its context is all formatted text before `at`, its target the `reply_chars` behind, the only ones under its loss mask, and
    it ends after `example_chars`. In the order of `at` an example follows the turn it ends with.
    """
    none = F.lit(None)
    turn = F.struct(F.col("starts").alias("at"), "piece", none.cast("long").alias("reply_chars"), none.cast("long").alias("example_chars"))
    example = F.struct(
        (F.col("starts") + F.col("reply_from")).alias("at"),
        none.cast("string").alias("piece"),
        (F.col("piece_chars") - F.col("reply_from") - len(END)).alias("reply_chars"),
        (F.col("starts") + F.col("piece_chars")).alias("example_chars"),
    )
    return placed.select("conv_id", F.inline(F.when(F.col("trainable"), F.array(turn, example)).otherwise(F.array(turn))))


def examples(placed: DataFrame) -> DataFrame:
    """Placed turns -> (conv_id, context_chars, reply_chars, example_chars), a row per assistant turn.

    The example is the first `example_chars` code points of the conversation's formatted text; its loss
    mask is the `reply_chars` behind the first `context_chars`; the mark that ends the turn follows.
    """
    rows = expanded(placed).where("example_chars is not null")
    return rows.select("conv_id", F.col("at").alias("context_chars"), "reply_chars", "example_chars")


def example_pieces(placed: DataFrame, chosen: DataFrame) -> DataFrame:
    """Write examples out -> (conv_id, context_chars, starts, piece, trainable), in pieces.

    A piece per turn and example: the turns up to the reply, and only the last is trainable. The size is
    that of the expansion, so choose the examples first.
    """
    wanted = chosen.select(F.col("conv_id").alias("e_conv"), "context_chars", "example_chars")
    both = F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("starts") < F.col("example_chars"))
    last = F.col("starts") + F.col("piece_chars") == F.col("example_chars")
    return placed.join(wanted, both).select("conv_id", "context_chars", "starts", "piece", last.alias("trainable"))


PARSED = re.compile(rf"{re.escape(TURN)}(.*?){re.escape(SAYS)}(.*?){re.escape(END)}", re.S)

DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, n_examples bigint, example_chars bigint"
)


class _Conversation:
    """What has been read of a conversation: hash states, counts, and the formatted text of its last turn only."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.n_examples = self.example_chars = 0
        self.chars = 0  # formatted text read so far
        self.rest = ""  # its end that is no whole turn yet
        self.role, self.reply, self.reply_at = "", "", 0  # of the last whole turn; the reply as it is written

    def read(self, piece: str) -> None:
        """Formatted text that goes on from what was read; it may be cut anywhere."""
        self.rest += piece
        self.chars += len(piece)
        begins, at = self.chars - len(self.rest), 0
        while turn := PARSED.match(self.rest, at):
            self.reply, self.reply_at, at = turn[2], begins + turn.start(2), turn.end()
            self.role, text = unescaped(turn[1]), unescaped(self.reply)
            self.n_turns += 1
            self.turns.update(f"{self.role}\n{text}\n".encode())
        self.rest = self.rest[at:]

    def train(self, context_chars: int, reply_chars: int, example_chars: int) -> None:
        """An example: its context was read before, and its mask has to be the reply of the turn that the text ends with."""
        ends = (context_chars + reply_chars + len(END), self.chars)
        if self.rest or self.role != TRAINED_ROLE or context_chars != self.reply_at or ends != (example_chars, example_chars):
            raise ValueError(f"conversation {self.conv}: the example at {context_chars} is no reply")
        reply = unescaped(self.reply[:reply_chars])
        self.loss_chars += len(reply)
        self.loss.update(reply.encode())
        self.n_examples += 1
        self.example_chars += example_chars

    def digest(self) -> list:
        if self.rest:
            raise ValueError(f"conversation {self.conv}: a formatted turn can't be read back")
        hashes = self.turns.hexdigest(), self.loss.hexdigest()
        return [self.conv, self.n_turns, hashes[0], self.loss_chars, hashes[1], self.chars, self.n_examples, self.example_chars]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of the expansion -> a digest per conversation.

    Streams: of a conversation only hash states, counts and a turn are kept, never its text.
    """
    names = [field.split()[0] for field in DIGEST.split(", ")]
    current: _Conversation | None = None
    for batch in batches:
        done = []
        for conv, at, piece, reply_chars, example_chars in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if current is None or current.conv != conv:
                if current:
                    done.append(current.digest())
                current = _Conversation(conv)
            if piece is not None:
                current.read(piece)
            else:
                current.train(at, reply_chars, example_chars)
        if done:
            yield _rows(done, names)
    if current:
        yield _rows([current.digest()], names)


def _rows(rows: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def digests(rows: DataFrame) -> DataFrame:
    """The expansion read back, a row per conversation.

    Turns of a conversation have to pass through one hash in order; each task streams its
    conversations, sorted on disk if need be, so memory does not depend on their length.
    """
    rows = rows.select("conv_id", "at", "piece", "reply_chars", "example_chars")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_read_back, DIGEST)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: all `conversations` and one more."""
    conv, roles, text = ADDED_CONVERSATION
    added = spark.range(1).select(
        F.lit(conv).cast("long").alias("conv_id"),
        F.posexplode(F.array(*map(F.lit, roles))).alias("turn", "role"),
        F.lit(text).alias("text"),
    )
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(expanded(placed_turns(formatted_turns(given.unionByName(added)))))


SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), escaped AS (
    SELECT *, replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS r,
        replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS t
    FROM turns
), pieces AS (
    SELECT *, '<|turn|>' || r || '<|says|>' || t || '<|end|>' AS piece FROM escaped
), placed AS (
    SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, piece ROWS UNBOUNDED PRECEDING) AS upto FROM pieces
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, piece)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, piece) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(piece))::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant')::BIGINT AS n_examples,
    coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
FROM placed GROUP BY conv_id
"""

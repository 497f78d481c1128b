"""Chat formatting: roles of raw transcripts by a hidden Markov model.

A transcript comes as fragments (conversation, order, text) whose line breaks and
speaker markers follow no common form, and whose fragments need not be turns.  Each
line is a start or a continuation of a turn by one of three roles (six hidden states).
Observed are the speaker marker a line opens with, blank lines around it, its length,
its end and whether it looks like code or a list.  Viterbi finds the most likely states; a
turn is a start and its continuations, its marker is removed, and it is rendered in
one canonical form.

Scale: a conversation of more than ``CHUNK`` rows is cut into chunks of at most as many consecutive
rows, whatever their orders: its rows are dealt by ranges of order and text, in which a row number
makes the chunks.  A chunk's best
scores from any state before it to any state at its end are one 6 x 6 matrix, and these combine
by maximum and sum, so that a conversation of any length is decoded exactly: chunks
give their matrices, a pass over a conversation's matrices (a few hundred bytes per
chunk, streamed) gives each chunk its first and last state, and each chunk is decoded
by itself.  No task holds a conversation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from vaultspark.llm.common import stored

ROLES = ("system", "user", "assistant")
#: States: start of a turn by role 0..2, continuation by role 0..2.
N_STATES = 6
CHUNK = 256
#: Characters of a text that order it among equal orders; a hash orders texts that agree in them.
HEAD = 1024
#: Words that name a speaker (fixed values).
SPEAKERS = {
    "system": "system sys instruction instructions prompt context setup",
    "user": "user human customer client q question me asker student visitor caller",
    "assistant": "assistant ai bot a answer model agent chatbot helper support gpt",
}
ROLE_OF = {w: k for k, r in enumerate(ROLES) for w in SPEAKERS[r].split()}
#: A name at the start of a line, set off by punctuation.
MARKER = re.compile(
    r"^\s*(?P<deco>(?:#{1,6}|>|[*_]{1,2}|[\[(<{|]{1,2}\|?)\s*)*(?P<name>[^\W\d_][\w'.-]{0,19}(?: [^\W\d_][\w'.-]{0,19})?)\s*(?P<close>(?:[*_]{1,2}|\|?[\])>}|]{1,2})*)"
    r"\s*(?P<sep>:|>|–|—| - |)[*_]{0,2}\s*", re.U)
LISTLIKE = re.compile(r"^\s*(?:[-*+•]\s|\d{1,3}[.)]\s|```|    |\t|[{}<>$;])")

# Fixed parameters: log probabilities of observations in each state and of transitions.
_MARK = np.log(np.array([  # none, system, user, assistant, another name
    [.16, .76, .01, .01, .06], [.16, .01, .70, .01, .12], [.16, .01, .01, .70, .12],
    [.985, .003, .002, .002, .008], [.985, .002, .003, .002, .008], [.985, .002, .002, .003, .008]]))
_AFTER_BLANK = np.log(np.array([[.6, .4], [.55, .45], [.55, .45], [.9, .1], [.94, .06], [.92, .08]]))  # no, yes
_BLANK = np.log(np.array([[.999, .001]] * 3 + [[.93, .07]] * 3))
_LENGTH = np.log(np.array([[.3, .4, .3], [.35, .4, .25], [.2, .4, .4], [.3, .4, .3], [.4, .4, .2], [.25, .4, .35]]))  # short, middle, long
_ASKS = np.log(np.array([[.99, .01], [.8, .2], [.95, .05], [.99, .01], [.88, .12], [.96, .04]]))
_LIST = np.log(np.array([[.98, .02], [.98, .02], [.96, .04], [.9, .1], [.94, .06], [.86, .14]]))
START = np.log(np.array([.22, .66, .12, 1e-12, 1e-12, 1e-12]))  # a conversation opens with a start
MOVE = np.log(np.array([  # from (row) to (column)
    [.01, .29, .04, .65, .004, .006], [.005, .03, .405, .004, .55, .006], [.005, .385, .03, .004, .006, .57],
    [.01, .29, .04, .65, .004, .006], [.005, .03, .405, .004, .55, .006], [.005, .385, .03, .004, .006, .57]]))
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def marker(line: str) -> tuple[int, int]:
    """(class, characters of the marker): 0 none, 1 to 3 a role's word, 4 another name."""
    m = MARKER.match(line[:80])
    if not m:
        return 0, 0
    set_off = bool(m["deco"] or m["close"])
    if m["sep"] == "" and not (set_off and m.end() >= len(line.rstrip())) and not m["close"]:
        return 0, 0
    words = m["name"].lower().strip("'.-").split()
    role = ROLE_OF.get(words[-1], ROLE_OF.get(words[0]))
    if role is not None and (len(words) == 1 or set_off or m["sep"] == ":"):
        return role + 1, m.end()
    if m["sep"] == ":" and m["name"][0].isupper() and all(w[0].isupper() for w in m["name"].split()):
        return 4, m.end()
    return 0, 0


def emissions(lines: list[str], before_blank: bool) -> tuple[np.ndarray, list[int]]:
    """(log probabilities [line, state], marker lengths); ``before_blank``: whether the line before the first is blank."""
    kinds, cuts, blank = [], [], []
    for line in lines:
        k, n = marker(line)
        kinds.append(k)
        cuts.append(n)
        blank.append(int(not line.strip()))
    b = np.array(blank)
    after = np.concatenate(([int(before_blank)], b[:-1]))
    size = np.array([len(x) for x in lines])
    asks = np.array([int(x.rstrip().endswith("?")) for x in lines])
    lists = np.array([int(bool(LISTLIKE.match(x))) for x in lines])
    out = (_MARK[:, kinds] + _AFTER_BLANK[:, after] + _BLANK[:, b] + _LENGTH[:, (size > 60).astype(int) + (size > 240)]
           + _ASKS[:, asks] + _LIST[:, lists])
    return out.T, cuts


def transfer(e: np.ndarray) -> np.ndarray:
    """Best score from each state before the first line (row; the last row is the start of
    the conversation) to each state at the last line (column)."""
    m = np.concatenate((MOVE, START[None])) + e[0]
    for row in e[1:]:
        m = (m[:, :, None] + MOVE[None]).max(axis=1) + row
    return m


def viterbi(e: np.ndarray, before: np.ndarray, last: int | None = None) -> np.ndarray:
    """States of the lines; ``before``: scores of the first line's states before its emission.  Ties go to the lower state."""
    score, back = before + e[0], np.zeros((len(e), N_STATES), dtype=np.int8)
    for t in range(1, len(e)):
        by = score[:, None] + MOVE
        back[t] = by.argmax(axis=0)
        score = by.max(axis=0) + e[t]
    out = np.zeros(len(e), dtype=np.int64)
    out[-1] = int(score.argmax()) if last is None else last
    for t in range(len(e) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


def chunks(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[str]]]:
    """(first row, lines) of each chunk, from batches sorted by conversation, chunk and order."""
    first: dict | None = None
    lines: list[str] = []
    for b in it:
        for r in b.to_pylist():
            if first is None or (r["conv_id"], r["chunk"]) != (first["conv_id"], first["chunk"]):
                if first is not None:
                    yield first, lines
                first, lines = r, []
            lines.extend((r["text"] or "").replace("\r\n", "\n").split("\n"))
    if first is not None:
        yield first, lines


def batched(rows: Iterator[tuple], schema: pa.Schema, at_most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as record batches."""
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= at_most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def scores(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, chunk, matrices, whether the last line is blank) of each chunk.  The line before the chunk
    may be blank or not, which only the chunk before knows: both matrices are kept."""
    for first, lines in chunks(it):
        e, _ = emissions(lines, False)
        other, _ = emissions(lines[:1], True)
        both = np.stack((transfer(e), transfer(np.concatenate((other, e[1:])))))
        yield first["conv_id"], first["chunk"], both.tobytes(), not lines[-1].strip()


def borders(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, chunk, state before it or -1, state at its end, whether the line before is blank) of
    each chunk, from scores sorted by conversation and chunk.  Of a conversation only
    six back pointers a chunk are held."""
    key, some = None, False
    at: list[int] = []
    backs: list[np.ndarray] = []
    blanks: list[bool] = []
    score, blank = np.empty(0), True

    def path() -> Iterator[tuple]:
        state, found = int(score.argmax()), []
        for k, back, was in zip(reversed(at), reversed(backs), reversed(blanks)):
            found.append((key, k, int(back[state]), state, was))
            state = int(back[state])
        return found

    for b in it:
        for conv, k, m, end in zip(*(b.column(c).to_pylist() for c in ("conv_id", "chunk", "m", "blank_end"))):
            step = np.frombuffer(m, np.float64).reshape(2, N_STATES + 1, N_STATES)
            if not some or conv != key:
                if some:
                    yield from path()
                key, some, at, backs, blanks = conv, True, [], [], []
                score, back, blank = step[1, N_STATES], np.full(N_STATES, -1, np.int8), True
            else:
                by = score[:, None] + step[int(blank), :N_STATES]
                score, back = by.max(axis=0), by.argmax(axis=0).astype(np.int8)
            at.append(k)
            backs.append(back)
            blanks.append(blank)
            blank = end
    if some:
        yield from path()


def turns(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, chunk, part, starts, role, text, n_lines, long): the parts of turns inside each chunk."""
    for first, lines in chunks(it):
        entry, long = first["entry"], first["entry"] is not None
        opens = not long or entry < 0
        e, cuts = emissions(lines, True if opens else first["after_blank"])
        states = viterbi(e, START if opens else MOVE[entry], first["exit"] if long else None)
        begin = [t for t in range(len(lines)) if states[t] < 3 or t == 0]
        for part, (lo, hi) in enumerate(zip(begin, [*begin[1:], len(lines)])):
            text = lines[lo:hi]
            starts = bool(states[lo] < 3) or opens
            if states[lo] < 3:
                text = [text[0][cuts[lo]:], *text[1:]]
            yield first["conv_id"], first["chunk"], part, starts, ROLES[states[lo] % 3], "\n".join(text), hi - lo, long


def cut_rows(it: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by conversation, with their chunk: a number that grows over the
    ranges and, within one, with every ``chunk`` rows of a conversation."""
    base, key, n, some = TaskContext.get().partitionId() << 32, None, 0, False
    for b in it:
        out = []
        for conv in b.column("conv_id").to_pylist():
            if not some or conv != key:
                key, n, some = conv, 0, True
            out.append(base + n // chunk)
            n += 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], [*b.schema.names, "chunk"])


def parse_transcripts(spark: SparkSession, transcripts: DataFrame, conv_col: str = "conv_id", order_col: str = "seq",
                      text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(conv_id, turn, role, text, n_lines, rendered): the turns of every conversation, numbered from 0.

    Fragments of a conversation are joined by line breaks in the order of ``order_col``, ties by
    the first ``HEAD`` characters of their text and then its hash; a null order comes first and a null text is one empty line; rows without a conversation
    id are one conversation.  Repeated rows are read twice.  Blank lines at the ends of a turn are
    dropped, a turn without text stays with an empty one.  An empty table gives an empty
    result; other columns are not read."""
    order = F.coalesce(F.col(f"`{order_col}`").cast("long"), F.lit(-1).cast("long"))
    src = transcripts.select(F.col(f"`{conv_col}`").alias("conv_id"), order.alias("seq"), F.col(f"`{text_col}`").cast("string").alias("text"))
    by_text = [F.substring("text", 1, HEAD), F.xxhash64("text")]
    conv = src.schema["conv_id"]
    arrow = to_arrow_type(conv.dataType)

    def task(rows, spec: str):
        """mapInArrow function and DDL for a generator of rows; ``spec`` lists the columns after conv_id."""
        ddl = f"conv_id {conv.dataType.simpleString()}, {spec}"
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
        schema = pa.schema([("conv_id", arrow), *((c.split()[0], kinds[c.split()[1]]) for c in spec.split(", "))])
        return (lambda it: batched(rows(it), schema)), ddl

    def sorted_chunks(df: DataFrame) -> DataFrame:
        return df.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "seq", *by_text)

    # only conversations of several chunks need numbered rows and the matrices
    counts = src.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > chunk)
    long = stored(spark, counts.select(F.col("conv_id").alias("_long")), "long-conversations")
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    if long.head(1):
        some = src.join(long, same, "left_semi").select("conv_id", "seq", "text", by_text[0].alias("_head"), by_text[1].alias("_hash"),
                                                        F.monotonically_increasing_id().alias("_tie"))  # equal rows are told apart
        keys = ["conv_id", "seq", "_head", "_hash", "_tie"]
        ranged = some.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "seq", "text")
        cut = ranged.mapInArrow(lambda it: cut_rows(it, chunk), StructType([*ranged.schema.fields, StructField("chunk", LongType())]))
        cut = stored(spark, cut, "numbered-rows")
        src = src.join(long, same, "left_anti").withColumn("chunk", F.lit(0).cast("long")).union(cut)
    else:
        src = src.withColumn("chunk", F.lit(0).cast("long"))
        cut = src.limit(0)
    given = task(scores, "chunk bigint, m binary, blank_end boolean")
    matrices = sorted_chunks(cut).mapInArrow(*given)
    ends = task(borders, "chunk bigint, entry int, exit int, after_blank boolean")
    found = matrices.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(*ends)
    found = stored(spark, found.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"), "entry", "exit", "after_blank"), "chunk-borders")
    known = src.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")), "left").drop("_conv", "_chunk")
    parts = task(turns, "chunk bigint, part int, starts boolean, role string, text string, n_lines bigint, long boolean")
    pieces = sorted_chunks(known).mapInArrow(*parts)
    short = pieces.filter("not long").select("conv_id", F.col("part").cast("long").alias("turn"), "role", "text", "n_lines")
    if long.head(1):
        pieces = stored(spark, pieces, "turn-parts")
        short = pieces.filter("not long").select("conv_id", F.col("part").cast("long").alias("turn"), "role", "text", "n_lines")
        mine = pieces.filter("long")
        per = mine.groupBy("conv_id", "chunk").agg(F.sum(F.col("starts").cast("long")).alias("n"), F.min(F.struct("part", "starts")).alias("f"))
        before = F.sum("n").over(W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1))
        # the first part of a chunk that starts no turn belongs to the turn before
        per = per.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"),
                         (F.coalesce(before, F.lit(0)) - F.when(F.col("f.starts"), 0).otherwise(1)).alias("_base"))
        mine = mine.join(per, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")))
        mine = mine.withColumn("turn", F.col("_base") + F.col("part"))
        joined = F.array_sort(F.collect_list(F.struct("chunk", "part", "text")))  # the parts of one turn
        mine = mine.groupBy("conv_id", "turn").agg(F.min(F.struct("chunk", "part", "role")).alias("r"), joined.alias("t"), F.sum("n_lines").alias("n_lines"))
        short = short.union(mine.select("conv_id", "turn", "r.role", F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("text"), "n_lines"))
    text = F.regexp_replace("text", r"\A(?:[ \t]*\n)+|\s+\z", "")
    out = short.withColumn("text", text)
    body = F.replace(F.col("text"), F.lit("<|"), F.lit("< |"))  # a text cannot open or close a turn
    return out.withColumn("rendered", F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"), body, F.lit(CLOSE + "\n")))

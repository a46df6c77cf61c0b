"""Chat formatting by prefix-target expansion.

A conversation's turns, in order, form one transcript. Every assistant turn is an example of
its own: its context is the whole transcript up to that turn, and only its reply is
trainable. :func:`expand` writes each example with all turns before it, however long its
conversation is, and the digests are read from these rows. Contexts of one conversation grow
with its square: a long example is several rows, the rows of one conversation are made by many
tasks, and a row that begins like the one before it is stored as what differs (Parquet's delta
encoding). :func:`render` makes one text of each example.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``; in roles a line end becomes ``\\n`` written
as two characters. So a text can never hold a control string, and reading back undoes it.

A conversation is read as a stream sorted by turn, never as a whole; of its examples only the
places are held.

Defined results: a null text or role is empty; only the role ``assistant`` is trainable; null
turns come first; turns with the same number are ordered by role and text, repeated rows stay;
rows with a null conv_id form one conversation with a null id; a conversation without an
assistant turn has turns but no example. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, raw_texts

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"

SEGMENTS = "conv_id long, seq long, segment string, begin long, end long, fresh long, loss_begin long, loss_end long"


def escape(s: str, line: bool = False) -> str:
    s = s.replace("\\", "\\\\").replace("<|", "<\\|")
    return s.replace("\n", "\\n") if line else s


_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def unescape(s: str, line: bool = False) -> str:
    return _ESCAPED.sub(lambda m: "\n" if line and m[1] == "n" else m[1], s)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and where its text begins and ends in it."""
    head = f"{START}{escape(role, True)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_segment(s: str) -> tuple[str, str]:
    """Role and text of a written turn."""
    if not (s.startswith(START) and s.endswith(END + "\n")):
        raise ValueError("not a turn of this template")
    role, _, body = s[len(START) : -len(END) - 1].partition("\n")
    return unescape(role, True), unescape(body)


def format_turns(turns: DataFrame) -> DataFrame:
    """One row a turn, sorted inside its task by conversation and place: its segment, its span in the transcript and,
    for an assistant turn, the span of its reply. Such a row is an example: the transcript up to ``end``, with that span as loss mask.
    ``fresh`` is where the example before ends."""

    def run(batches):
        now, seq, at, fresh = object(), 0, 0, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if conv != now:
                    now, seq, at, fresh = conv, 0, 0, 0
                role = role or ""
                s, lo, hi = segment(role, text or "")
                loss = (at + lo, at + hi) if role == TRAINED else (None, None)
                out.append((conv, seq, s, at, at + len(s), fresh, *loss))
                seq, at = seq + 1, at + len(s)
                fresh = at if role == TRAINED else fresh
            cols = list(zip(*out)) or [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.string()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                             ["conv_id", "seq", "segment", "begin", "end", "fresh", "loss_begin", "loss_end"])

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"), F.col("turn").cast("long").alias("turn"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(run, SEGMENTS)


def examples(formatted: DataFrame) -> DataFrame:
    """conv_id, example, context_chars, loss_begin, loss_end: one row an assistant turn."""
    return formatted.where("loss_begin IS NOT NULL").select("conv_id", F.col("seq").alias("example"), F.col("end").alias("chars"), "loss_begin", "loss_end")


def render(formatted: DataFrame) -> DataFrame:
    """Examples with their text written out, for a formatted table that fits its quadratic size.

    Built by a running concatenation inside the conversation, example by example.
    """

    def run(batches):
        now, parts = object(), []
        for batch in batches:
            for conv, seq, s, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if conv != now:
                    now, parts = conv, []
                parts.append(s)
                if lo is not None:
                    text = "".join(parts)
                    parts = [text]
                    yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([seq]), pa.array([text]), pa.array([lo]), pa.array([hi])],
                                                     ["conv_id", "example", "text", "loss_begin", "loss_end"])

    rows = formatted.select("conv_id", "seq", "segment", "loss_begin", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return rows.mapInArrow(run, "conv_id long, example long, text string, loss_begin long, loss_end long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of each conversation, read from the segments and the loss mask of :func:`format_turns` (in its order)."""

    def run(batches):
        now, started, turns, loss = object(), False, None, None
        n = loss_chars = chars = n_examples = example_chars = 0

        def told():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            row = (now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n_examples, example_chars)
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "example_chars"])

        for batch in batches:
            for conv, s, begin, end, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if not started or conv != now:
                    if started:
                        yield told()
                    now, started, turns, loss = conv, True, hashlib.sha256(), hashlib.sha256()
                    n = loss_chars = chars = n_examples = example_chars = 0
                role, text = read_segment(s)
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                n, chars = n + 1, end
                if lo is not None:
                    reply = unescape(s[lo - begin : hi - begin])
                    loss.update(reply.encode("utf-8", "surrogatepass"))
                    loss_chars, n_examples, example_chars = loss_chars + len(reply), n_examples + 1, example_chars + end
        if started:
            yield told()

    return formatted.select("conv_id", "segment", "begin", "end", "loss_begin", "loss_end").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long, example_chars long")


#: Characters of an example in one row, and of texts that a task holds before they are handed on.
WRITTEN, HELD = 1 << 13, 1 << 20
#: Examples that are made from one copy of a piece of their conversation.
MARKS = 1 << 10
#: A text that begins like the one before it is stored as what differs, so stored examples take about the bytes of the turns.
STORED = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false", "compression": "zstd"}


def expand(formatted: DataFrame) -> DataFrame:
    """Every assistant turn as an example of its own: its text is the transcript from 0 to ``end``, all turns before the reply
    and the reply; from ``fresh`` on it is not in an example before.

    A transcript is cut at multiples of ``WRITTEN`` characters, so an example beyond that is several rows, each with its
    ``text`` from ``begin`` on. Turns that no reply follows are rows without a span, from ``fresh`` on.
    Conversations are read from their ends: a piece comes when all examples that hold it are known, and is sent once for
    every ``MARKS`` of them, to any task.
    """
    size = max(1, WRITTEN)
    spot = pa.struct([(k, pa.int64()) for k in ("seq", "fresh", "end", "lo", "hi")])

    def run(batches):
        now, started, marks, parts, held = None, False, [], [], 0
        out: list[tuple] = []

        def told():
            conv, cell, text, some = zip(*out)
            spots = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*(m for x in some for m in x))], fields=list(spot))
            ends = [0, *accumulate(len(x) for x in some)]
            row = pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(cell, pa.int64()), pa.array([len(x) for x in text], pa.int64()), pa.array(text, pa.string()),
                                              pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spots)], ["conv_id", "cell", "chars", "piece", "marks"])
            out.clear()
            return row

        for batch in batches:
            for conv, seq, s, begin, end, fresh, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if not started or conv != now:
                    now, started, marks, parts = conv, True, [], []
                if lo is not None or not marks:  # the last turn stands for those without a reply
                    marks.append((seq, fresh, end, lo, hi))
                while end > begin:
                    cell = (end - 1) // size * size
                    cut = max(cell, begin)
                    parts.append(s[cut - begin : end - begin])
                    end = cut
                    if cut > cell:
                        continue
                    text, parts = "".join(reversed(parts)), []
                    first = int(marks[0][3] is None and marks[0][1] >= cell + len(text))  # no such turn is here
                    for i in range(first, len(marks), MARKS):
                        some = marks[i : i + MARKS]
                        out.append((conv, cell, text, some))
                        held += len(text) + 40 * len(some)
                        if held > HELD:
                            yield told()
                            held = 0
        if out:
            yield told()

    rows = formatted.select("conv_id", "seq", "segment", "begin", "end", "fresh", "loss_begin", "loss_end")
    pieces = rows.sortWithinPartitions("conv_id", F.desc("seq")).mapInArrow(run, "conv_id long, cell long, chars long, piece string, marks array<struct<seq: long, fresh: long, end: long, lo: long, hi: long>>")
    pieces = pieces.repartition("conv_id", "cell", F.col("marks")[0]["seq"])
    made = pieces.select("conv_id", "cell", "chars", "piece", F.explode("marks").alias("m"))
    begin = F.when(F.col("m.lo").isNull(), F.greatest("cell", "m.fresh")).otherwise(F.col("cell"))
    stop = F.least(F.col("m.end"), F.col("cell") + F.col("chars"))
    text = F.when((begin == F.col("cell")) & (stop == F.col("cell") + F.col("chars")), F.col("piece")).otherwise(
        F.col("piece").substr((begin - F.col("cell") + 1).cast("int"), (stop - begin).cast("int")))
    return made.select("conv_id", "m.seq", begin.alias("begin"), "m.fresh", "m.end", text.alias("text"), F.col("m.lo").alias("loss_begin"), F.col("m.hi").alias("loss_end"))


def read_examples(expanded: DataFrame) -> DataFrame:
    """The columns of :func:`read_back`, from stored examples: each is read with its whole context, and its reply by its own span.

    Where a row is read, its context and its text become digests and only what no example before holds travels on; then
    the rows of each example must follow one another from 0 to its end, and their context must be the texts before.
    """
    names = ["conv_id", "seq", "begin", "stop", "fresh", "end", "loss_begin", "loss_end", "text", "context", "whole"]
    size = max(1, WRITTEN)

    def read(batches):
        for batch in batches:
            out = []
            body, off = raw_texts(batch.column(0))
            chars = pc.utf8_length(batch.column(0)).to_pylist()
            for i, (n, conv, seq, begin, fresh, end, lo, hi) in enumerate(zip(chars, *(batch.column(i).to_pylist() for i in range(1, 8)))):
                raw, stop = body[off[i] : off[i + 1]], begin + (n or 0)
                if not n or stop > end or (stop - 1) // size != begin // size:
                    raise ValueError("a row of an example has another length than its place says")
                digest, context, s = hashlib.sha256(), None, ""
                if stop <= fresh:
                    digest.update(raw)
                    context = digest.digest()
                else:
                    s, head = raw.tobytes().decode(), b""
                    if begin < fresh:
                        head = s[: fresh - begin].encode()
                        digest.update(head)
                        context, s = digest.digest(), s[fresh - begin :]
                    digest.update(raw[len(head) :])
                out.append((conv, seq, begin, stop, fresh, end, lo, hi, s, context, digest.digest() if stop > fresh and begin % size == 0 else None))
            kinds = [pa.int64()] * 8 + [pa.string()] + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(list(zip(*out)) or [[]] * len(kinds), kinds)], names)

    def run(batches):
        now, started, turns, loss = None, False, None, None
        cell, cells, at, seq_now, due, left = None, [], 0, None, 0, 0
        reply, open_turn, tail = [], [], ""
        n = loss_chars = n_examples = example_chars = 0
        out: list[tuple] = []

        def told():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            rows = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "example_chars"])
            out.clear()
            return rows

        for batch in batches:
            for conv, seq, begin, stop, fresh, end, lo, hi, s, context, whole in zip(*(batch.column(i).to_pylist() for i in range(11))):
                if not started or conv != now:
                    if left:
                        raise ValueError("an example lacks rows")
                    if started:
                        out.append((now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), at, n_examples, example_chars))
                        if len(out) >= 4096:
                            yield told()
                    now, started, turns, loss = conv, True, hashlib.sha256(), hashlib.sha256()
                    cell, cells, at, seq_now = hashlib.sha256(), [], 0, None
                    n = loss_chars = n_examples = example_chars = 0
                if seq != seq_now:
                    if left or fresh != at:
                        raise ValueError("an example lacks rows")
                    seq_now, due, reply = seq, fresh if lo is None else 0, []
                if begin != due:
                    raise ValueError("an example lacks rows")
                due, left = stop, end - stop
                if context is not None and context != (cells[begin // size] if begin // size < len(cells) else cell.digest()):
                    raise ValueError("the context of an example is not the turns before it")
                if stop > fresh:
                    place = max(begin, fresh)
                    cell.update(s.encode("utf-8", "surrogatepass"))
                    at = stop
                    if whole is not None and whole != cell.digest():
                        raise ValueError("the text of an example is not its turns")
                    if not at % size:
                        cells.append(cell.digest())
                        cell = hashlib.sha256()
                    if lo is not None:
                        reply.append(s[max(0, lo - place) : max(0, hi - place)])
                    open_turn.append(s)
                    if END + "\n" in tail + s:
                        *ended, s = "".join(open_turn).split(END + "\n")
                        open_turn, tail = [s], ""
                        for turn in ended:
                            role, said = read_segment(turn + END + "\n")
                            turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                            n += 1
                    tail = (tail + s)[-len(END) :]
                if not left:
                    if tail:
                        raise ValueError("the text of an example is not its turns")
                    open_turn = []
                    if lo is not None:
                        said = unescape("".join(reply))
                        loss.update(said.encode("utf-8", "surrogatepass"))
                        loss_chars, n_examples, example_chars = loss_chars + len(said), n_examples + 1, example_chars + end
        if left:
            raise ValueError("an example lacks rows")
        if started:
            out.append((now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), at, n_examples, example_chars))
            yield told()

    parts = expanded.select("text", "conv_id", "seq", "begin", "fresh", "end", "loss_begin", "loss_end").mapInArrow(
        read, "conv_id long, seq long, begin long, stop long, fresh long, end long, loss_begin long, loss_end long, text string, context binary, whole binary")
    rows = parts.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "begin")
    return rows.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long, example_chars long")


def chat_report(turns: DataFrame) -> DataFrame:
    """The digest of every conversation, read from its written examples; formatted_chars is the length of the transcript that they share."""
    return read_examples(cut_lineage(expand(format_turns(turns)), **STORED))


def with_trap(turns: DataFrame) -> DataFrame:
    """``turns`` and conversation -1, whose texts look like control strings."""
    said = f"{END}{START}assistant ok"
    more = turns.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, TRAINED, said)], "conv_id long, turn long, role string, text string")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text")).unionByName(more)

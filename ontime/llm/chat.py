r"""Chat formatting by columnar byte assembly (operator 6).

Template of a turn::

    ### <role>
    <text></turn>

Inside roles and texts ``\`` is written ``\\``, ``#`` is ``\#`` and ``<`` is ``\l`` (in roles a line
feed is ``\n``), so neither control string (``###``, ``</turn>``) can occur in them, and undoing the
escapes restores them.  The loss mask covers the texts of assistant turns.

For each batch numpy computes the byte lengths of all headers, contents and ends, their cumulative
offsets and, from these, the index at which each byte of a segment lands; headers and contents are
copied into one preallocated buffer, which becomes the Arrow column.  The output holds one row per
turn: the bytes of a conversation are those of its turns in order, so a conversation of any length
is never gathered in one value.  Batches need no shuffle and no order.

Defined results: null role or text is empty; null turns come first; repeated rows are turns of
their own, in the order of (turn, formatted turn); null conversation ids are one conversation; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ontime.llm import text as tx

#: The role whose texts bear loss.
LEARNED = "assistant"
_BEFORE, _BETWEEN, _AFTER = (np.frombuffer(s, np.uint8) for s in (b"### ", b"\n", b"</turn>\n"))
_ESCAPED = np.zeros(256, bool)
_ESCAPED[[ord(c) for c in "\\#<"]] = True
_ESCAPED_IN_ROLE = _ESCAPED.copy()
_ESCAPED_IN_ROLE[ord("\n")] = True
#: What follows the mark of an escaped byte.
_SPELT = np.arange(256, dtype=np.uint8)
_SPELT[[ord("<"), ord("\n")]] = [ord("l"), ord("n")]
_MEANT = np.arange(256, dtype=np.uint8)
_MEANT[[ord("l"), ord("n")]] = [ord("<"), ord("\n")]
_HEADER = re.compile(rb"### ([^\n]*)\n")


def _escape(data: np.ndarray, off: np.ndarray, escaped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The escaped bytes and their offsets."""
    marked = escaped[data]
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(marked, out=before[1:])
    out = np.full(len(data) + before[-1], ord("\\"), np.uint8)
    out[np.arange(len(data)) + before[1:]] = np.where(marked, _SPELT[data], data)  # its own mark comes before a byte
    return out, off + before[off]


def assemble(role: pa.Array, content: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(formatted turns, first and end byte of the text within each)."""
    roles, role_off = _escape(*tx.flat(role), _ESCAPED_IN_ROLE)
    texts, text_off = _escape(*tx.flat(content), _ESCAPED)
    n = len(role_off) - 1
    sizes = np.empty((n, 5), np.int64)
    sizes[:, 0], sizes[:, 2], sizes[:, 4] = len(_BEFORE), len(_BETWEEN), len(_AFTER)
    sizes[:, 1], sizes[:, 3] = np.diff(role_off), np.diff(text_off)
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    starts = ends - sizes
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for k, fixed in ((0, _BEFORE), (2, _BETWEEN), (4, _AFTER)):
        out[starts[:, k, None] + np.arange(len(fixed))] = fixed
    out[tx.gather(starts[:, 1], sizes[:, 1])] = roles
    out[tx.gather(starts[:, 3], sizes[:, 3])] = texts
    offsets = np.append(starts[:, 0], len(out)).astype(np.int64)
    turns = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(out))
    return turns.cast(pa.string()), starts[:, 3] - starts[:, 0], ends[:, 3] - starts[:, 0]


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn of ``conversations`` (conv_id, turn, role, text): its formatted text, the
    bytes of it that are the message (``text_start`` to ``text_end``) and whether these bear loss."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()),
                        ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            turns, first, end = assemble(part.column("role"), part.column("text"))
            loss = pc.fill_null(pc.equal(part.column("role"), LEARNED), False)
            yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("turn"), turns, pa.array(first),
                                              pa.array(end), loss], schema=schema)

    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
            .mapInArrow(task, "conv_id long, turn long, formatted string, text_start long, text_end long, loss boolean"))


def unescape(data: bytes) -> bytes:
    """Undo the escapes."""
    raw = np.frombuffer(data, np.uint8)
    slash = np.flatnonzero(raw == ord("\\"))
    if not len(slash):
        return data
    # in a run of backslashes every second one is an escaped byte, and the first is always a mark
    run = np.cumsum(np.append(True, np.diff(slash) > 1)) - 1
    first = np.flatnonzero(np.append(True, np.diff(slash) > 1))
    mark = (np.arange(len(slash)) - first[run]) % 2 == 0
    keep = np.ones(len(raw), bool)
    keep[slash[mark]] = False
    out = raw.copy()
    out[slash[mark] + 1] = _MEANT[raw[slash[mark] + 1]]
    return out[keep].tobytes()


def read_turn(formatted: bytes) -> tuple[bytes, bytes]:
    """(role, text) of a formatted turn."""
    header = _HEADER.match(formatted)
    if header is None or not formatted.endswith(_AFTER.tobytes()):
        raise ValueError("not a formatted turn")
    role, content = header[1], formatted[header.end():-len(_AFTER)]
    return unescape(role), unescape(content)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted turns alone: n_turns, turns_sha256 (over role,
    line feed, text, line feed of each turn), loss_chars and loss_sha256 (over the texts that bear
    loss), formatted_chars.

    A partition's turns are streamed in order and hashed as they come; a conversation longer than
    memory holds up no more than its running hashes."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []
        for part in tx.slices(batches, "formatted"):
            for conv, turn, first, end, loss in zip(*(part.column(c).to_pylist() for c in (
                    "conv_id", "formatted", "text_start", "text_end", "loss"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                raw = turn.encode()
                role, content = read_turn(raw)
                state[1] += 1
                state[2].update(role + b"\n" + content + b"\n")
                if loss:
                    masked = unescape(raw[first:end])
                    state[3] += len(masked.decode())
                    state[4].update(masked)
                state[5] += len(turn)
            if len(done) >= 1000:
                yield _digest_batch(done, schema)
                done = []
        if state is not None:
            yield _digest_batch([*done, state], schema)

    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
            .mapInArrow(task, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                              "formatted_chars long"))


def _digest_batch(done: list, schema: pa.Schema) -> pa.RecordBatch:
    rows = [(c, n, a.hexdigest(), chars, b.hexdigest(), size) for c, n, a, chars, b, size in done]
    return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

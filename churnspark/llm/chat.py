"""Chat formatting: conversations rebuilt from event logs, rendered with a template and a loss mask, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
# Strings that chat templates use for control; none of them may appear inside a text as such.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = "assistant"  # the role under the loss mask
PART_CHARS = 1 << 20  # a longer conversation is written in parts, cut between turns
BATCH_CHARS = 4 << 20

FORMATTED = "conv_id long, part long, formatted string, mask array<struct<start:long,size:long>>"
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    """Double every backslash, then put one after the first character of each control string."""
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, control[0] + "\\" + control[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def escape_role(role: str) -> str:
    """As for texts, and a line feed becomes a backslash and `n`: a role is one line."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    # No control string has an n as its second character, so a backslash before n is always a line feed.
    return re.sub(r"\\([\\n]?)", lambda m: "\n" if m[1] == "n" else m[1], role)


def _columns(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def render_conversations(events: DataFrame) -> DataFrame:
    """Fold the event log into final messages and render them: rows (conv_id, part, formatted, mask).

    ``events`` has conv_id, turn (the message's place), seq, kind, role, text. In order of seq a `message` event
    starts a message, a `delta` appends to it, an `edit` replaces its text, a `regenerate` empties it so that
    the deltas after it make a new version, a `delete` removes it. A delta, edit or regenerate without a message
    starts one. Two `message` events of one turn are two messages, ordered by seq, role and text.

    The log is partitioned by conversation and sorted by (turn, seq); a task then holds one message and one part
    of output at a time, so a conversation of any length passes through bounded memory. Null texts are empty, a
    null role is the role ``""``, a null conversation id is a conversation of its own, null turns come first.
    ``mask`` marks the texts of the assistant in code points of ``formatted``. Repeated rows are kept; extra
    columns are ignored; an empty log gives no rows.
    """
    names = ["conv_id", "turn", "seq", "kind", "role", "text"]
    log = events.select(*names).repartition("conv_id")
    log = log.sortWithinPartitions("conv_id", "turn", "seq", "role", "text")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turn, part = None, None, 0
        message: list | None = None  # role and pieces of text
        out, mask, length = [], [], 0
        done: list[tuple] = []
        size = 0

        def close_message() -> None:
            nonlocal message, length
            if message is None:
                return
            role, pieces = message
            head = START + escape_role(role) + "\n"
            body = escape("".join(pieces))
            if role == TRAINED:
                mask.append({"start": length + len(head), "size": len(body)})
            out.extend((head, body, END))
            length += len(head) + len(body) + len(END)
            message = None

        def close_part() -> None:
            nonlocal out, mask, length, part, size
            if out:
                done.append((conv, part, "".join(out), mask))
                size += length
                part += 1
            out, mask, length = [], [], 0

        def ready() -> pa.RecordBatch:
            nonlocal done, size
            cols = list(zip(*done, strict=True)) if done else [[], [], [], []]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.int64()),
                    pa.array(cols[1], pa.int64()),
                    pa.array(cols[2], pa.string()),
                    pa.array(cols[3], pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))),
                ],
                names=["conv_id", "part", "formatted", "mask"],
            )
            done, size = [], 0
            return batch

        first = True
        for batch in batches:
            for c, t, _, kind, role, text in _columns(batch, names):
                if first or c != conv:
                    close_message()
                    close_part()
                    conv, turn, part, first = c, t, 0, False
                if kind == "message" or t != turn:
                    close_message()
                    if length >= PART_CHARS:
                        close_part()
                turn = t
                if kind == "delete":
                    message = None
                elif kind in ("message", "edit", "regenerate"):
                    role = role if message is None or kind == "message" else message[0]
                    message = [role or "", [text or ""]]
                elif message is None:
                    message = [role or "", [text or ""]]
                else:
                    message[1].append(text or "")
                if size >= BATCH_CHARS:
                    yield ready()
        close_message()
        close_part()
        yield ready()

    return log.mapInArrow(fold, FORMATTED)


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Digests of rendered conversations, from the rendered text and mask alone.

    Rows (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars); the parts of a conversation
    are read in order, one at a time.
    """
    parts = formatted.select("conv_id", "part", "formatted", "mask").repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        conv, state = None, None

        def close() -> None:
            if state is not None:
                n, turns, chars, loss, total = state
                rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        def ready() -> pa.RecordBatch:
            nonlocal rows
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for batch in batches:
            for c, _, text, mask in _columns(batch, ["conv_id", "part", "formatted", "mask"]):
                if state is None or c != conv:
                    close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for turn in text.split(END)[:-1]:
                    role, _, body = turn.removeprefix(START).partition("\n")
                    state[0] += 1
                    state[1].update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
                for span in mask:
                    plain = unescape(text[span["start"] : span["start"] + span["size"]])
                    state[2] += len(plain)
                    state[3].update(plain.encode())
                state[4] += len(text)
            yield ready()
        close()
        yield ready()

    return parts.mapInArrow(read, DIGEST)

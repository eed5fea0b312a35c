"""Chat conversations as budgeted windows of templated turns, and back.

A turn is written as ``### role: text </turn>`` and a line end; backslashes and
the control strings inside texts get a backslash, so that a text never looks
like a mark and is restored exactly. Prefix sums of turn tokens cut a
conversation into windows: each takes new turns while the system turn, a limited
repeated history and the new turns fit the budget. Every turn is new in
one window only; the loss mask covers the assistant texts among the new turns.
Turns stream through a task in order, so a conversation of any length needs only
its current window in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.tokens import default_vocabulary, encoder

BUDGET, HISTORY = 1024, 256
_OPEN, _CLOSE = "### ", " </turn>\n"
_SPECIAL = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_TURN = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|:))*): ((?:[^\\<]|\\(?:\\|###|</turn>)|<(?!/turn>))*) </turn>\n")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_WINDOWS = "conv_id long, window int, text string, repeated int, loss array<struct<start:long,end:long>>"


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def template(role: str, text: str) -> tuple[str, int, int]:
    """The written turn, and where its text begins and ends."""
    head = _OPEN + _ROLE.sub(lambda m: "\\" + m[0], role) + ": "
    body = escape(text)
    return head + body + _CLOSE, len(head), len(head) + len(body)


def _format(path: str, budget: int, history: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, out, size = encoder(path), [], 0
        state = None

        def close():
            kept = [t for t in state["head"]] + [t for t in state["old"]] + state["new"]
            text, loss = "", []
            parts, at = [], 0
            repeated = len(kept) - len(state["new"])
            for i, (written, start, end, role, _) in enumerate(kept):
                if i >= repeated and role == "assistant":
                    loss.append({"start": at + start, "end": at + end})
                parts.append(written)
                at += len(written)
            text = "".join(parts)
            out.append((state["conv"], state["window"], text, repeated, loss))
            state["window"] += 1
            return len(text)

        for batch in batches:
            convs, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            turns = [template(r or "", t or "") for r, t in zip(roles, texts, strict=True)]
            tokens = coder.counts(pa.array([t[0] for t in turns], pa.string())).tolist()
            for conv, role, turn, n in zip(convs, roles, turns, tokens, strict=True):
                if state is None or state["conv"] != conv:
                    if state is not None:
                        size += close()
                    state = {"conv": conv, "window": 0, "head": [], "system": None, "old": [], "new": [], "sum": 0, "start": 0, "tail": deque(), "fixed": 0}
                item = (*turn, role, n)
                # Prefix sums: tokens of all turns so far, and at the start of the window.
                if state["new"] and state["fixed"] + state["sum"] + n - state["start"] > budget:
                    size += close()
                    head = [state["system"]] if state["system"] else []
                    room = min(history, budget - n - sum(t[4] for t in head))
                    while state["tail"] and state["sum"] - state["tail"][0][0] > room:
                        state["tail"].popleft()
                    old = [t for _, t in state["tail"] if t is not state["system"]]
                    state |= {"head": head, "old": old, "new": [], "start": state["sum"], "fixed": sum(t[4] for t in head) + sum(t[4] for t in old)}
                if role == "system" and state["sum"] == 0 and state["system"] is None:
                    state["system"] = item
                state["new"].append(item)
                state["tail"].append((state["sum"], item))
                state["sum"] += n
                while len(state["tail"]) > 1 and state["sum"] - state["tail"][0][0] > history:
                    state["tail"].popleft()
            if out and size > 1 << 20:
                yield _windows(out)
                out, size = [], 0
        if state is not None:
            close()
        if out:
            yield _windows(out)

    return windows


def _windows(rows: list[tuple]) -> pa.RecordBatch:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), spans)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["conv_id", "window", "text", "repeated", "loss"])


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, vocabulary: str | None = None) -> DataFrame:
    """Windows of ``turns`` (conv_id, turn, role, text): conv_id, window, text, repeated, loss.

    ``repeated`` counts the leading turns that an earlier window held as new (the system turn and
    the history); ``loss`` holds character spans of ``text``. A turn larger than the budget is a window of
    its own with the system turn. Null texts and roles count as empty; rows with a null conv_id
    form one conversation; ties of ``turn`` go by role and text, and all
    are kept; an empty table gives no windows; other columns are left out.
    """
    chosen = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    ordered = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_format(vocabulary or default_vocabulary(), budget, history), _WINDOWS)


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a window."""
    out, at = [], 0
    while at < len(text):
        turn = _TURN.match(text, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, state = [], None

    def close():
        out.append((state["conv"], state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"]))

    for batch in batches:
        for conv, text, repeated, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "repeated", "loss")), strict=True):
            if state is None or state["conv"] != conv:
                if state is not None:
                    close()
                state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "formatted": 0}
            for role, body in parse(text)[repeated:]:
                state["turns"] += 1
                state["all"].update(f"{role}\n{body}\n".encode())
            for span in loss:
                body = unescape(text[span["start"] : span["end"]])
                state["chars"] += len(body)
                state["loss"].update(body.encode())
            state["formatted"] += len(text)
        if len(out) > 2000:
            yield _digests(out)
            out = []
    if state is not None:
        close()
    if out:
        yield _digests(out)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_windows(windows: DataFrame) -> DataFrame:
    """What the windows say, read from their texts: one row per conversation with counts and digests of its turns and of its loss text."""
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(
        _read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

r"""Chat formatting into budgeted windows of whole turns.

A turn is written ``<|im_start|>role\ntext<|im_end|>\n``. Inside texts and roles every
``<``, backslashes, ``|`` gets one backslash more, so no control string is left and the
step can be undone. Running sums of turn tokens cut a conversation into spans of whole
turns that fit the budget next to the system turn and a limited history; a turn that is
longer than that stands alone. Each turn is new in one window; repeated turns carry no loss.

Conversations are streamed in order through the task that holds their id: only the window
being filled and the history are in memory, however long a conversation is.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelog.llm.common import row_tasks, whole

BUDGET = 1_024
#: Tokens of earlier turns that a window may repeat.
HISTORY = 256
START, END = "<|im_start|>", "<|im_end|>"
_TOKEN = re.compile(r"\w+|[^\w\s]")
_RAISE, _LOWER = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
#: ``spans``: start and end, in code points, of the assistant texts that carry loss.
WINDOW = "conv_id bigint, window int, text string, spans array<struct<start:int,end:int>>, n_repeated int, n_new int, tokens int"


def escape(text: str) -> str:
    return _RAISE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _LOWER.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Also keeps a role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class _Turn:
    role: str
    text: str
    tokens: int = 0

    def __post_init__(self):
        self.tokens = 4 + len(_TOKEN.findall(self.role)) + len(_TOKEN.findall(self.text))


@dataclass
class _Open:
    """The conversation being cut; ``sums`` are running token sums over the new turns."""

    conv_id: int | None
    system: _Turn | None = None
    history: list[_Turn] = field(default_factory=list)
    new: list[_Turn] = field(default_factory=list)
    sums: list[int] = field(default_factory=lambda: [0])
    window: int = 0

    def room(self, budget: int) -> int:
        kept = sum(t.tokens for t in self.history) + (self.system.tokens if self.system else 0)
        return budget - kept

    def add(self, turn: _Turn, budget: int, history: int):
        """Takes a turn; yields the window that it closes, if any."""
        if self.new and self.sums[-1] + turn.tokens > self.room(budget):
            yield self.close(history)
        if not self.window and not self.new and turn.role == "system":
            self.system = turn
            self.new.append(turn)
            self.sums.append(0)  # counted by room()
            return
        self.new.append(turn)
        self.sums.append(self.sums[-1] + turn.tokens)

    def close(self, history: int):
        """The window of the new turns; its last turns become the history of the next."""
        repeated = ([self.system] if self.system and self.window else []) + self.history
        text, at, spans = [], 0, []
        for n, turn in enumerate(repeated + self.new):
            head, body = f"{START}{escape_role(turn.role)}\n", escape(turn.text)
            if n >= len(repeated) and turn.role == "assistant":
                spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
            text.append(f"{head}{body}{END}\n")
            at += len(text[-1])
        row = (self.conv_id, self.window, "".join(text), spans, len(repeated), len(self.new), sum(t.tokens for t in repeated + self.new))
        kept, left = [], history
        for turn in reversed([t for t in self.history + self.new if t is not self.system]):
            if turn.tokens > left:
                break
            kept.insert(0, turn)
            left -= turn.tokens
        self.history, self.new, self.sums, self.window = kept, [], [0], self.window + 1
        return row


def chat_windows(conversations: DataFrame, budget=BUDGET, history=HISTORY, conv_col="conv_id", turn_col="turn",
                 role_col="role", text_col="text") -> DataFrame:
    """A row per window, with the columns of ``WINDOW``; turns in order of number, role, text.

    Null roles and texts count as empty, null turn numbers come first, rows with a null
    conversation are one conversation, repeated rows are turns of their own. A system turn
    is one that opens the conversation. Empty in, empty out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state.conv_id != conv:
                    if state:
                        rows.append(state.close(history))
                    state = _Open(conv)
                rows.extend(state.add(_Turn(role, text), budget, history))
            yield from _batches(rows)
        if state:
            yield from _batches([state.close(history)])

    ordered = (
        conversations.select(
            F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
            whole(role_col).alias("role"), whole(text_col).alias("text"),
        )
        .repartition(row_tasks(conversations.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(run, WINDOW)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = (pa.int64(), pa.int32(), pa.string(), span, pa.int32(), pa.int32(), pa.int32())
    names = ("conv_id", "window", "text", "spans", "n_repeated", "n_new", "tokens")
    if rows:
        columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=list(names))


def read_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a window."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(text)]


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint"


def read_back(windows: DataFrame) -> DataFrame:
    """A row per conversation, from the formatted text and its loss spans alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sums = None, None
        for batch in batches:
            rows = []
            for c, text, spans, n_repeated in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if sums is None or c != conv:
                    if sums:
                        rows.append(_sums_row(conv, sums))
                    conv, sums = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, body in read_turns(text)[n_repeated:]:
                    sums[0] += 1
                    sums[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for s in spans:
                    learnt = unescape(text[s["start"] : s["end"]])
                    sums[2] += len(learnt)
                    sums[3].update(learnt.encode("utf-8", "surrogatepass"))
                sums[4] += len(text)
                sums[5] += 1
            yield from _digests(rows)
        if sums:
            yield from _digests([_sums_row(conv, sums)])

    ordered = (
        windows.select("conv_id", "window", "text", "spans", "n_repeated")
        .repartition(row_tasks(windows.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "window")
        .select("conv_id", "text", "spans", "n_repeated")
    )
    return ordered.mapInArrow(run, DIGEST)


def _sums_row(conv, s):
    return (conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5])


def _digests(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = [c.split()[0] for c in DIGEST.split(", ")]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

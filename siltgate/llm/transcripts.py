"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is a sequence of lines. Each line's hidden state is a role, beginning its turn or
going on with it. What is seen of a line is its marker (what stands before a colon, or a tag),
whether it is the first, follows a blank line, asks a question, and how long it is. Viterbi finds
the likeliest states; runs of a role make turns, rendered as ``<|role|>`` and the text.

Transcripts are cut into blocks. A block's effect on the scores of all states is a small max-plus
matrix, and such matrices multiply; so blocks are read in parallel, their matrices are combined
per transcript, and each block is then decoded between its known ends. The result is that of one
pass over the whole, and no task holds a whole transcript.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltgate.llm.common import stage
from siltgate.operators.prefix import running_total_before

ROLES = ("system", "user", "assistant")
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
BLOCK = 256  # lines
# The documented bounds of what the model is counted on.
TRAIN_CONVERSATIONS = 1_000
TRAIN_LINES = 400  # of each
# Names that speakers go by.
NAMES = {
    "system": "system", "instructions": "system", "context": "system",
    "user": "user", "human": "user", "customer": "user", "question": "user", "q": "user", "me": "user", "client": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "answer": "assistant", "a": "assistant",
    "agent": "assistant", "model": "assistant", "gpt": "assistant", "support": "assistant",
}
_MARKER = re.compile(r"^\s*(?:[#>*\-\[\(<|]+\s*)?([A-Za-z]{1,12})\s*(?:[|\])>*]+\s*:?|:)(?:\s*\**)?\s*")
_KINDS = 6  # marker kinds: none, other name, one per role, blank line


def observe(line: str, first: bool, after_blank: bool) -> tuple[int, int, int]:
    """(marker kind, place, shape) of a line."""
    if not line.strip():
        return 5, 0, 0
    found = _MARKER.match(line)
    role = NAMES.get(found[1].lower()) if found else None
    marker = 2 + ROLES.index(role) if role else int(bool(found))
    rest = line[found.end() :] if found and role else line
    shape = 1 + (rest.rstrip().endswith("?")) + 2 * (len(rest) > 80) + 4 * (len(rest) > 400)
    return marker, 1 if first else 2 if after_blank else 0, min(shape, 7)


def without_marker(line: str) -> str:
    found = _MARKER.match(line)
    return line[found.end() :] if found and found[1].lower() in NAMES else line


@dataclass(frozen=True)
class Model:
    """Logarithms of start, transition and of the three emissions, by state."""

    start: np.ndarray
    step: np.ndarray
    marker: np.ndarray
    place: np.ndarray
    shape: np.ndarray

    def emission(self, seen: list[tuple[int, int, int]]) -> np.ndarray:
        m, p, s = np.array(seen).reshape(-1, 3).T
        return self.marker[:, m].T + self.place[:, p].T + self.shape[:, s].T

    def through(self, seen: list[tuple[int, int, int]]) -> np.ndarray:
        """Max-plus matrix from the state before the block to the state of its last line."""
        total = None
        for row in self.emission(seen):
            one = self.step + row
            total = one if total is None else (total[:, :, None] + one[None, :, :]).max(axis=1)
        return total

    def decode(self, seen: list[tuple[int, int, int]], before: np.ndarray, last: int | None) -> list[int]:
        """States of a block's lines, given scores before it and, if known, its last state."""
        score, back = before, []
        for row in self.emission(seen):
            ways = score[:, None] + self.step + row
            back.append(ways.argmax(axis=0))
            score = ways.max(axis=0)
        state, states = int(score.argmax()) if last is None else last, []
        for pointers in reversed(back):
            states.append(state)
            state = int(pointers[state])
        return states[::-1]


def count_model(lines: pd.DataFrame) -> Model:
    """A model from lines with columns conv, first, after_blank, line, state; counts plus one."""
    k = len(STATES)
    start, step = np.ones(k), np.ones((k, k)) * 0.5
    marker, place, shape = np.ones((k, _KINDS)), np.ones((k, 3)), np.ones((k, 8))
    previous, conv = None, None
    for row in lines.itertuples():
        m, p, s = observe(row.line, row.first, row.after_blank)
        marker[row.state, m] += 1
        place[row.state, p] += 1
        shape[row.state, s] += 1
        if row.conv != conv:
            start[row.state] += 1
        else:
            step[previous, row.state] += 1
        previous, conv = row.state, row.conv
    # A role named by a marker begins a turn; the counts of a small corpus must not say otherwise.
    for i, (role, begins) in enumerate(STATES):
        marker[i, 2 + ROLES.index(role)] += 20 if begins else 0
    logs = [np.log(a / a.sum(axis=-1, keepdims=True)) for a in (start, step, marker, place, shape)]
    # Going on is only possible within the same role.
    for j, (role, begins) in enumerate(STATES):
        if not begins:
            for i, (other, _) in enumerate(STATES):
                if other != role:
                    logs[1][i, j] = -1e6
            logs[0][j] = -1e6
    return Model(*logs)


def train(transcripts: DataFrame) -> Model:
    """Counts of at most TRAIN_CONVERSATIONS transcripts whose lines carry their true ``role``.

    ``transcripts`` has columns conv_id, line_no, line and role.
    """
    ids = transcripts.select("conv_id").distinct().orderBy(F.xxhash64("conv_id")).limit(TRAIN_CONVERSATIONS)
    one = Window.partitionBy("conv_id").orderBy("line_no")
    rows = (
        transcripts.join(F.broadcast(ids), "conv_id")  # bounded
        .where(F.col("line_no") < TRAIN_LINES)
        .select(
            F.col("conv_id").alias("conv"),
            "line_no",
            "line",
            "role",
            "begins",
            (F.row_number().over(one) == 1).alias("first"),
            F.coalesce(F.trim(F.lag("line").over(one)) == "", F.lit(False)).alias("after_blank"),
        )
        .orderBy("conv", "line_no")
        .toPandas()
    )
    rows = rows[rows["role"].isin(ROLES)]
    rows["state"] = [2 * ROLES.index(r) + (0 if b else 1) for r, b in zip(rows["role"], rows["begins"])]
    return count_model(rows)


def recover(transcripts: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """Every line as conv_id, line_no, line, role and begins (whether it begins a turn).

    ``transcripts`` has columns conv_id (not null), line_no (gapless from 0 in its transcript) and
    line; a null line reads as a blank one. Whether the line before is blank is not looked at across blocks.
    Empty tables give no rows.
    """
    lines = transcripts.select(
        "conv_id",
        F.expr(f"line_no div {block}").alias("block"),
        F.struct("line_no", F.coalesce("line", F.lit("")).alias("line"), (F.col("line_no") == 0).alias("first")).alias("entry"),
    )
    blocks = stage(
        lines.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("entry")).alias("entries")), "blocks"
    )

    def seen_of(entries) -> list[tuple[int, int, int]]:
        out, blank = [], False
        for e in entries:
            out.append(observe(e["line"], e["first"], blank))
            blank = not e["line"].strip()
        return out

    def matrices(frames):
        for frame in frames:
            found = [model.through(seen_of(e)).ravel().tolist() for e in frame["entries"]]
            yield pd.DataFrame({"conv_id": frame["conv_id"], "block": frame["block"], "matrix": found})

    k = len(STATES)

    def ends(frame: pd.DataFrame) -> pd.DataFrame:
        """Scores before each block, the state before it (-1: none) and the state it ends in."""
        frame = frame.sort_values("block")
        through = [np.array(m).reshape(k, k) for m in frame["matrix"]]
        scores = [model.start]
        for m in through:
            scores.append((scores[-1][:, None] + m).max(axis=0))
        state, states = int(scores[-1].argmax()), []
        for i in range(len(through) - 1, -1, -1):
            states.append(state)
            state = int((scores[i] + through[i][:, state]).argmax())
        states = states[::-1]
        return pd.DataFrame(
            {
                "conv_id": frame["conv_id"],
                "block": frame["block"],
                "before": [s.tolist() for s in scores[:-1]],
                "previous": [-1, *states[:-1]],
                "last": states,
            }
        )

    def decode(frames):
        for frame in frames:
            out = []
            for conv, entries, before, previous, last in zip(*(frame[c] for c in ("conv_id", "entries", "before", "previous", "last"))):
                states = model.decode(seen_of(entries), np.array(before), int(last))
                for e, s in zip(entries, states):
                    new = previous < 0 or STATES[s][1] or STATES[s][0] != STATES[previous][0]
                    out.append((conv, e["line_no"], e["line"], STATES[s][0], new))
                    previous = s
            yield pd.DataFrame(out, columns=["conv_id", "line_no", "line", "role", "begins"])

    id_type = transcripts.schema["conv_id"].dataType.simpleString()
    mats = blocks.select("conv_id", "block", "entries").mapInPandas(matrices, f"conv_id {id_type}, block bigint, matrix array<double>")
    # One row of 36 numbers per block.
    known = mats.groupBy("conv_id").applyInPandas(ends, f"conv_id {id_type}, block bigint, before array<double>, previous int, last int")
    return (
        blocks.join(known, ["conv_id", "block"])
        .select("conv_id", "entries", "before", "previous", "last")
        .mapInPandas(decode, f"conv_id {id_type}, line_no bigint, line string, role string, begins boolean")
    )


def turns(recovered: DataFrame) -> DataFrame:
    """Canonical turns: conv_id, turn (from 0), role, n_lines and the rendered text.
    """
    flagged = recovered.withColumn("_new", F.col("begins").cast("bigint"))
    numbered = running_total_before(flagged, ["conv_id"], "line_no", "_new", "_earlier").withColumn(
        "turn", (F.col("_earlier") + F.col("_new") - 1).cast("int")
    )

    @F.pandas_udf("string")
    def render(role: pd.Series, lines: pd.Series) -> pd.Series:
        return pd.Series(
            [
                f"<|{r}|>\n" + "\n".join([without_marker(found[0]), *found[1:]]).strip() + "\n<|end|>"
                for r, found in zip(role, lines)
            ]
        )

    grouped = numbered.groupBy("conv_id", "turn").agg(
        F.first("role").alias("role"), F.count("*").alias("n_lines"), F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("_lines")
    )
    return grouped.select(
        "conv_id", "turn", "role", "n_lines", render("role", F.col("_lines.line")).alias("rendered")
    )


# --- transcripts from turns -------------------------------------------------------

# How a conversation's speakers are marked, by the hash of its id; the last marks nobody.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "[system] ", "user": "[human] ", "assistant": "[ai] "},
    {"system": "### Instructions: ", "user": "### Question: ", "assistant": "### Answer: "},
    {"system": "", "user": "", "assistant": ""},
)


def from_turns(conversations: DataFrame) -> DataFrame:
    """Transcript lines of rows conv_id, turn, role, text, with the true role of each line.

    A conversation is written in one of STYLES. Turns are split into lines; rows of one turn
    number follow each other by role and text. A null text is a blank line, a null or negative
    turn counts as 0, and rows without a conversation id are left out.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES))).cast("int")
    mark = F.lit("")
    for i, names in enumerate(STYLES):
        for role, text in names.items():
            mark = F.when((style == i) & (F.col("role") == role), F.lit(text)).otherwise(mark)
    turn = F.greatest(F.coalesce("turn", F.lit(0)).cast("bigint"), F.lit(0).cast("bigint"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        turn.alias("turn"),
        "role",
        F.split(F.concat(mark, F.coalesce("text", F.lit(""))), "\n").alias("lines"),
    )
    # Rows that share a turn number follow each other.
    together = rows.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(F.struct("role", "lines"))).alias("rows"))
    counted = together.withColumn("n", F.expr("aggregate(rows, 0L, (n, r) -> n + size(r.lines))"))
    placed = running_total_before(counted, ["conv_id"], "turn", "n", "before")
    flat = F.expr(
        "flatten(transform(rows, r -> transform(r.lines, (line, i) -> struct(line, r.role as role, i = 0 as begins))))"
    )
    return placed.select("conv_id", "before", F.posexplode(flat).alias("at", "entry")).select(
        "conv_id", (F.col("before") + F.col("at")).cast("bigint").alias("line_no"), "entry.line", "entry.role", "entry.begins"
    )

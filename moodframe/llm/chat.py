"""Chat formatting: the roles in transcripts by a hidden Markov model, then
turns rendered in one canonical form.

A turn's text is cut into segments at lines that begin with a speaker marker
("User:", "**Assistant**:", "<|im_start|>system" ...). Each segment shows a few
discrete features: the role its marker names, its length, question marks, code,
lists. The hidden Markov model over the roles says how likely a role follows
another and a feature shows under a role; it is counted on all labelled turns.
Viterbi finds the likeliest roles of a conversation.

The model is a table of counts of fixed size. Viterbi is a product of small
matrices in (max, +): a conversation's distinct rows are numbered and
cut into blocks of ``BLOCK``, each block becomes one roles x roles matrix, the matrices of a
conversation are folded in turn, which gives the role before and at the end of
each block, and every block is traced back alone. A task holds one block's texts
or one matrix per block, however long a conversation is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodframe.llm.common import stored
from moodframe.operators.sequence import dense_index

ROLES = ("system", "user", "assistant")
S = len(ROLES)
BLOCK = 512

# Names of speakers as transcripts write them, by the role they stand for.
_NAMES = {
    "system": ("system", "instructions", "instruction", "context"),
    "user": ("user", "human", "q", "question", "customer", "client", "prompter"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "model", "agent", "response"),
}
_ROLE_OF = {name: role for role, names in _NAMES.items() for name in names}
_NAME = "(" + "|".join(sorted(_ROLE_OF, key=len, reverse=True)) + ")"
#: "<|user|>", "<|im_start|>user", "[User]", "### User:", "**User:**", "User:", "> User:"
_MARKER = re.compile(
    rf"[ \t>#*]*(?:<\|(?:im_start\|>)?{_NAME}(?:\|>)?|\[{_NAME}\]:?|{_NAME}[ \t]*(?:\*\*:|:\*\*|:))[ \t]*", re.I)
_LIST = re.compile(r"^[ \t]*(?:[-*]|\d+[.)]) ", re.M)
#: How many values each feature has: marker, length, question, code, list, lines.
SIZES = (S + 1, 8, 2, 2, 2, 4)
#: Counts the model starts from: a marker means what it says.
_MARKER_PRIOR = 200.0


def segments(text: str | None) -> list[tuple[int, str]]:
    """(marker, text without it) in order; marker 0 is none, r + 1 names role r.
    A text without markers, null or empty, is one segment."""
    found: list[tuple[int, list[str]]] = []
    for line in (text or "").split("\n"):
        if m := _MARKER.match(line):
            name = next(g for g in m.groups() if g).lower()
            found.append((1 + ROLES.index(_ROLE_OF[name]), [line[m.end():]]))
        elif found:
            found[-1][1].append(line)
        else:
            found.append((0, [line]))
    if len(found) > 1 and not found[0][0] and not "".join(found[0][1]).strip():
        del found[0]  # blank lines before the first marker
    return [(marker, "\n".join(lines)) for marker, lines in found]


def features(marker: int, text: str) -> list[int]:
    return [marker, min(7, (text.count(" ") + 1).bit_length()), int("?" in text), int("```" in text),
            int(bool(_LIST.search(text))), min(3, text.count("\n"))]


@dataclass
class Model:
    """Log probabilities of the first role, of one role after another, and of
    each feature's values under each role."""

    start: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        x = np.array(rows)
        return sum(e[:, x[:, k]].T for k, e in enumerate(self.emit))


def _log_share(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.5) / (counts + 0.5).sum(axis=-1, keepdims=True))


def _units(turns: DataFrame, conv: str, turn: str, text: str, role: str | None) -> DataFrame:
    """Distinct rows (conv, turn, text, role) with ``copies``, their place ``at``
    in the conversation and their block of ``BLOCK`` rows. Null turns come last."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(text).alias("text"),
                        (F.col(role) if role else F.lit(None).cast("string")).alias("role"))
    rows = rows.groupBy("conv", "turn", "text", "role").agg(F.count("*").alias("copies")).withColumn("untimed", F.col("turn").isNull())
    placed = dense_index(rows, ["conv"], ["untimed", "turn", "text", "role"], index_col="at", count_col=None, long_groups=True)
    return placed.drop("untimed").withColumn("block", F.floor(F.col("at") / BLOCK))


def _sorted(table: pa.Table) -> list[dict]:
    """Rows of a block in turn; rows of one turn number by text."""
    return table.sort_by("at").to_pylist()


def fit_roles(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", role: str = "role") -> Model:
    """Count the model on all turns whose role is one of ``ROLES``. Repeated rows
    count once. Without labelled turns the model knows markers only."""
    width = S + S * S + S * sum(SIZES)

    def count(table: pa.Table) -> pa.Table:
        total = np.zeros(width)
        start, step, emit = total[:S], total[S:S + S * S].reshape(S, S), total[S + S * S:]
        before = None
        for k, r in enumerate(_sorted(table)):
            now = ROLES.index(r["role"]) if r["role"] in ROLES else None
            if now is not None:
                if before is not None:
                    step[before, now] += 1
                elif k == 0 and r["block"] == 0:
                    start[now] += 1
                for marker, part in segments(r["text"])[:1]:
                    at = 0
                    for v, size in zip(features(marker, part), SIZES, strict=True):
                        emit[at + now * size + v] += 1
                        at += S * size
            before = now
        return pa.Table.from_pydict({"n": [total.tolist()]}, schema=pa.schema([("n", pa.list_(pa.float64()))]))

    parts = _units(turns, conv, turn, text, role).groupBy("conv", "block").applyInArrow(count, "n array<double>")
    total = np.zeros(width)
    for r in parts.select(F.posexplode("n").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).collect():
        total[r.k] = r.v  # width rows, whatever the input
    emit, at = [], S + S * S
    for size in SIZES:
        emit.append(total[at:at + S * size].reshape(S, size).copy())
        at += S * size
    emit[0][:, 0] += _MARKER_PRIOR
    emit[0][np.arange(S), np.arange(S) + 1] += _MARKER_PRIOR
    return Model(_log_share(total[:S]), _log_share(total[S:S + S * S].reshape(S, S)), [_log_share(e) for e in emit])


def trace(model: Model, scores: np.ndarray, before: int | None, last: int | None) -> list[int]:
    """The likeliest roles given the role before (None: a conversation begins)
    and the role of the last segment (None: free). Ties go to the first role."""
    best = (model.start if before is None else model.step[before]) + scores[0]
    back = []
    for s in scores[1:]:
        ways = best[:, None] + model.step
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + s
    path = [int(best.argmax()) if last is None else last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def recover_roles(turns: DataFrame, model: Model, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """One row per segment of every row of ``turns``: conv, turn, seg (its place
    in the turn's text, from 0), role (recovered), text (without its marker) and
    ``rendered``, the canonical turn.

    A null text is an empty one. Null conversation ids are one conversation, null
    turns come last in it, rows of one turn number are ordered by text. Repeated
    rows get the same result each and count once in the sequence. Other columns
    are not read. An empty table gives an empty result.
    """
    def reduced(table: pa.Table) -> pa.Table:
        rows = [features(*s) for r in _sorted(table) for s in segments(r["text"])]
        scores = model.scores(rows)
        # row b: best scores by last role after role b before the block; the extra row: at a conversation's start
        best = np.vstack([model.step, model.start[None]]) + scores[0]
        for s in scores[1:]:
            best = (best[:, :, None] + model.step[None]).max(axis=1) + s
        return pa.Table.from_arrays([table.column("conv").slice(0, 1), table.column("block").slice(0, 1),
                                     pa.array([best.ravel().tolist()], pa.list_(pa.float64()))], names=["conv", "block", "best"])

    def borders(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        all_best = [np.array(b).reshape(S + 1, S) for b in table.column("best").to_pylist()]
        score, back = all_best[0][S], []
        for b in all_best[1:]:
            ways = score[:, None] + b[:S]
            back.append(ways.argmax(axis=0))
            score = ways.max(axis=0)
        last = [int(score.argmax())]
        for b in reversed(back):
            last.append(int(b[last[-1]]))
        last.reverse()
        return pa.Table.from_arrays([table.column("conv"), table.column("block"), pa.array([None, *last[:-1]], pa.int32()),
                                     pa.array(last, pa.int32())], names=["conv", "block", "before", "last"])

    def traced(table: pa.Table) -> pa.Table:
        rows, before, last = _sorted(table), table.column("before")[0].as_py(), table.column("last")[0].as_py()
        parts = [(r, k, s) for r in rows for k, s in enumerate(segments(r["text"]))]
        path = trace(model, model.scores([features(*s) for _, _, s in parts]), before, last)
        return pa.Table.from_arrays(
            [pa.array([r["conv"] for r, _, _ in parts], table.schema.field("conv").type), pa.array([r["turn"] for r, _, _ in parts], pa.int64()),
             pa.array([k for _, k, _ in parts], pa.int32()), pa.array([ROLES[p] for p in path], pa.string()),
             pa.array([s[1] for _, _, s in parts], pa.string()),
             pa.array([render(ROLES[p], s[1]) for p, (_, _, s) in zip(path, parts, strict=True)], pa.string()),
             pa.array([r["copies"] for r, _, _ in parts], pa.int64())],
            names=["conv", "turn", "seg", "role", "text", "rendered", "copies"])

    units = _units(turns, conv, turn, text, None)
    kind = units.schema["conv"].dataType.simpleString()
    matrices = units.groupBy("conv", "block").applyInArrow(reduced, f"conv {kind}, block long, best array<double>")
    ends = stored(matrices.groupBy("conv").applyInArrow(borders, f"conv {kind}, block long, before int, last int"), "chat")
    known = units.alias("u").join(ends.alias("e"), F.col("u.conv").eqNullSafe(F.col("e.conv")) & (F.col("u.block") == F.col("e.block"))).select(
        "u.*", "e.before", "e.last")
    done = known.groupBy("conv", "block").applyInArrow(
        traced, f"conv {kind}, turn long, seg int, role string, text string, rendered string, copies long")
    return done.select(F.col("conv").alias(conv), F.col("turn").alias(turn), "seg", "role", F.col("text").alias(text), "rendered",
                       F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def render(role: str, text: str) -> str:
    """``<|role|>``, the text and ``<|end|>`` on lines of their own. "<|" inside a
    text is written "<||", so that no text can look like a marker."""
    return f"<|{role}|>\n{text.replace('<|', '<||')}\n<|end|>\n"


_RENDERED = re.compile(r"<\|(\w+)\|>\n(.*?)\n<\|end\|>\n", re.S)


def parse_rendered(chat: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of rendered turns; the inverse of ``render``."""
    return [(role, text.replace("<||", "<|")) for role, text in _RENDERED.findall(chat)]

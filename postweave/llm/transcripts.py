"""Roles of transcript lines by a hidden Markov model, and canonical rendering of the turns.

A state is a role and whether a line begins a turn. Lines are seen as features: the kind of speaker marker
at their front, the line's length, its end, and the blank line before it. Emission and transition chances are counted on
labelled conversations, as one small table, and Viterbi's best path gives every line its role. Lines from one
beginning to the next are a turn, whose marker is taken off and which is rendered between canonical tags.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postweave.llm.batches import slabs
from postweave.plans.storage import stored

ROLES = ("system", "user", "assistant")
# A state is 2 * role + (0 at the beginning of a turn, 1 inside).
STATES = 2 * len(ROLES)

# Names that speakers go by, lower-case.
NAMES = {
    "system": ("system", "instructions", "context", "sys"),
    "user": ("user", "human", "you", "me", "q", "question", "customer", "prompt"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "agent", "model", "response"),
}
SPEAKER = {name: role for role, names in NAMES.items() for name in names}
MARKER = re.compile(
    r"\s*(?:\*\*)?(?:<\|\s*(\w+)\s*\|>|\[(\w+)\]|#{2,}\s*(\w+)\s*:?|\(?\d{0,2}:?\d{0,2}\)?\s*(\w+)\s*(?:\*\*)?\s*[:>])(?:\*\*)?[ \t]*", re.I
)

# Features of a line and the number of their values.
FEATURES = {"marker": len(ROLES) + 2, "length": 6, "end": 4, "blank": 2}

# Turns of a transcript, at most; a longer conversation makes several.
TURNS = 64
FOLDS, HELD_OUT = 5, 0
# Styles in which the conversations of the table are written down: how each role is marked.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "[SYSTEM] ", "user": "[HUMAN] ", "assistant": "[AI] "},
    {"system": "### Instructions: ", "user": "### Question: ", "assistant": "### Answer: "},
    {"system": "<|system|> ", "user": "<|user|> ", "assistant": "<|assistant|> "},
    {"system": "sys> ", "user": "me> ", "assistant": "bot> "},
    {"system": "**System**: ", "user": "**Q**: ", "assistant": "**A**: "},
)
# Of turns after the first, one of so many is written without a marker.
UNMARKED = 8


def marker_of(line: str) -> tuple[int, str]:
    """The kind of marker (role, an unknown speaker, or none) and the line without a known one."""
    found = MARKER.match(line)
    if not found:
        return len(ROLES) + 1, line
    role = SPEAKER.get(next(g for g in found.groups() if g).lower())
    return (len(ROLES), line) if role is None else (ROLES.index(role), line[found.end() :])


def line_features(lines: list[str]) -> np.ndarray:
    """Rows of feature values for the lines of a transcript; blank lines are no rows of their own."""
    out, blank = [], 0
    for line in lines:
        bare = line.strip()
        if not bare:
            blank = 1
            continue
        kind, rest = marker_of(line)
        length = min(5, len(rest) // 80)
        end = ".!".find(bare[-1]) + 1 if bare[-1] in ".!" else (3 if bare[-1] == "?" else 0)
        out.append((kind, length, end, blank))
        blank = 0
    return np.array(out, np.int64).reshape(-1, len(FEATURES))


class Chances:
    """Logarithms of initial, transition and emission chances.

    A hundredth of each distribution is even, so what training has never shown is as likely in every state.
    """

    def __init__(self, first: np.ndarray, steps: np.ndarray, emitted: list[np.ndarray]):
        def norm(counts: np.ndarray) -> np.ndarray:
            even = (counts.sum(axis=-1, keepdims=True) + 1) / (100 * counts.shape[-1])
            return np.log((counts + even) / (counts + even).sum(axis=-1, keepdims=True))

        possible = np.array([[not (b % 2 and b // 2 != a // 2) for b in range(STATES)] for a in range(STATES)])
        self.first = np.where(np.arange(STATES) % 2 == 0, norm(first), -np.inf)
        self.steps = np.where(possible, norm(steps), -np.inf)
        self.emitted = [norm(e) for e in emitted]

    def best_path(self, features: np.ndarray) -> np.ndarray:
        """Viterbi: the most likely states of all lines."""
        if not len(features):
            return np.zeros(0, np.int64)
        emission = sum(e[:, features[:, k]] for k, e in enumerate(self.emitted)).T
        score = self.first + emission[0]
        back = np.zeros((len(features), STATES), np.int64)
        for n in range(1, len(features)):
            paths = score[:, None] + self.steps
            back[n] = paths.argmax(axis=0)
            score = paths[back[n], np.arange(STATES)] + emission[n]
        states = np.empty(len(features), np.int64)
        states[-1] = score.argmax()
        for n in range(len(features) - 1, 0, -1):
            states[n - 1] = back[n, states[n]]
        return states


def turns_of(text: str, chances: Chances) -> tuple[list[tuple[str, str]], list[str]]:
    """(role, text) of the turns of a transcript, and the role of each line that is not blank."""
    lines = re.split(r"\r\n|\n|\r", text)
    path = chances.best_path(line_features(lines)).tolist()
    states = iter(path)
    out: list[tuple[str, list[str]]] = []
    for line in lines:
        if not line.strip():
            if out:
                out[-1][1].append("")
            continue
        state = next(states)
        kind, rest = marker_of(line)
        if state % 2 == 0 or not out:
            out.append((ROLES[state // 2], [rest if kind == state // 2 else line]))
        else:
            out[-1][1].append(line)
    return [(role, "\n".join(part).strip("\n")) for role, part in out], [ROLES[state // 2] for state in path]


def rendered(turns: list[tuple[str, str]]) -> str:
    """Canonical form; tags and backslashes inside a text are escaped, so that ``read_rendered`` gets the turns back."""
    escaped = lambda text: text.replace("\\", "\\\\").replace("<|", "<\\|")
    return "".join(f"<|{role}|>\n{escaped(text)}\n<|end|>\n" for role, text in turns)


def read_rendered(text: str) -> list[tuple[str, str]]:
    found = re.findall(r"<\|(\w+)\|>\n(.*?)\n<\|end\|>\n", text, re.S)
    return [(role, re.sub(r"\\(.)", r"\1", part)) for role, part in found]


def written_down(conversations: DataFrame, turns: int = TURNS, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """Transcripts (conv_id, part, text, roles, begins) of conversation rows, with the truth about their lines.

    The style of a conversation, whether blank lines part its turns, and which turns go without a marker, are by hash. Equal rows count once; a transcript holds at most
    ``turns`` rows. Rows are dealt by conversation and run of turn numbers, sorted, and streamed, so a conversation of any length fills
    many transcripts in several tasks. Unknown or null roles are users, null turns come first, null texts are empty.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    ).distinct()
    run = F.coalesce(F.floor(F.col("turn") / turns), F.lit(0)).cast("long")
    rows = rows.withColumn("run", run).withColumn("style", F.pmod(F.xxhash64("conv_id", F.lit("style")), F.lit(2 * len(STYLES))).cast("int"))
    hidden = F.pmod(F.xxhash64("conv_id", "turn", "text"), F.lit(UNMARKED)) == 0
    rows = rows.withColumn("hidden", F.coalesce(hidden, F.lit(False)))
    dealt = rows.repartition("conv_id", "run").sortWithinPartitions("conv_id", "run", "turn", "role", "text")
    kind = conversations.schema[conv_id].dataType.simpleString()
    schema = f"conv_id {kind}, part long, text string, roles array<string>, begins array<boolean>"
    names = schema_names(schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        parts = 0
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                new = held and (held[0]["conv_id"], held[0]["run"]) != (row["conv_id"], row["run"])
                if new or len(held) == turns:
                    done.append(_transcript(held, parts))
                    parts = 0 if new else parts + 1
                    held = []
                held.append(row)
            if done:
                yield pa.RecordBatch.from_pydict({n: [d[n] for d in done] for n in names}, schema=_arrow(batch))
                last = batch
            elif held:
                last = batch
        if held:
            yield pa.RecordBatch.from_pydict({n: [_transcript(held, parts)[n]] for n in names}, schema=_arrow(last))

    return dealt.mapInArrow(write, schema)


def schema_names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _arrow(batch: pa.RecordBatch) -> pa.Schema:
    return pa.schema(
        [
            ("conv_id", batch.schema.field("conv_id").type),
            ("part", pa.int64()),
            ("text", pa.string()),
            ("roles", pa.list_(pa.string())),
            ("begins", pa.list_(pa.bool_())),
        ]
    )


def _transcript(rows: list[dict], part: int) -> dict:
    lines, roles, begins = [], [], []
    parted, style = divmod(rows[0]["style"], len(STYLES))
    style = STYLES[style]
    for k, row in enumerate(rows):
        role = row["role"] if row["role"] in ROLES else "user"
        own = [line for line in re.split(r"\r\n|\n|\r", row["text"] or "") if line.strip()] or [""]
        own[0] = own[0] if row["hidden"] and k and own[0] else style[role] + own[0]
        lines += [""] * (parted and k > 0) + own
        roles += [role] * len(own)
        begins += [n == 0 for n in range(len(own))]
    return {"conv_id": rows[0]["conv_id"], "part": rows[0]["run"] * 1_000_000 + part, "text": "\n".join(lines), "roles": roles, "begins": begins}


def fit(transcripts: DataFrame) -> Chances:
    """Counts of a table like ``written_down``; tasks add theirs up, and the driver gets one small row for each task's share."""
    sizes = [STATES, STATES * STATES, *(STATES * n for n in FEATURES.values())]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(sizes), np.int64)
        for batch in batches:
            for text, roles, begins in zip(*(batch.column(c).to_pylist() for c in ("text", "roles", "begins"))):
                states = np.array([2 * ROLES.index(r) + (not b) for r, b in zip(roles, begins)], np.int64)
                features = line_features(text.split("\n"))
                at = [states[:1], STATES + states[:-1] * STATES + states[1:]]
                start = STATES + STATES * STATES
                for k, n in enumerate(FEATURES.values()):
                    at.append(start + states * n + features[:, k])
                    start += STATES * n
                total += np.bincount(np.concatenate(at), minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int32()), "n": pa.array(total[cells], pa.int64())})

    rows = transcripts.select("text", "roles", "begins").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(sum(sizes))
    for row in rows:
        total[row.cell] = row.n
    first, steps, *emitted = np.split(total, np.cumsum(sizes)[:-1])
    return Chances(first, steps.reshape(STATES, STATES), [e.reshape(STATES, -1) for e in emitted])


PARSED = "turns", "line_roles", "rendered"
PARSED_SCHEMA = "turns array<struct<role:string,text:string>>, line_roles array<string>, rendered string"


def parse_transcripts(transcripts: DataFrame, chances: Chances, text: str = "text") -> DataFrame:
    """All columns of ``transcripts`` and ``turns`` (array of role and text), ``line_roles`` and ``rendered``.

    Null texts, and texts without words, have no turns. Columns of these names are replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in slabs(batches, text):
            found = [turns_of(t or "", chances) for t in batch.column(text).to_pylist()]
            turns = pa.array([[{"role": r, "text": t} for r, t in turns] for turns, _ in found], kind)
            roles = pa.array([roles for _, roles in found], pa.list_(pa.string()))
            forms = pa.array([rendered(turns) for turns, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, turns, roles, forms], names=[*batch.schema.names, *PARSED])

    kept = transcripts.drop(*PARSED)
    schema = T.StructType([*kept.schema.fields, *T._parse_datatype_string(PARSED_SCHEMA).fields])
    return kept.mapInArrow(run, schema)


def role_report(conversations: DataFrame) -> DataFrame:
    """Per transcript of the conversations: conv_id, part, held_out, n_turns and turns_found, n_lines and those
    whose role was recovered, the rendered form and its crc32.

    Chances are counted on conversations whose id's crc32 does not leave HELD_OUT modulo FOLDS.
    """
    transcripts = stored(written_down(conversations), "transcripts")
    held_out = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    chances = fit(transcripts.where(~held_out))
    parsed = parse_transcripts(transcripts, chances).withColumn("held_out", held_out)
    right = F.filter(F.zip_with("roles", "line_roles", lambda a, b: a == b), lambda same: same)
    return parsed.select(
        "conv_id",
        "part",
        "held_out",
        F.size(F.filter("begins", lambda b: b)).cast("long").alias("n_turns"),
        F.size("turns").cast("long").alias("turns_found"),
        F.size("roles").cast("long").alias("n_lines"),
        F.size(right).cast("long").alias("lines_right"),
        "rendered",
        F.crc32("rendered").alias("rendered_crc32"),
    )

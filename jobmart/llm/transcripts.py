"""Chat transcripts as canonical turns.

A transcript is lines of text in which speakers are marked in many ways, or not at all. A hidden Markov model has a
state for the first and for the later lines of each role's turn; a line is seen as its speaker marker, its ending, its
length, and whether a blank line precedes it. Viterbi's algorithm gives the likeliest states of the whole transcript,
from which turns are cut, stripped of their markers, and rendered in one form.

A long transcript is cut into segments, which are worked on apart and still get the states of the whole: of each
segment, the best scores from any state before it to any state at its end are a small table; passes over these tables
alone, forwards for the best scores and backwards for the states at the borders, tell each segment where it begins and
ends. Turns that go over a border are put together again.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import stored

ROLES = ["system", "user", "assistant"]
#: Names that speakers go by. Fixed values.
NAMES = {
    "system": "system", "instructions": "system", "context": "system",
    "user": "user", "human": "user", "customer": "user", "question": "user", "q": "user", "prompter": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "model": "assistant", "answer": "assistant",
    "a": "assistant", "agent": "assistant", "chatbot": "assistant",
}
_MARKER = re.compile(
    r"\s*(?:<\|?(?P<tag>[A-Za-z]{1,20})\|?>|\[(?P<box>[A-Za-z]{1,20})\]:?|#{1,4}[ \t]*(?P<head>[A-Za-z]{1,20})[ \t]*:?[ \t]*$"
    r"|(?:\*\*)?(?P<name>[A-Za-z][A-Za-z ]{0,19}):(?:\*\*)?(?=\s|$))[ \t]*"
)
#: The values of each feature of a line: marker, ending, length, and whether it follows a blank line.
MARKERS = ["none", *ROLES, "other"]
ENDINGS = ["blank", "question", "sentence", "colon", "open"]
SIZES = [0, 30, 80, 160, 320]
SHAPE = (len(MARKERS), len(ENDINGS), len(SIZES) + 1, 2)
STATES = 2 * len(ROLES)  # 2 * role for a first line, 2 * role + 1 for a later one


def marker(line: str) -> tuple[str, int]:
    """The kind of speaker marker at the start of a line, and where the text after it begins."""
    found = _MARKER.match(line)
    if not found:
        return "none", 0
    name = next(g for g in found.groups() if g is not None).strip().lower()
    role = NAMES.get(name)
    if role is None and found["name"] is None:
        return "none", 0  # brackets and headings are common; only known speakers count
    if role is None and not line.lstrip("* \t")[0].isupper():
        return "none", 0
    return role or "other", found.end()


def line_features(lines: Sequence[str], blank: bool = False) -> np.ndarray:
    """A row of the four features' numbers for each line; ``blank`` tells whether a blank one precedes the first."""
    rows = []
    for line in lines:
        bare = line.rstrip()
        last = bare[-1:]
        ending = 0 if not bare else 1 if last in "?？" else 2 if last in ".!…" else 3 if last in ":：" else 4
        size = sum(len(bare) > s for s in SIZES)
        rows.append((MARKERS.index(marker(line)[0]), ending, size, int(blank)))
        blank = not bare
    return np.array(rows, dtype=np.int64).reshape(-1, 4)


@dataclass(frozen=True)
class Model:
    """Logarithms: ``start`` of each state, ``move`` between states, and a table of ``emit`` per feature."""

    start: np.ndarray
    move: np.ndarray
    emit: tuple[np.ndarray, ...]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return sum(table[:, features[:, i]].T for i, table in enumerate(self.emit))

    def states(self, features: np.ndarray, entry: int | None = None, end: int | None = None) -> np.ndarray:
        """The likeliest states of all lines, after the state ``entry`` and with ``end`` for the last, if they are given.

        Of equally likely ones, those of lower number last in the transcript.
        """
        scores = self.scores(features)
        best, back = (self.start if entry is None else self.move[entry]) + scores[0], np.empty((len(scores), STATES), dtype=np.int8)
        for t in range(1, len(scores)):
            ways = best[:, None] + self.move
            back[t] = ways.argmax(0)
            best = ways.max(0) + scores[t]
        found = np.empty(len(scores), dtype=np.int64)
        found[-1] = best.argmax() if end is None else end
        for t in range(len(scores) - 1, 0, -1):
            found[t - 1] = back[t][found[t]]
        return found

    def table(self, features: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """The best scores over all lines, from each state before them to each at their end, and how many turns begin.

        Of a transcript's ``first`` lines nothing is before them, and all rows of the table are the same.
        """
        scores, new = self.scores(features), (np.arange(STATES) % 2 == 0).astype(np.int64)
        best = (np.tile(self.start, (STATES, 1)) if first else self.move) + scores[0]
        turns = np.tile(new, (STATES, 1))
        for row in scores[1:]:
            ways = best[:, :, None] + self.move
            via = ways.argmax(1)
            best = ways.max(1) + row
            turns = np.take_along_axis(turns, via, 1) + new
        return best, turns


def _logs(counts: np.ndarray, add: float) -> np.ndarray:
    smooth = counts + add
    return np.log(smooth / smooth.sum(-1, keepdims=True))


def fit(blocks: DataFrame, column: str = "blocks") -> Model:
    """A model by counting, from transcripts whose turns are known: ``column`` holds an array of role and block.

    Every row is counted, on the executors; only the counts come together. A later line continues its own turn, so
    these moves are fixed; markers of a role at the first line of another are smoothed to be rare. Blocks of an unknown
    role are not counted, and without any the model knows the markers alone.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[tuple[str, int, int]] = Counter()
        for batch in batches:
            for turns in batch[column]:
                states: list[int] = []
                lines: list[str] = []
                for turn in turns if turns is not None else ():
                    role = turn["role"]
                    if role not in ROLES:
                        continue
                    if lines:  # the blank line between two turns belongs to the one before
                        lines.append("")
                        states.append(states[-1] | 1)
                    own = (turn["block"] or "").split("\n")
                    state = 2 * ROLES.index(role)
                    states += [state] + [state + 1] * (len(own) - 1)
                    lines += own
                if not lines:
                    continue
                seen["start", 0, states[0]] += 1
                seen.update(("move", a, b) for a, b in zip(states, states[1:], strict=False))
                for state, row in zip(states, line_features(lines).tolist(), strict=True):
                    seen.update((f"emit{i}", state, v) for i, v in enumerate(row))
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["what", "a", "b", "n"])

    counts = blocks.select(column).mapInPandas(count, "what string, a int, b int, n long")
    start, move = np.zeros((1, STATES)), np.zeros((STATES, STATES))
    emit = [np.zeros((STATES, n)) for n in SHAPE]
    for row in counts.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect():
        table = start if row["what"] == "start" else move if row["what"] == "move" else emit[int(row["what"][4:])]
        table[row["a"], row["b"]] += row["n"]
    for role, name in enumerate(ROLES):
        emit[0][2 * role, MARKERS.index(name)] += 20
    first = np.arange(STATES) % 2 == 0
    start = _logs(start, 0.5)[0]
    start[~first] = -np.inf
    move = _logs(move, 0.5)
    for a in range(STATES):
        move[a, [b for b in range(STATES) if b % 2 and b // 2 != a // 2]] = -np.inf
    return Model(start, move, tuple(_logs(e, 0.1) for e in emit))


def turns_of(text: str, model: Model) -> list[tuple[str, str]]:
    """(role, text) of every turn of a transcript, without markers and without space at the ends."""
    lines = text.split("\n")
    found: list[tuple[str, list[str]]] = []
    for line, state in zip(lines, model.states(line_features(lines)).tolist(), strict=True):
        if state % 2 == 0:
            found.append((ROLES[state // 2], [line[marker(line)[1] :]]))
        else:
            found[-1][1].append(line)
    return [(role, "\n".join(own).strip()) for role, own in found]


def parse(text: Column, model: Model) -> Column:
    """An array of ``role`` and ``text`` for each transcript. A null or blank one has no turns."""

    @F.pandas_udf("array<struct<role: string, text: string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([turns_of(v, model) if v is not None and v.strip() else [] for v in batch])

    return run(text)


def render(turns: Column) -> Column:
    """The canonical form: each turn's role between bars, its text on the next lines, and a closing mark."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n<|end|>\n"))), "")


#: How the registered query writes speakers, by conversation, in the order of ``ROLES``.
STYLES = [
    ["System: ", "User: ", "Assistant: "], ["### System\n", "### Human\n", "### Assistant\n"],
    ["<|system|>", "<|user|>", "<|assistant|>"], ["[system] ", "[user] ", "[assistant] "],
    ["**Instructions:** ", "**Question:** ", "**Answer:** "], ["Context: ", "Q: ", "A: "],
]
#: One turn in so many has lost its marker.
LOST = 8
#: Turn numbers of a segment.
SEGMENT = 64
#: Rows without a turn number come first, in as many segments at most.
UNNUMBERED = 1 << 20


def written_out(conversations: DataFrame) -> DataFrame:
    """Conversations as raw transcripts: ``conv_id``, ``segment``, ``blocks`` (role and block) and ``transcript``.

    A conversation is cut into segments of ``SEGMENT`` turn numbers, so one of any length is never in one task; rows
    without a number come first and are dealt by a hash of their text. Turns are ordered by number, then role and text;
    null texts are empty, and a null or unknown role has no marker. Rows that repeat are turns of their own.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    known = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role"))
    names = F.array(*[F.array(*map(F.lit, s)) for s in STYLES])
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(LOST)) == 0
    mark = F.when((known > 0) & ~lost, F.get(F.get(names, style.cast("int")), (known - 1).cast("int"))).otherwise("")
    block = F.concat(mark, F.coalesce("text", F.lit("")))
    unnumbered = F.lit(-(1 << 60)) + F.pmod(F.xxhash64("text"), F.lit(UNNUMBERED))
    segment = F.coalesce(F.floor(F.col("turn") / SEGMENT).cast("long"), unnumbered)
    rows = conversations.select("conv_id", segment.alias("segment"), "turn", "role", block.alias("block"))
    grouped = rows.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "block"))).alias("blocks"))
    return grouped.withColumn("transcript", F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n"))


# -- whole transcripts in segments ----------------------------------------------

_TABLES = "inner array<double>, begun array<long>, outer array<double>, opened array<long>, ended boolean, filled boolean"


def _tables(text: Column, model: Model) -> Column:
    """Of each segment: the tables of ``Model.table`` after other segments and as the first; whether its last line is
    blank, and whether it has any text."""

    @F.pandas_udf(_TABLES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch:
                lines = (value or "").split("\n")
                inner, begun = model.table(line_features(lines, True), False)
                outer, opened = model.table(line_features(lines), True)
                out.append((inner.ravel(), begun.ravel(), outer[0], opened[0], not lines[-1].rstrip(), bool((value or "").strip())))
            yield pd.DataFrame(out, columns=["inner", "begun", "outer", "opened", "ended", "filled"])

    return run(text)


def _borders(tables: DataFrame, model: Model, name: str) -> DataFrame:
    """``conv``, ``segment``, whether it is the ``first`` and the ``last``, its ``entry`` and ``end`` states, and the
    turns ``before`` it.

    The passes read one small row a segment, conversation by conversation, and hold one at a time. A blank line between
    two segments belongs to the one before it.
    """
    blank = [model.move + model.scores(line_features([""], b))[0] for b in (False, True)]
    shape = (STATES, STATES)

    def rows_of(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            yield from batch.itertuples()

    def forwards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, conv, best = [], None, None
        for row in rows_of(batches):
            first = row.conv != conv
            ahead = np.zeros(STATES) if first else best
            own = row.outer if first else (ahead[:, None] + np.reshape(row.inner, shape)).max(0)
            best = (own[:, None] + blank[int(row.ended)]).max(0)
            conv = row.conv
            out.append((*row[1:9], first, ahead, own))
            if len(out) >= 5_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    def backwards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, conv, state = [], None, None
        for row in rows_of(batches):
            last = row.conv != conv
            own = np.asarray(row.own)
            # The state of the last line, and with it that of the blank line after it.
            at = int(own.argmax()) if last else int((own + blank[int(row.ended)][:, state]).argmax())
            end = at if last else state
            if row.first:
                entry, turns = None, row.opened[at]
            else:
                entry = int((np.asarray(row.ahead) + np.reshape(row.inner, shape)[:, at]).argmax())
                turns = row.begun[entry * STATES + at]
            turns += 0 if last else end % 2 == 0
            out.append((row.conv, row.segment, bool(row.first), last, entry, end, int(turns), bool(row.filled)))
            conv, state = row.conv, entry
            if len(out) >= 5_000:
                yield pd.DataFrame(out, columns=names).astype({"entry": "Int64"})
                out = []
        yield pd.DataFrame(out, columns=names).astype({"entry": "Int64"})

    columns = ["conv", "segment", "inner", "begun", "outer", "opened", "ended", "filled", "first", "ahead", "own"]
    names = ["conv", "segment", "first", "last", "entry", "end", "turns", "filled"]
    dealt = tables.repartition("conv").sortWithinPartitions("conv", "segment")
    there = dealt.mapInPandas(forwards, f"conv string, segment long, {_TABLES}, first boolean, ahead array<double>, own array<double>")
    there = stored(there, name).repartition("conv").sortWithinPartitions("conv", F.desc("segment"))
    back = there.mapInPandas(backwards, "conv string, segment long, first boolean, last boolean, entry long, end long, turns long, filled boolean")
    whole = Window.partitionBy("conv")
    before = F.sum("turns").over(whole.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    return back.select("*", F.coalesce(before, F.lit(0)).alias("before"), F.max("filled").over(whole).alias("any")).where("any").drop("any", "turns", "filled")


def whole_turns(segments: DataFrame, model: Model) -> DataFrame:
    """``conv_id``, ``turn`` (counted from 0), ``role``, ``text`` and ``rendered`` of each turn of each conversation.

    ``segments`` has conv_id, segment (its order) and transcript, and each pair once; null transcripts are empty. The
    result is that of ``turns_of`` over all transcripts of a conversation, joined by blank lines, but for ties between
    equally likely states. A conversation
    without any text has no turns. A null conversation is one like any other.
    """
    # Conversations of any type, null too, by one text that names them.
    keyed = segments.select("conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), "segment", "transcript")
    keyed = stored(keyed, "segments")
    tables = stored(keyed.select("conv", "segment", _tables(F.col("transcript"), model).alias("t")).select("conv", "segment", "t.*"), "segment-tables")
    borders = stored(_borders(tables, model, "segment-scores"), "segment-borders")

    @F.pandas_udf("array<struct<place: long, role: string, text: string, border: boolean>>")
    def cut(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for texts, firsts, lasts, entries, ends in batches:
            out = []
            for text, first, last, entry, end in zip(texts, firsts, lasts, entries, ends, strict=True):
                lines = (text or "").split("\n") + ([] if last else [""])
                features = line_features(lines, not first)
                found: list[tuple[int, list[str]]] = []
                states = model.states(features, None if first else int(entry), int(end)).tolist()
                for line, state in zip(lines, states, strict=True):
                    if state % 2 == 0:
                        found.append((state // 2, [line[marker(line)[1] :]]))
                    elif found:
                        found[-1][1].append(line)
                    else:  # the turn of the segment before goes on
                        found.append((state // 2, [line]))
                goes_on = states[0] % 2 == 1
                out.append([
                    {
                        "place": k - goes_on, "role": ROLES[role], "text": "\n".join(own),
                        "border": bool((k == 0 and goes_on) or (k + 1 == len(found) and not last)),
                    }
                    for k, (role, own) in enumerate(found)
                ])
            yield pd.Series(out)

    parts = keyed.join(borders, ["conv", "segment"]).select(
        "conv_id", "segment", "before", F.inline(cut("transcript", "first", "last", "entry", "end"))
    )
    parts = stored(parts.select("conv_id", "segment", (F.col("before") + F.col("place")).alias("turn"), "role", "text", "border"), "turn-parts")
    joined = parts.where("border").groupBy("conv_id", "turn").agg(
        F.min(F.struct("segment", "role")).alias("first"), F.array_sort(F.collect_list(F.struct("segment", "text"))).alias("own")
    )
    joined = joined.select("conv_id", "turn", "first.role", F.array_join(F.transform("own", lambda x: x["text"]), "\n").alias("text"))
    inside = parts.where("not border").select("conv_id", "turn", "role", "text")
    turns = inside.unionByName(joined).select("conv_id", "turn", "role", _stripped(F.col("text")).alias("text"))
    return turns.withColumn("rendered", render(F.array(F.struct("role", "text"))))


def _stripped(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.str.strip()

    return run(text)

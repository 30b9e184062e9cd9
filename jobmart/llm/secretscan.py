"""Secrets in texts: fixed patterns, and a conditional random field for what they miss.

The patterns find assignments, access keys and long hexadecimal runs. The field tags tokens as begin, inside or
outside of a secret by their shape, their neighbours and the look of the file; it learns from what the patterns
find, often without the telling word in front, and from secrets of further kinds made by a seeded grammar.

A secret has no separator inside, so chunks between separators are decoded one after the other, whatever their length;
only those shorter than any secret are passed by.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.crf import BEGIN, INSIDE, OUTSIDE, Field, train

#: The patterns, the group that is the secret, and its least length.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "crf"]
LEAST = {"assign": 8, "access": 16, "hex": 32, "crf": 8}
_WORDS = ("passw", "secret", "token", "apikey", "api_key")

_LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CHUNK = re.compile(r"[^\x20\x09-\x0D]{8,}")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_DIGIT = re.compile(r"[0-9]")
_HEX_LETTERS = frozenset("abcdef")
_TOKEN = re.compile(r"[^\W_]+|[^\w\x20\x09-\x0D]|_+")
_PROSE = re.compile(r"([^\w\x20\x09-\x0D]{0,3})([^\W\d_]+)([^\w\x20\x09-\x0D]{0,6})")
#: A chunk longer than this is learned from in parts of as many characters; it is decoded as a whole.
CHUNK = 2_000

SAMPLE_DOCS = 12_000
SAMPLE_CHUNKS = 4_000
CHUNKS_PER_DOC = 20
#: Chunks without a secret that are learned from, for each one with.
OTHERS = 5

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of all matches of the patterns that are long enough, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # A maximal run is found by either form; this one passes by the short runs of ordinary words.
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def secret_values(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """The secrets themselves: of an assignment, what is assigned."""
    return [ASSIGN.match(text, a).span(2) if kind == 0 else (a, b) for a, kind, b in spans]


def open_chunks(text: str) -> Iterator[tuple[int, int]]:
    """Runs between separators that may hold a secret: all that are long enough for one."""
    return (m.span() for m in _CHUNK.finditer(text))


# -- features -----------------------------------------------------------------


def _size(n: int) -> str:
    return str(min(n.bit_length(), 7))


def _shape(token: str) -> str:
    kinds = ["X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in token[:64]]
    return "".join(k for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k)[:8]


def file_features(text: str) -> list[str]:
    """The look of a file: how long its lines are, and how much of it is assignments and digits."""
    n = len(text) + 1
    lines = text.count("\n") + 1
    return [f"doc.line{_size(n // lines // 16)}", f"doc.eq{min(3, 1000 * text.count('=') // n)}",
            f"doc.at{min(2, 1000 * text.count('@') // n)}"]


def _bare(word: str) -> str:
    return word.lower().strip("\"'")


def context_features(second: str, first: str, ahead: str) -> list[str]:
    """Of a whole chunk: the two words before it and the first character of the one after it; empty if there is none."""
    if not first:
        before = ["prev=none"]
    else:
        before = [f"key.prev={_bare(first)[:40]}", f"key.mark={first[-1]}", f"key.prev2={_bare(second)[:40]} {_bare(first)[:40]}"]
    return [*before, _next(ahead)]


def _next(ahead: str) -> str:
    kind = "none" if not ahead else "x" if ahead[0].isalpha() else "9" if ahead[0].isdigit() else ahead[0]
    return f"next={kind}"


def token_features(chunk: str) -> tuple[list[tuple[int, int]], list[list[str]]]:
    """A chunk's tokens and the features of each that need nothing but the chunk; telling words begin with ``key``."""
    spans = [m.span() for m in _TOKEN.finditer(chunk)]
    names = [chunk[a:b] for a, b in spans]
    shapes = [_shape(name) for name in names]
    whole = ["chunk.at"] * ("@" in names) + ["chunk.url"] * ("/" in names and ":" in names)
    rows = []
    for i, name in enumerate(names):
        low, size = name.lower(), _size(len(name))
        letters, digits = any(c.isalpha() for c in name), any(c.isdigit() for c in name)
        case = "both" if low != name and name.upper() != name else "one"
        row = [
            "bias", f"shape={shapes[i]}", f"size={size}", f"shape.size={shapes[i][:4]}.{size}",
            f"mixed={letters and digits}.{case}.{size}", f"turns={min(len(shapes[i]), 6)}.{size}",
            f"hex={all(c in '0123456789abcdef' for c in low)}.{digits}.{size}",
            f"varied={len(set(low)) * 8 // len(low)}.{size}", f"start={name[:3] if digits and letters and len(name) > 7 else ''}",
            f"first={i == 0}", f"last={i == len(names) - 1}",
            f"left.shape={shapes[i - 1] if i else 'none'}", f"right.shape={shapes[i + 1] if i + 1 < len(names) else 'none'}",
        ]
        # The last two words before the token in its chunk, whatever marks stand between.
        said = [n.lower() for n in names[max(0, i - 6) : i] if n[0].isalpha() and len(n) < 16][-2:]
        if said and name[0].isalnum():
            row += [f"key.left={said[-1]}", f"key.left2={' '.join(said)}", f"key.mark={names[i - 1][-1]}"]
        rows.append(row + whole)
    return spans, rows


def prose_signature(ahead: str, word: str, behind: str) -> tuple:
    """All that ``token_features`` depend on, of a word of letters between a few marks."""
    low = word.lower()
    letters, size = set(low), len(low)
    if word == low:
        return size.bit_length(), len(letters) * 8 // size, letters <= _HEX_LETTERS, ahead, behind
    return size.bit_length(), len(letters) * 8 // size, letters <= _HEX_LETTERS, ahead, behind, _shape(word), word.upper() == word


# -- examples -----------------------------------------------------------------


def _tagged(text: str, spans: list[tuple[int, int]], values: list[tuple[int, int]]) -> list[int]:
    tags: list[int] = []
    for i, (x, y) in enumerate(spans):
        inside = next((v for v in values if v[0] <= x and y <= v[1]), None)
        continued = inside and i and tags[-1] != OUTSIDE and spans[i - 1][0] >= inside[0]
        tags.append(OUTSIDE if not inside else INSIDE if continued else BEGIN)
    return tags


def examples(text: str, values: list[tuple[int, int]] | None = None) -> list[tuple[list[list[str]], list[int]]]:
    """Tagged chunks of a text, as the patterns see them; of many, those spread evenly over the text.

    Each secret found is an example once more as a chunk of its own, without its surroundings: so the field learns what
    secrets look like, not only which words announce them.
    """
    values = secret_values(text, base_spans(text)) if values is None else values
    found, file = [], file_features(text)
    places = [m.span() for m in _WORD.finditer(text)]
    names = ["", "", *[text[a:b] for a, b in places], ""]
    chunks = [(k, i, min(i + CHUNK, b)) for k, (a, b) in enumerate(places) if b - a >= LEAST["crf"] for i in range(a, b, CHUNK)]
    # Words without a digit or a long run are by far the most: they are half of the examples at most.
    telling = [bool(_DIGIT.search(text, a, b) or _LONG.search(text, a, b)) for _, a, b in chunks]
    holding = [any(a < y and x < b for x, y in values) for _, a, b in chunks]
    picked = [c for c, h in zip(chunks, holding, strict=True) if h][:CHUNKS_PER_DOC]
    for kind, n in ((True, CHUNKS_PER_DOC), (False, CHUNKS_PER_DOC // 2)):
        own = [c for c, t, h in zip(chunks, telling, holding, strict=True) if t == kind and not h]
        picked += own[:: max(1, len(own) // n)][:n]
    for k, a, b in sorted(picked):
        spans, rows = token_features(text[a:b])
        context = context_features(names[k], names[k + 1], names[k + 3]) + file
        tags = _tagged(text, [(a + x, a + y) for x, y in spans], values)
        found.append(([row + context for row in rows][:64], tags[:64]))
    for x, y in values[:CHUNKS_PER_DOC]:
        if not _DIGIT.search(text, x, y):
            continue  # letters alone are a secret only by what is around them
        _, rows = token_features(text[x : min(y, x + CHUNK)])
        if rows:
            found.append((rows[:64], ([BEGIN] + [INSIDE] * len(rows))[: len(rows)][:64]))
    return found


#: What announces secrets that the patterns know nothing of, and what is as long but harmless.
ANNOUNCED = [
    "pwd: {w}", "pwd={r}", "pass: {w}", "passphrase={w}", "passphrase: {r}", "credentials: {r}", "credential={r}",
    "Authorization: Bearer {r}", "bearer {r}", "aws_secret_access_key = {b}", "secret_access_key={b}", "client_secret: {r}",
    "private_key={b}", "access_key: {k}", "auth={r}", "pin code {r}", "{v}{r}", "using {v}{r} here", "login {r} there",
    "the key was {k} and", "key {k}", "{k}", "{r}", "signature={b}", "license key: {d}", "webhook {r}", "--key {r}",
]
VENDORS = ["ghp_", "gho_", "glpat-", "sk_live_", "pk_test_", "xoxb-", "npm_", "AIza", "ASIA", "hf_", "dop_v1_", "SG."]
HARMLESS = [
    "see https://www.{w}.example/{w}/{n}.html for more", "write to {w}.{w}@{w}.example now", "call {n}-{n}-{n} at once",
    "from {n}.{n}.{n}.{n} to the host", "on 20{n}-0{n}-1{n} at noon", "in version {n}.{n}.{n}-beta of it", "name={w}", "size: {n}",
    "{w}_{w}_{w}({w}, {n})", "/usr/{w}/{w}/{w}.txt", "key: {w}", "user={w}", "{W}{W}Exception", "<div class='{w}'>", "{w}-{w}-{w}",
    "the {w} and {w} of {w}", "total {n}{n}{n} units", "id={n}", "{W} {w}, {w}.", "{w}: {w}", "{n}px {n}em #{n}", "{w};{w};{n}", "{l}", "{l}, {l} {l}.", "{L} {l}", "({l})", "{w} {l}: {l}",
]
#: Examples made of these: secrets, and harmless ones.
MADE = 600


def made_examples(seed: int = 13, rows: int = MADE) -> list[tuple[list[list[str]], list[int]]]:
    """Secrets and harmless texts by a seeded grammar, for kinds of secrets that the patterns teach nothing of."""
    draw = random.Random(seed)
    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    sounds = [a + b for a in "bcdfghjklmnprstvw" for b in ("a", "e", "i", "o", "u", "an", "er", "ion", "or")]

    def word(least: int = 3) -> str:
        out = ""
        while len(out) < least:
            out += draw.choice(sounds)
        return out

    def many(letters: str, low: int, high: int) -> str:
        return "".join(draw.choices(letters, k=draw.randrange(low, high)))

    def secret(kind: str) -> str:
        if kind == "w":
            return word(draw.randrange(12, 26))
        if kind == "k":
            return many(upper + digit, 16, 30)
        if kind == "b":
            return many(lower + upper + digit + "/+", 30, 50)
        if kind == "d":
            return "-".join(many(upper + digit, 5, 6) for _ in range(4))
        return many(draw.choice([lower + upper + digit, lower + digit, lower + upper + digit]), 14, 44)

    found = []
    for i in range(rows):
        around = [" ".join(word(draw.randrange(2, 11)) for _ in range(draw.randrange(0, 8))) for _ in range(2)]
        form = draw.choice(ANNOUNCED)
        place, kind = form.index("{"), form[form.index("{", form.index("{v}") + 3 if "{v}" in form else 0) + 1]
        value = (draw.choice(VENDORS) if "{v}" in form else "") + secret(kind)
        text = f"{around[0]} {form[:place]}"
        start = len(text)
        text += value + form[form.rindex("}") + 1 :] + " " + around[1]
        found += examples(text, [(start, start + len(value))])
        form = HARMLESS[i % len(HARMLESS)]
        while "{" in form:
            name = form[form.index("{") + 1]
            part = many(digit, 1, 5) if name == "n" else word(draw.randrange(*(8, 26) if name in "lL" else (3, 9)))
            form = form.replace("{" + name + "}", part.capitalize() if name.isupper() else part, 1)
        found += examples(f"{around[1]} {form} {word(8)} {around[0]}", [])
    return found


# -- scanning -----------------------------------------------------------------


class Scanner:
    """Finds all spans of a text. What only depends on the form of a chunk is worked out once for each form.

    A chunk whose tokens cannot reach a secret in its context is passed by without decoding; the result is the same.
    """

    #: Chunks that are remembered.
    REMEMBERED = 50_000

    def __init__(self, field: Field | None):
        self.field = field
        self._chunks: dict = {}
        if field is None:
            return
        # How much each feature of a context lifts a token into a secret, at most.
        self._lift = {}
        for f, i in field.index.items():
            if f.startswith(("key.", "next=", "prev=", "doc.")):
                e = field.emit[i]
                self._lift[f] = float(max(e[BEGIN], e[INSIDE]) - e[OUTSIDE])
        self._before = {f.removeprefix("key.prev="): x for f, x in self._lift.items() if f.startswith("key.prev=")}
        self._marks = {f.removeprefix("key.mark="): x for f, x in self._lift.items() if f.startswith("key.mark=")}
        self._pairs = {f.removeprefix("key.prev2="): x for f, x in self._lift.items() if f.startswith("key.prev2=")}

    def _sum(self, features: list[str]) -> np.ndarray:
        index, emit = self.field.index, self.field.emit
        at = [i for f in features if (i := index.get(f)) is not None]
        return emit[at].sum(0) if at else np.zeros(3, dtype=emit.dtype)

    def _scored(self, chunk: str) -> tuple:
        """The tokens' places and scores, and by how much the best tags with n tagged tokens beat none, for each n."""
        spans, rows = token_features(chunk)
        scores = np.array([self._sum(row) for row in rows]).reshape(-1, 3)
        return spans, scores, list(enumerate(self.field.gains(scores), 1)) if 0 < len(spans) <= 12 else None

    def _gains(self, chunk: str) -> list[tuple[int, float]] | None:
        """The last part of ``_scored``, None if only decoding tells; prose words of one form share it."""
        prose = _PROSE.fullmatch(chunk)
        form = chunk
        if prose:
            form = prose_signature(*prose.groups())
        if form in self._chunks:
            return self._chunks[form]
        gains = self._scored(chunk)[2]
        if len(chunk) <= 64:
            if len(self._chunks) >= self.REMEMBERED:
                self._chunks.clear()
            self._chunks[form] = gains
        return gains

    def field_spans(self, text: str, *, skip: bool = True) -> list[tuple[int, int]]:
        """The spans of the field alone, at least as long as a secret."""
        places = file = None
        names, found = ["", "", *_WORD.findall(text), ""], []
        lifts, before, marks, pairs = self._lift, self._before, self._marks, self._pairs
        for k in range(2, len(names) - 1):
            name = names[k]
            if len(name) < 8:
                continue
            if file is None:
                file = file_features(text)
                file_lift = sum(lifts.get(f, 0.0) for f in file)
            gains = self._gains(name) if skip else None
            if gains is not None:
                first = names[k - 1]
                if first:
                    bare = _bare(first)[:40]
                    lift = file_lift + before.get(bare, 0.0) + marks.get(first[-1], 0.0) + lifts.get(_next(names[k + 1]), 0.0)
                    if bare in before:  # a pair is known only if its second word is
                        lift += pairs.get(f"{_bare(names[k - 2])[:40]} {bare}", 0.0)
                else:
                    lift = file_lift + lifts.get("prev=none", 0.0) + lifts.get(_next(names[k + 1]), 0.0)
                for n, gain in gains:
                    if gain + n * lift > -1e-3:
                        break
                else:
                    continue
            spans, scores, _ = self._scored(name)
            if not spans:
                continue
            more = self._sum([*context_features(names[k - 2], names[k - 1], names[k + 1]), *file])
            tags = self.field.best(scores + more)
            if BEGIN not in tags:
                continue
            places = places or [m.start() for m in _WORD.finditer(text)]
            start, runs = places[k - 2], []
            for (x, y), tag in zip(spans, tags, strict=True):
                if tag == BEGIN:
                    runs.append([start + x, start + y])
                elif tag == INSIDE and runs:
                    runs[-1][1] = start + y
            found += [(x, y) for x, y in runs if y - x >= LEAST["crf"]]
        return found

    def spans(self, text: str) -> list[Span]:
        """All spans in order: those of the patterns, and the field's where they overlap none of these."""
        base = base_spans(text)
        if self.field is None:
            return base
        found = self.field_spans(text)
        return sorted(base + [(x, 3, y) for x, y in found if not any(x < q and p < y for p, _, q in base)])


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rows: int = SAMPLE_DOCS) -> Scanner:
    """A scanner learned from ``made_examples`` and a bounded sample: about ``rows`` documents by a hash of their text.

    Of these at most a quarter of ``SAMPLE_CHUNKS`` chunks with secrets are learned from, and at most ``OTHERS`` chunks
    without for each one with, ``SAMPLE_CHUNKS`` in all. An empty table gives a scanner of the patterns alone. Null
    texts teach nothing, and texts that repeat teach once.
    """
    total = docs.count()
    if not total:
        return Scanner(None)

    @F.pandas_udf("array<struct<rows: array<array<string>>, tags: array<int>>>")
    def tagged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([examples(value) for value in batch])

    draw = F.pmod(F.xxhash64(F.lit("secrets"), text), F.lit(1_000_000_007))
    sample = docs.where(F.col(text).isNotNull() & (draw < int(1_000_000_007 * min(1.0, rows / total))))
    # Equal texts have equal draws: one of them is enough.
    sample = sample.select(F.col(text).alias("text"), draw.alias("draw")).dropDuplicates(["draw"])
    each = sample.select("draw", F.posexplode(tagged("text")).alias("place", "e"))
    each = each.withColumn("secret", F.exists("e.tags", lambda t: t > 0))
    made = made_examples()
    secrets = each.where("secret").orderBy("place", "draw").limit(SAMPLE_CHUNKS // 4).collect()
    tagged_rows = len(secrets) + sum(any(t != OUTSIDE for t in tags) for _, tags in made)
    others = each.where("not secret").orderBy(F.xxhash64("draw", "place")).limit(min(SAMPLE_CHUNKS, OTHERS * tagged_rows)).collect()
    learned = [(row["e"]["rows"], row["e"]["tags"]) for row in secrets + others]
    return Scanner(train(learned + made))


def scan(text: Column, scanner: Scanner) -> Column:
    """A struct of ``n_assign``, ``n_access``, ``n_hex``, ``base`` and ``spans``; null counts as empty.

    The last two are texts of kind:start:end, by start and then kind, joined by commas; in code points, end exclusive.
    """

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base string, spans string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch:
                spans = scanner.spans(value or "")
                names = [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]
                base = [name for name, (_, k, _) in zip(names, spans, strict=True) if k < 3]
                out.append((*(sum(k == i for _, k, _ in spans) for i in range(3)), ",".join(base), ",".join(names)))
            yield pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    return run(text)
